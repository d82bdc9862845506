"""Each operator against a brute-force version, an exact round trip or held-out accuracy, and on awkward tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, chat_format, langid, lz_fingerprint, minhash, mixing, packing, token_counts, toxicity, url_filter
from tidemark.llm.queries import QUERIES, SQL, URL_RULES, tokenizer

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "Über lange Texte wird auch gesprochen, und zwar sehr lang. " * 4000
SPACES = " \t\n\v\f\r"


def words(text):
    return [w for w in "".join(" " if c in SPACES else c for c in text or "").split(" ") if w]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty, very long and repeated rows, and columns named like results."""
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, LONG, "de", "b", len(LONG)), (4, "the cat sat", "en", "a", 11), (4, "the cat sat", "en", "a", 11), (5, "the cat sat", None, None, 11), (6, "123 ... !", "en", "b", 9), (7, " \n\t ", "de", "a", 4), (8, "x" * 50_000, "en", "a", 50_000)]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit("clash") for c in ("score", "predicted", "lang_pred", "size", "target", "finish", "id", "label", "words", "bands", "piece", "length", "features", "rule", "host", "path", "verdict", "key", "out", "copies", "copy", "_copies", "_copy", "content", "rows", "kept", "_kept", "number", "_features", "best", "u", "place", "bit")})


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


# ------------------------------------------------------------------ 1


def test_escape_round_trip():
    random.seed(1)
    parts = [*chat_format.CONTROL, "\\", "\\.", ".", "<", "<|", "s>", "[", "a", "\n", "é", "[[INST]"]
    for _ in range(3000):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 8)))
        out = chat_format.escape(text)
        assert chat_format.unescape(out) == text
        assert not any(c in out for c in chat_format.CONTROL)


def test_chats(spark):
    path = tokenizer("byte_bpe_50k.tiktoken")
    rows = [(1, 1, "assistant", "hé <|end|>"), (1, 0, "user", None), (1, 2, "assistant", ""), (2, None, None, "x"), (2, 0, "assistant", "</s>[INST] ok [/INST]"), (2, 0, "assistant", "</s>[INST] ok [/INST]"), (None, 0, "user", "lost"), (3, 0, "assistant", LONG)]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    formatted = chat_format.format_chats(chats, path)
    marks = set(chat_format.reserved_ids(path).values())
    for r in formatted.collect():
        assert chat_format.encoding(path).decode([i for i in r["input_ids"] if i not in marks]) == "".join(chat_format.escape(a) + chat_format.escape(b) for a, b in chat_format.read_turns(r["formatted"]))
        assert sum(i in marks for i in r["input_ids"]) == 3 * len(chat_format.read_turns(r["formatted"]))
        assert not any(m and i in marks for i, m in zip(r["input_ids"], r["loss_mask"], strict=True))
    got = {r["conv_id"]: r for r in chat_format.digest_chats(formatted, path).collect()}
    groups = defaultdict(list)
    for c, t, role, text in rows:
        groups[c].append(((t is not None, t or 0), role or "", text or ""))
    assert got.keys() == groups.keys()
    for c, turns in groups.items():
        turns.sort()
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat_format.format_chats(chats.limit(0), path).count() == 0


# ------------------------------------------------------------------ 2


def check_packing(rows, want):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for spots in by_sequence.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 4096
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    return len(by_sequence)


def test_packing(spark, awkward, nothing, documents):
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    odd = spark.createDataFrame([(100, "Σίσυφος İstanbul <|endoftext|> 漢字 don't \x1c 1½ ²"), (101, "á é ﬁ")], "doc_id long, text string")
    for docs in (awkward.select("doc_id", "text").unionByName(odd), documents, nothing):
        want = Counter()
        for r in docs.select("doc_id", "text").collect():
            ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
            for k in range(0, len(ids), 4096):
                want[r["doc_id"], k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes())] += 1
        used = check_packing(packing.pack_documents(docs, path).collect(), want)
        assert used <= -(-sum(k[3] * n for k, n in want.items()) // 4096) + 1
    packed = packing.pack_documents(documents.limit(20), path, with_ids=True)
    assert sum(len(r["ids"]) for r in packing.sequences(packed).collect()) == packed.agg(F.sum("length")).first()[0]


def test_pieces_with_ids_are_dealt_by_their_bytes(spark, documents, monkeypatch):
    monkeypatch.setattr(packing, "SALT_BYTES", 4000)
    path = tokenizer("word_bpe_49k.json")
    packed = packing.pack_documents(documents.limit(60), path, capacity=64, with_ids=True)
    parts = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in parts) == packed.agg(F.sum("length")).first()[0] and all(len(r["ids"]) <= 64 for r in parts)
    spots = [(r["sequence_id"], r["offset"]) for r in packed.select("sequence_id", "offset").collect()]
    assert len(set(spots)) == len(spots)


def test_plan():
    def optimum(items, capacity):  # exhaustive, for a few items
        best = len(items)

        def go(i, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if i == len(items):
                best = len(bins)
                return
            for k in range(len(bins)):
                if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                    bins[k] += items[i]
                    go(i + 1, bins)
                    bins[k] -= items[i]
            go(i + 1, [*bins, items[i]])

        go(0, [])
        return best

    hard = list(map(int, "46 40 39 39 38 34 32 31 31 29 27 26 22 22 22 20".split()))  # only fillings that leave something over lead to five
    assert sum(n for _, n in packing.plan(Counter(hard), 100)) == 5
    random.seed(3)
    better = 0
    for _ in range(1000):
        items = sorted((random.randint(random.choice([5, 10, 20]), random.choice([40, 60])) for _ in range(random.randint(8, 12))), reverse=True)
        steps = packing.plan(Counter(items), 100)
        assert Counter(x for p, n in steps for x in p * n) == Counter(items) and all(sum(p) <= 100 for p, _ in steps)
        used = sum(n for _, n in steps)
        assert used == optimum(items, 100)
        better += used < sum(n for _, n in packing.best_fit(Counter(items), 100))
    assert better > 10 and packing.plan({}) == []
    assert packing.lower_bound(Counter([60] * 5 + [45] * 4), 100) == 7
    big = packing.plan({s: 10_000_000 // s for s in range(1, 4096, 7)})
    assert len(big) <= 4096 and all(n > 0 for _, n in big)


# ------------------------------------------------------------------ 3, 5


def test_toxicity(spark, sf, awkward, nothing):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = QUERIES["op3_toxicity"](spark, "/root/testdata/sf0.01")
    seen = out.join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    hits = sum(r["toxic"] and r["predicted"] for r in seen)
    assert hits / sum(r["toxic"] for r in seen) > 0.7 and hits / max(1, sum(r["predicted"] for r in seen)) > 0.9
    assert out.count() == docs.count()
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(awkward, model).collect()
    assert len(scored) == 9 and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in scored)
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.fit(docs, labels.limit(0)) == toxicity.Model()
    assert toxicity.fit(docs, labels.where("toxic = 0")).base == 0.0
    assert toxicity.score(awkward, toxicity.Model()).where("score = 0 and predicted = 0").count() == 9


def test_toxicity_score_by_definition(spark):
    """Every word compressed on its own beside both dictionaries, without caches, against the operator."""
    import math

    import zstandard

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    assert all(len(d) > 8 for d in (model.ordinary, model.toxic))
    tail = model.ordinary[-toxicity.TAIL :]

    def size(content, data):
        reach = max(18, (len(content) + 4 * toxicity.WINDOW).bit_length())
        params = zstandard.ZstdCompressionParameters(strategy=zstandard.STRATEGY_BTLAZY2, min_match=4, search_log=6, target_length=32, window_log=reach, chain_log=reach, hash_log=reach, write_content_size=False, write_dict_id=False)
        beside = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(dict_data=beside, compression_params=params).compress(data + tail))

    empty = size(model.ordinary, b"")
    known = {}

    def saving(word):
        if word not in known:
            plain = size(model.ordinary, b" " + word + b" ")
            saved = plain - size(model.toxic + model.ordinary, b" " + word + b" ")
            known[word] = (saved / (plain - empty), saved) if saved > 0 else (0.0, 0)
        return known[word]

    rows = docs.join(labels.where("toxic = 1").limit(8), "doc_id").select("doc_id", "text").limit(8).unionByName(docs.join(labels.where("toxic = 0").limit(8), "doc_id").select("doc_id", "text"))
    rows = rows.where("length(text) < 3000").collect()
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    tried = 0
    for doc, text in rows:
        words = [w.encode() for w in "".join(c if ord(c) > 127 or c.isalnum() else " " for c in text.lower()).split(" ") if w]
        if any(len(w) > toxicity.PIECE for w in words):
            continue
        tried += 1
        hits = {w: saving(w) for w in set(words) if saving(w)[1]}
        features = [1.0, 0, 0, 0, 0, 0]
        if hits:
            total = sum(hits[w][0] * hits[w][1] for w in words if w in hits)
            features = [1.0, min(12, max(s for _, s in hits.values())), max(f for f, _ in hits.values()), math.log1p(total), math.log1p(1000 * total / (len(text.lower().encode()) + 500)), math.log1p(sum(f * s for f, s in hits.values()))]
        assert abs(got[doc] - 1 / (1 + math.exp(-sum(w * x for w, x in zip(model.weights, features, strict=True))))) < 1e-9
    assert tried >= 5


def test_language(spark, awkward, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.95
    model = langid.learn(docs)
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.classify(awkward, model).collect()]
    assert len(got) == 9 and {d for d, lang, s in got if lang == "und"} == {1, 2, 6, 7} and all(s == 0 for d, lang, s in got if lang == "und")
    assert dict((d, lang) for d, lang, _ in got)[3] == "de"
    assert langid.classify(nothing, model).count() == 0
    short = spark.createDataFrame([(1, "a"), (2, "ab"), (3, "9 ü 9"), (4, "12"), (5, "\n")], "doc_id long, text string")
    assert {r["doc_id"] for r in langid.classify(short, model).where("lang_pred = 'und'").collect()} == {4, 5}
    assert {r["lang_pred"] for r in langid.classify(awkward, langid.learn(nothing)).collect()} == {"und"}


def test_bundles_match_their_definition():
    texts = ["Ab c!", "", "日本語 テキスト", "a"]
    got, counts = langid.bundle(texts)
    for t, v, n in zip(texts, got, counts, strict=True):
        marks, out = [], []
        for c in f" {t.lower()} ":
            if c.isalpha():
                marks.append(ord(c))
            elif not marks or marks[-1]:
                marks.append(0)
        for g in zip(marks, marks[1:], marks[2:], strict=False):
            if any(g):
                out.append(np.prod([np.roll(langid.letter_vector(c).astype(int), 2 - k) for k, c in enumerate(g)], axis=0))
        assert n == len(out) and np.array_equal(v, np.sum(out, axis=0) if out else np.zeros(langid.DIMENSIONS))


@pytest.mark.parametrize("n", [20, 600, 2000])
def test_toxic_words_save_beside_dictionaries_of_any_size(n):
    rng = random.Random(n)
    made = [bytes(rng.choices(b"abcdefghijklmnopqrstuvwxyz", k=rng.randint(6, 12))) for _ in range(2 * n + 1000)]
    planted, wrong, rest = made[:n], made[n : 2 * n], made[2 * n :]
    ordinary = b" ".join([b"", *wrong, b" ".join(rest)[: toxicity.DICTIONARY_BYTES]])
    plain = toxicity.Distance(toxicity.Model(ordinary=ordinary))
    both = toxicity.Distance(toxicity.Model(ordinary=ordinary, toxic=b"".join(b" " + w + b" " for w in planted)))
    assert all(plain.cost(w) - both.cost(w) >= 2 for w in planted)
    assert not any(plain.cost(w) - both.cost(w) > 0 for w in wrong if w not in planted)


def test_toxic_words_in_other_forms(spark):
    rng = random.Random(5)
    common = ["".join(rng.choices("abcdeghilmnorstu", k=rng.randint(3, 9))) for _ in range(300)]
    docs, labels = [], []
    for i in range(400):
        words = rng.choices(common, k=40)
        if i % 4 == 0:
            words[rng.randrange(40)] = rng.choice(["grumblefink", "swozzleward"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    clean = rng.choices(common, k=12)
    forms = ["grumblefink", "grumblefinks", "grumblefinkish", "swozzlewards", "ubergrumblefink", "grumblef1nk", "qzjxkvyw" * 20 + "swozzleward" + "kxzqvjwy" * 20]
    texts = [" ".join(clean), "qzjxkvyw" * 40, *(" ".join([*clean, w]) for w in forms)]
    scored = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).select("doc_id", "score", "predicted").orderBy("doc_id").collect()
    assert [r["predicted"] for r in scored] == [0, 0] + [1] * len(forms), scored
    assert min(r["score"] for r in scored[2:]) > max(r["score"] for r in scored[:2])


# ------------------------------------------------------------------ 4


def targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in capped]
        level = (total - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in rest) if rest else 0
        more = {s for s in rest if weight[s] * level > 3 * sizes[s]}
        if not more:
            return {s: 3 * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= more


def test_mix_takes_the_smallest_finish_times(spark):
    """Which copies the mix takes, against the whole queue sorted in Python."""
    rng = random.Random(11)
    docs = spark.createDataFrame([(i, "w " * rng.randint(0, 9), "en", s, 1) for i, s in enumerate(["a"] * 40 + ["b"] * 300 + ["c"] * 7 + [None] * 60)], DOCS)
    queue, copies = mixing._mix(docs, "doc_id", "text", "source", 0, 1.0, mixing.WEIGHTS, mixing.MOST_ROUNDS)
    rows = queue.collect()
    served = defaultdict(list)
    for r in rows:
        served[r["source"]].append((r["served"], r["size"]))
    for s, spots in served.items():  # served: running words of the source in some fixed order
        spots.sort()
        assert [x for x, n in spots if n] == list(np.cumsum([n for _, n in spots if n])), s
    want = sorted(((k * r["source_size"] + r["served"]) / r["target"], r["row_key"], k, r["size"]) for r in rows if r["size"] and r["target"] for k in range(mixing.MOST_ROUNDS))
    budget, taken = round(sum({r["source"]: r["target"] for r in rows}.values())), Counter()
    for _, key, k, size in want:
        budget -= size
        if budget < 0:
            break
        taken[key, k] += 1
    assert Counter((r["row_key"], r["round"]) for r in copies.select("row_key", "round").collect()) == taken


def test_mixing(spark, awkward, nothing, documents):
    tiny = spark.createDataFrame([(i, "w " * (i % 7 + 1), "en", s, 1) for i, s in enumerate(["a"] * 5 + ["b"] * 200 + ["c"] * 3 + [None] * 50)], DOCS)
    for docs in (documents, tiny, awkward):
        rows = mixing.mix_report(docs).select("doc_id", "source", "size", "source_size", "target", "taken", "copies").collect()
        want = Counter()
        for r in docs.select("source", "text").collect():
            want[r["source"]] += len(words(r["text"]))
        goal = targets(want)
        taken, largest = Counter(), Counter()
        for r in rows:
            assert r["source_size"] == want[r["source"]] and abs(r["target"] - goal[r["source"]]) < 1e-6 * max(1, r["target"])
            assert r["taken"] == r["size"] * r["copies"] and r["copies"] <= 3
            taken[r["source"]] += r["taken"]
            largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert sum(taken.values()) <= round(sum(goal.values()))
        if docs is not awkward:
            assert all(abs(taken[s] - goal[s]) <= 2 * max(largest.values()) for s in goal)
        again = mixing.mix_report(docs.repartition(7)).select("doc_id", "taken").collect()
        assert Counter((r["doc_id"], r["taken"]) for r in rows) == Counter(map(tuple, again))
        copies = mixing.mixed_documents(docs)
        assert copies.count() == sum(r["copies"] for r in rows) and copies.columns == docs.columns
    assert mixing.mix_report(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0
    order = mixing.in_mix_order(mixing.mix_sources(tiny)).select("finish").collect()
    assert [r[0] for r in order] == sorted(r[0] for r in order)


def test_mixing_keeps_rows_apart_that_differ_in_other_columns(spark):
    rows = [(None, "w w", "s", k, {"a": k}) for k in "AB"] + [(7, "w", "s", k, None) for k in "CDD"] + [(None, "w", None, None, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra string, content map<string,string>")
    report = mixing.mix_report(docs).select("doc_id", "source", "copies").collect()
    got = Counter((r["doc_id"], r["source"], r["extra"]) for r in mixing.mixed_documents(docs).collect())
    alike = Counter((r[0], r[2], r[3]) for r in rows)
    assert all(n <= 3 * alike[k] for k, n in got.items())
    by_id, of_report = Counter(), Counter()
    for (i, s, _), n in got.items():
        by_id[i, s] += n
    for r in report:
        of_report[r["doc_id"], r["source"]] += r["copies"]
    assert len(report) == len(rows) and by_id == +of_report
    # a budget of all words three times over takes every row three times
    full = Counter((r["doc_id"], r["source"], r["extra"]) for r in mixing.mixed_documents(docs, share=3.0).collect())
    assert full == Counter({k: 3 * n for k, n in alike.items()})


def test_mixing_deals_out_repeats(spark):
    docs = spark.createDataFrame([(1, "w w", "s", None, None)], DOCS).crossJoin(spark.range(20_000).select()).unionByName(spark.createDataFrame([(i, "w", "t", None, None) for i in range(2, 9)], DOCS))
    queue, _ = mixing._mix(docs, "doc_id", "text", "source", 0, 1.0, mixing.WEIGHTS, mixing.MOST_ROUNDS)
    assert queue.count() == 20_007
    buckets = queue.where("doc_id = 1").groupBy(F.split("row_key", "-")[F.size(F.split("row_key", "-")) - 2]).count().collect()
    assert len(buckets) > 1 and max(r["count"] for r in buckets) < 1.2 * mixing.BUCKET_ROWS


# ------------------------------------------------------------------ 6


def test_token_counts(spark, awkward, nothing, documents):
    import sentencepiece

    path = tokenizer("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    random.seed(5)
    parts = [" ", "  ", "\n", "a", "th", "▁", "é", "\t", "\r", " the", "<s>", "</s>", "<unk>", "ﬁ", "\x00", "漢", "😀", ".", "1", ";\r", "<0x0A>", " ", "﻿"]
    odd = spark.createDataFrame([(i, "".join(random.choice(parts) for _ in range(random.randint(0, 12)))) for i in range(2000)], "doc_id long, text string")
    for docs in (odd, awkward.select("doc_id", "text"), documents.select("doc_id", "text"), nothing.select("doc_id", "text")):
        want = Counter((r["doc_id"], len((r["text"] or "").encode()), len(sp.encode(r["text"] or ""))) for r in docs.collect())
        got = token_counts.count_tokens(docs, path, limit=5).collect()
        assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 5) for r in got)


# ------------------------------------------------------------------ 7


def shingles(text):
    w = ["".join(c.lower() if c.isascii() else c for c in x) for x in words(text)]
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(rows):
    ids = sorted(rows)
    sets, parent = {i: shingles(rows[i]) for i in ids}, {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x == y or (x and y and len(x & y) >= 0.8 * len(x | y)):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {i: root(i) for i in ids}


def test_near_duplicates(spark, awkward, nothing, documents):
    random.seed(2)
    base = [f"w{random.randint(0, 10**6)}" for _ in range(100)]
    texts = {}
    for i in range(220):  # one large group around the threshold: chains, and members that resemble no representative
        w = list(base)
        for _ in range(random.randint(0, 7)):
            w[random.randrange(100)] = f"x{random.randint(0, 10**6)}"
        texts[1000 + i] = " ".join(w)
    rows = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").limit(150).collect()} | texts | {5000: None, 5001: "", 5002: "A b", 5003: "a  B\n", 5004: "a b c", 5005: LONG, 5006: LONG + " end"}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(docs).collect()}
    assert got == brute_classes(rows)
    kept = minhash.deduplicate(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(got.values()))
    assert minhash.classes(nothing).count() == 0 and minhash.deduplicate(nothing).count() == 0
    some = [(r["doc_id"], r["class_id"]) for r in minhash.classes(awkward).collect()]
    assert Counter(some) == Counter({(1, 1): 1, (2, 1): 1, (7, 1): 1, (3, 3): 1, (4, 4): 2, (5, 4): 1, (6, 6): 1, (8, 8): 1})
    left = minhash.deduplicate(awkward)
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 3, 4, 6, 8] and left.columns == awkward.columns
    twice = spark.createDataFrame([(7, "one two three four five six", "x"), (7, "quite another text of seven words", "y"), (7, "one two three four five six", "x")], "doc_id long, text string, note string")
    for again in (twice, twice.repartition(3), twice.orderBy("text")):
        assert [r["text"] for r in minhash.deduplicate(again).collect()] == [r["text"] for r in minhash.deduplicate(twice).collect()] and minhash.deduplicate(again).count() == 1
    lost = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (None, None)], "doc_id long, text string")
    assert sorted(r["text"] or "" for r in minhash.deduplicate(lost).collect()) == ["", "a b c d e f", "a b c d e f"]


def test_dart_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**63, 400, dtype=np.uint64)
    a = rng.integers(0, 4, 400) + rng.random(400)
    b = np.where(rng.random(400) < 0.7, a, rng.random(400) * 4)
    s = minhash.dart_signatures(np.concatenate([h, h]), np.repeat([0, 1], 400), np.concatenate([a, b]), 2, k=4000)
    assert abs((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03
    one = minhash.dart_signatures(h[:1], np.array([0]), np.array([1.0]), 1)
    assert (one != 0).all()


# ------------------------------------------------------------------ 8


def test_urls(spark):
    urls = ["http://a.example.com/en/x?q", "https://WWW.Example.COM/en/", "http://example.com/enx", "http://com/", "http://x.net/es/", "http://x.net/es", "http://com", None, "", "no scheme", "http:///en/", "http://a?://b.net/fr/", "ftp://evilexample.com/en/#://", "http://example.com:80/en/", "http://x.net/fr/" + "a/" * 3000, "http://x.net/fr/1"]
    pages = spark.createDataFrame([(i, u, "clash", "clash", "clash") for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, rule string, best string, u string")
    rules = spark.createDataFrame([*URL_RULES, ("net", None, "block"), ("net", "/fr/1", "allow"), ("NET", "/es/", "allow"), ("x.net", "", "allow")], url_filter.RULES_SCHEMA)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, rules).collect()}
    assert len(got) == len(urls) + 1
    known = [(h.lower(), p, v) for h, p, v in [tuple(r) for r in rules.collect()] if p is not None]
    for i, u in enumerate([*urls, urls[0]]):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, tail = rest[:end].lower(), rest[end:]
        path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
        fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in known if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        assert got[i] == (host, path, best and best[3], best[4] if best else "allow"), u
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.filter_urls(pages, rules.limit(0)).collect()} == {"allow"}


# ------------------------------------------------------------------ 9


def test_fingerprints(spark, awkward, nothing):
    docs = [(i, t) for i, t in enumerate(["", "a", "ab", "abcabcabc" * 9, None, "é😀" * 40, "abcabcabc" * 9, "zz top"])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r for r in lz_fingerprint.edit_likeness(df).collect()}
    texts = {i: t or "" for i, t in docs}
    for i, t in texts.items():
        following = texts[(i - 1) % len(docs)]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        a, b, c = (lz_fingerprint.Parsed(x).slots for x in (t, edited, following))
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), lz_fingerprint.to_hex(a), lz_fingerprint.to_hex(b))
        assert (r["near_edited"], r["near_next"]) == (np.mean(a == b), np.mean(a == c))
    assert got[3]["fingerprint"] == got[6]["fingerprint"] and got[0]["fingerprint"] == "0" * 256
    assert lz_fingerprint.edit_likeness(nothing).count() == 0
    assert lz_fingerprint.edit_likeness(awkward).count() == 9 == lz_fingerprint.fingerprints(awkward).count()
    alone = lz_fingerprint.edit_likeness(df.where("doc_id = 7")).collect()[0]
    assert alone["near_next"] == 1.0 and alone["edited_sha256"] == hashlib.sha256(b"zz zz ").hexdigest()[:0] + hashlib.sha256(("zz top"[:3] + "zz ").encode()).hexdigest()


def test_phrases():
    def plain(text):
        known, out, at = set(), set(), 0
        while at < len(text):
            end = at + 1
            while end < len(text) and text[at:end] in known:
                end += 1
            known.add(text[at:end])
            out.add(text[at:end])
            at = end
        return out

    random.seed(4)
    for _ in range(300):
        t = "".join(random.choice("ab c") for _ in range(random.randint(0, 60)))
        p = lz_fingerprint.Parsed(t)
        assert {t[a:b] for a, b in zip([0, *p.ends], p.ends, strict=False)} == plain(t)


# ------------------------------------------------------------------ 10


def test_neighbours(spark):
    path = "/root/testdata/sf0.01/embeddings.parquet"
    rows = spark.read.parquet(path).collect()
    ids, v = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=np.float64)
    got = defaultdict(list)
    for r in QUERIES["op10_nearest_neighbours"](spark, "/root/testdata/sf0.01").orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert sorted(got) == sorted(i for i in ids.tolist() if i % 20 == 0)
    place, found = {i: k for k, i in enumerate(ids.tolist())}, 0
    for q, near in got.items():
        scores = v @ v[place[q]]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        found += len({int(ids[i]) for i in order} & {i for i, _ in near})
        assert len(near) == 20 and near == sorted(near, key=lambda x: (-x[1], x[0])) and all(abs(s - scores[place[i]]) < 1e-12 for i, s in near)
    assert found / (20 * len(got)) >= 0.9


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [1.0, 0.0, 2.0]
    rows = [(0, good), (20, good), (0, good), (40, [0.0, 0.0, 0.0]), (60, None), (80, [nan, 1.0, 1.0]), (100, [inf, 1.0, 1.0]), (120, [None, 1.0, 1.0]), (140, []), (160, [1.0, 2.0]), (None, good), (7, [1.0, 1.0, 1.0])] + [(1000 + i, good) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"rank": F.lit(1), "score": F.lit("clash"), "id": F.lit(0)})
    out = defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        out[r["query_id"]].append(r["vec_id"])
    same = [0, 20, *range(1000, 1040)]
    assert sorted(out) == [0, 20, 1000, 1020] and all(out[q] == [i for i in same if i != q][:20] for q in out)
    few = ann.nearest(df.where("vec_id < 30"), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in few] == [(1, 20, 5.0), (2, 7, 3.0)]
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.nearest(df, F.lit(False)).count() == 0


# ------------------------------------------------------------------ all


def test_sql(spark, sf):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, sql in SQL.items():
        got = QUERIES[name](spark, sf)
        want = con.sql(sql)
        names = sorted(want.columns)
        assert sorted(got.columns) == names
        rounded = lambda v: round(v, 6) if isinstance(v, float) else v
        plain = lambda cols, rows: sorted((tuple(rounded(r[cols.index(c)]) for c in names) for r in rows), key=repr)
        assert plain(list(got.columns), got.collect()) == plain(list(want.columns), want.fetchall()), name
