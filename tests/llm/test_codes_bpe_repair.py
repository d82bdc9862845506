"""Vector codes, BPE and conversation repair against brute force, the library and exhaustive search, and on awkward tables."""

import hashlib
import itertools
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, repair, vector_codes
from tidemark.llm.queries import QUERIES, tokenizer

# ------------------------------------------------------------------ 11


def brute_codes(rows, parts=16, entries=64, rounds=2):
    """``{(id, place among equal rows): (code, error)}`` and the codebooks' digest, by definition, in Python's integers."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v, _ in kept), default=0)
    each = -(-width // parts)
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(256 * x) if abs(x) < 1e15 else 256 * int(x) for x in v] + [0] * (each * parts - len(v)) for _, v, _ in kept]
    cut = [[tuple(v[p * each : (p + 1) * each]) for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        found = [[nearest(p, v[p])[1] for v in cut] for p in range(parts)]
        for p in range(parts):
            groups = defaultdict(list)
            for v, k in zip(cut, found[p], strict=True):
                groups[k].append(v[p])
            for k, members in groups.items():
                books[p][k] = tuple(sum(m[c] for m in members) // len(members) for c in range(each))
    out = []
    for (i, _, label), v in zip(kept, cut, strict=True):
        best = [nearest(p, v[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    sums = defaultdict(int)
    for _, label, _, error in out:
        sums[label] += error
    fits = lambda x: x if x < 1 << 63 else None
    return sorted(((i, code, fits(e), fits(sums[label])) for i, label, code, e in out), key=str), digest


VECTORS = "vec_id long, embedding array<float>, label int"


def check_codes(spark, rows, schema=VECTORS, **options):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    df = spark.createDataFrame(rows, schema).withColumns({c: F.lit("clash") for c in ("id", "v", "code", "error", "label_error", "of", "_0", "entry")})
    got = vector_codes.compress(df, **options).collect()
    want, digest = brute_codes(rows, **{k: v for k, v in options.items() if k in ("parts", "entries", "rounds")})
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got), key=str) == want
    assert {r["codebooks_sha256"] for r in got} <= {digest}


def test_codes(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    check_codes(spark, rows)
    random.seed(11)
    coarse = [(i, [random.choice([-1, -0.5, -0.01, 0, 0.3, 1]) for _ in range(32)], random.choice([None, 1, 2])) for i in range(300)]  # many ties
    check_codes(spark, coarse)


def test_awkward_vectors(spark):
    odd = [(1, None, 1), (2, [None, 1.0], 1), (3, [float("nan"), 1.0], 2), (4, [float("inf"), 1.0], 2), (5, [], None), (6, [1.0], None), (None, [0.5, 0.25, -0.5], 3), (7, [0.0] * 16, 3), (8, [1e-9, -1e-9] * 9, 3), (8, [1e-9, -1e-9] * 9, 3), (8, [2.0] * 20, 4)]
    check_codes(spark, odd)
    check_codes(spark, odd + [(9, [3e38, -3e38], 5), (10, [3e38] * 3, 5), (11, [1e12] * 18, 5)])  # beyond 64-bit squares
    check_codes(spark, odd, parts=2, entries=3, rounds=4)
    check_codes(spark, [])
    check_codes(spark, odd[:4])
    copies = [(i, [0.1 * (i % 3)] * 16, 0) for i in range(500)]
    check_codes(spark, copies)


def test_nearest_entries_need_few_distances():
    rng = np.random.default_rng(0)
    entries = rng.integers(-300, 300, size=(1, 64, 4))
    x = entries[0, rng.integers(0, 64, size=4000)] + rng.integers(-30, 31, size=(4000, 4))
    counted = []  # parts near entries; among evenly spread ones about three quarters of the distances are needed
    index, best = vector_codes.Codebook(entries).nearest(0, x, counted)
    d = ((x[:, None] - entries[0]) ** 2).sum(axis=2)
    assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert sum(counted) < 0.5 * d.size


@pytest.mark.parametrize("number", [0, 1, -1, (1 << 39) - 1, 1 << 39, -(1 << 39), -(1 << 39) - 1, 10**60, -(10**60)])
def test_limbs(number):
    assert sum(v << (vector_codes.LIMB * k) for k, v in vector_codes._limbs(number)) == number
    assert all(abs(v) < 1 << vector_codes.LIMB for _, v in vector_codes._limbs(number))


# ------------------------------------------------------------------ 12


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer("word_bpe_49k.json"))


def test_codec_equals_library(library):
    random.seed(12)
    codec = bpe.Codec(tokenizer("word_bpe_49k.json"))
    odd = ["a", "aa", "ab", "!", "..", "=", "the", "ing", "é", "ß", "漢", "0", "'s", "'", "x" * 9, "Σ", "İ", "ﬁ", "́", "\xa0", "\x1c", "\x85", "<|endoftext|>", "<|startoftext|>", "<|", " ", "\n", "\t", "\0", "z", "😀", "​"]
    texts = ["".join(random.choice(odd) for _ in range(random.randint(0, 14))) for _ in range(6000)]
    texts += ["".join(random.choice("eainrtos.!=-_*h") for _ in range(random.randint(1, 24))) for _ in range(6000)]
    texts += [c * n for c in "a!=.-0zhé漢o" for n in range(1, 60)]
    for texts in (texts, ["the end " * 30_000 + "x" * 50_000, "", " "]):
        for text, ids in zip(texts, codec.encode(texts), strict=True):
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, dtype="<u4").tolist() == want, text[:80]
            assert codec.decode(ids).decode() == library.decode(want, skip_special_tokens=False)
    assert 0 < codec.merged < codec.proposed


def test_pairs_by_definition(library):
    """A pair is compatible if merging its letters gives the pair back."""
    codec = bpe.Codec(tokenizer("word_bpe_49k.json"))
    v = codec.vocabulary
    random.seed(13)
    inner, final = list(v.inner.items()), list(v.final.items())
    pairs = [(random.choice(inner), random.choice(random.choice([inner, final]))) for _ in range(4000)]
    short = [t for t in inner if len(t[0]) <= 2]
    pairs += [(random.choice(short), random.choice([t for t in final if len(t[0]) <= 2][:400])) for _ in range(4000)]
    merged = [np.frombuffer(codec.exact(a[0] + b[0]), dtype="<u4").tolist() == [a[1], b[1]] if b in final else None for a, b in pairs]
    got = v.compatible(np.array([a[1] for a, _ in pairs]), np.array([b[1] for _, b in pairs]))
    checked = [(g, m) for g, m, (_, b) in zip(got, merged, pairs, strict=True) if m is not None]
    assert all(bool(g) == m for g, m in checked)
    assert {m for _, m in checked} == {True, False}


def test_tokens_that_never_stand_alone_are_not_proposed():
    vocab = {t: i for i, t in enumerate(["a", "b", "c", "a</w>", "b</w>", "c</w>", "bc", "ab", "abc"])}
    v = bpe.Vocabulary(vocab, [("b", "c"), ("a", "b"), ("ab", "c")])  # "abc" is a bc: the last merge is never reached
    assert v.sound and b"abc" not in v.inner and b"ab" in v.inner
    assert not bpe.Vocabulary(vocab, [("ab", "c"), ("a", "b"), ("b", "c")]).sound  # a merge before its part
    assert v.propose(b"abx") == []


def test_bpe(spark, sf, library):
    path = tokenizer("word_bpe_49k.json")
    rows = [(1, None), (2, ""), (3, "Über lange Texte. " * 20_000), (4, "the cat sat"), (4, "the cat sat"), (None, "Σίσυφος <|endoftext|> 漢字"), (6, " \n\t ")]
    odd = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("id", "ids", "n_tokens", "decoded", "out")})
    for docs in (odd, spark.read.parquet(f"{sf}/documents.parquet"), odd.limit(0)):
        want = sorted((r["doc_id"] or -1, tuple(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect())
        got = bpe.encode(docs, path, decoded=True).cache()
        assert sorted((r["doc_id"] or -1, tuple(np.frombuffer(r["ids"], dtype="<u4").tolist())) for r in got.collect()) == want
        for r in got.collect():
            ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
            assert r["decoded"] == library.decode(ids, skip_special_tokens=False) and r["n_tokens"] == len(ids)
        assert bpe.decode(got.drop("decoded"), path).exceptAll(got.select("doc_id", "n_tokens", "ids", "decoded")).count() == 0
    small = bpe.encode(odd.where("doc_id in (2, 4)"), path)
    assert sorted((r["doc_id"], r["ids"]) for r in bpe.as_arrays(small).collect()) == sorted((r["doc_id"], np.frombuffer(r["ids"], dtype="<u4").tolist()) for r in small.collect())
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op12_bpe"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").limit(50).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert (r["doc_id"], len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()) in got


# ------------------------------------------------------------------ 13

LEGAL = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def cheapest(turns):
    """The least (cost, audit) and what it makes of the turns, by trying every edit; inserts in a row up to three."""
    best = None

    def go(k, state, inserts, cost, audit, out):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if k == len(turns) and state in ("", "a"):
            best = min(best or (cost, audit, out), (cost, audit, out))
        if inserts < 3:
            for role in ("user", "assistant"):
                if (state, role[0]) in LEGAL:
                    go(k, role[0], inserts + 1, cost + 3, audit + "I", [*out, f"{role}:"])
        if k < len(turns):
            role, text, fault = turns[k]
            go(k + 1, state, 0, cost + 4, audit + "D", out)
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                if (state, role[:1]) in LEGAL:
                    go(k + 1, role[:1], 0, cost + extra, audit + "K", [*out, f"{role}:{text}"])
                for r in ("user", "assistant"):
                    if (state, r[0]) in LEGAL:
                        go(k + 1, r[0], 0, cost + 3 + extra, audit + "R", [*out, f"{r}:{text}"])

    go(0, "", 0, 0, "", [])
    return best


SPACES = " \t\n\v\f\r"


def brute_repair(rows):
    """The contract's columns for ``(turn, role, text)`` rows in order, as far as they can be told without the damage."""
    seen, turns = set(), []
    for _, role, text in rows:
        bare = text.rstrip(SPACES)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        turns.append((role, text, fault))
    cost, audit, out = cheapest(turns)
    numbers = {t for t, _, _ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    count = lambda f: sum(t[2] == f for t in turns)
    return (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, count("blank"), count("duplicate"), count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def damaged(conv, turn, role, text):
    a, b = (" " if x is None else str(x) for x in (conv, turn))
    role, text, kind = " " if role is None else role, " " if text is None else text, zlib.crc32(f"{a}:{b}".encode()) % 20
    text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
    return [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)


def check_repair(spark, rows, extra=()):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("clash") for c in ("times", "fault", "audit", "repaired", "cost", "gaps")}).drop(*extra)
    got = repair.repair(repair.damage(df)).collect()
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv] += damaged(conv, turn, role, text)
    assert len(got) == len(groups)
    for r in got:
        own = sorted(groups[r["conv_id"]], key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        digest = hashlib.sha256("\n".join(f"{t['role']}:{t['text']}" for t in r["repaired"]).encode()).hexdigest()
        assert (*(r[c] for c in COLUMNS), digest) == brute_repair(own), (r["conv_id"], own)


def test_repair_is_the_cheapest(spark):
    random.seed(14)
    roles, texts = ["system", "user", "assistant", "tool", "", None, "u", "Assistant"], ["Yes.", "No!", "cut", "", " \n", None, "cut. ", "Yes.", "x\v", "é?"]
    rows = [(c, random.choice([None, *range(6)]) if c % 2 else k, random.choice(roles), random.choice(texts)) for c in range(400) for k in range(random.randint(1, 5))]
    rows += [(None, None, "user", "Lost."), (None, 3, "assistant", "Found."), (500, None, None, None)]
    check_repair(spark, rows)
    check_repair(spark, [])


def test_repair_of_clean_and_of_long_conversations(spark):
    clean = [(c, k, ("user", "assistant")[k % 2], f"Turn {c} {k}.") for c in range(50) for k in range(4)]
    found = repair.repair(spark.createDataFrame(clean, "conv_id long, turn long, role string, text string"))
    assert {(r["cost"], r["audit"]) for r in found.collect()} == {(0, "KKKK")}
    n = 20_000
    same = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("Turn "), "id", F.lit(".")).alias("text"))
    r = repair.repair(same).first()  # two ways to re-role every other turn cost the same all along; one turn is left over or gets a partner
    assert (r["cost"], r["illegal"], len(r["repaired"])) == (3 * n // 2, n - 1, n) and r["audit"] == "KR" * (n // 2)


def test_order_of_audits_by_strings():
    """Pairs of place and appended edits give the order that whole strings have."""
    random.seed(15)
    for _ in range(300):
        turns = [(random.choice("sua "), random.choice(["", "", "blank", "truncated", "duplicate"])) for _ in range(30)]
        ways, fast = {0: (0, "")}, repair.Viterbi()
        for initial, fault in turns:
            best = {}
            for s, to, c, a in repair._transitions(initial, fault):
                if s in ways:
                    found = (ways[s][0] + c, ways[s][1] + a)
                    best[to] = min(best.get(to, found), found)
            ways = best
            fast.step(initial, fault)
        want = min((ways[s][0] + 3 * k, ways[s][1] + "I" * k) for s in ways for k, at in repair._closures(s) if at in repair.ENDS)
        cost, edits = fast.finish()
        assert (cost, "".join(edits)) == want


# ------------------------------------------------------------------ 3


def test_toxicity_fit_depends_on_no_partitioning(spark):
    from tidemark.llm import toxicity

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    twice = docs.unionByName(docs.limit(50))  # repeated rows of an id are one to learn from
    one, two = toxicity.fit(docs, labels), toxicity.fit(twice.repartition(13), labels.repartition(5))
    assert (one.ordinary, one.toxic) == (two.ordinary, two.toxic) and one.weights == two.weights
