"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text: one on ordinary text,
one on ordinary *and* toxic text. Every window of a document is compressed with
both; a window that needs fewer bytes beside the toxic dictionary resembles
toxic text. A window is a word, as a short one saves too little to show in
anything longer: a run of bytes other than ASCII signs and white space. Over a
run longer than ``PIECE`` bytes windows of that size slide, so that words inside
text without spaces show too. Every saved byte counts, and the more so the
larger its share of what the window costs: a logistic score of a few sums of
savings is calibrated on the learned documents, so that a threshold on it means
a probability and decides what a small saving is worth.

Labels belong to whole documents, of which most text is ordinary even if the
label is 1. The toxic dictionary is therefore fitted on the passages that tell
the classes apart: the parts of words whose byte n-grams are in toxic documents
many times as often as in ordinary ones. Ordinary words that save bytes beside
it all the same, being part of a passage, are put into the ordinary dictionary.

Fitting uses a bounded sample (``SAMPLE_DOCS`` labelled documents per class, by
hash of the id, one row each; ``TRAIN_DOCS`` of the ordinary ones for their
dictionary); all windows, words and passages of its texts count. Document
frequencies are counted by Spark, and only words of the toxic passages, windows
of the texts to train on, and a row of feature values per sampled document reach the driver.

Defined results
---------------
* null text is empty; an empty text, and any other text without a saved byte,
  gets the calibrated base score, which is below the threshold unless nearly
  all learned documents are toxic;
* labels of one document that differ count as toxic; null labels and ids are not learned from;
* of several rows with a learned id the one of the least text is learned from;
* without both classes among the learned documents every score is the share of
  toxic ones (0 if there are none);
* texts are read whole; repeated rows stay; input columns other than id and
  text don't matter; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, free_name, hold, slices, text_or_empty

#: Labelled documents of each class that fitting reads, at most.
SAMPLE_DOCS = 3000
#: Ordinary documents of the sample, at most, on whose whole texts the ordinary dictionary is trained, and bytes of the dictionary.
TRAIN_DOCS, DICTIONARY_BYTES = 1000, 8192
#: Bytes of a window of the dictionary's sample.
WINDOW = 96
#: Bytes of a piece of a longer word, and from the start of one piece to the next: a word of up to 13 bytes lies in one whole.
PIECE, STEP = 24, 12
#: Bytes of the windows that slide byte by byte over a piece that saves some.
WIDTHS = (6, 9, 12)
#: Bytes of the n-grams that tell toxic passages: those in at least so many toxic documents, and so many times as frequent there.
GRAM, LEAST_DOCS, LEAST_RATIO = 5, 3, 30.0
#: The same for whole words, whose n-grams may all be ordinary, and for ordinary words that the ordinary dictionary gets because they look like toxic ones.
LEAST_WORD_DOCS = 3
#: Bytes of the substrings that dictionary training counts, and of the stretches it picks for the toxic dictionary.
TRAIN_MATCH, TRAIN_STRETCH = 6, 32
#: Compression level of a text without a dictionary, and bytes of the text behind a window.
LEVEL, TAIL = 9, 16
#: Shortest match, and how many candidates are tried for one (as a power of two), beside a dictionary.
MATCH, SEARCH_LOG = 4, 6
THRESHOLD = 0.7
#: Remembered words per Python process; the cache starts anew beyond it.
CACHE_ENTRIES = 100_000
#: Longer texts leave nothing in the cache.
CACHE_BYTES = 1 << 20


#: ASCII characters between words, as a pattern and as bytes to blank out.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BLANK = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


@dataclass
class Model:
    ordinary: bytes = b""
    toxic: bytes = b""
    weights: list[float] = field(default_factory=list)
    base: float = 0.0


def windows(data: bytes, width: int = WINDOW):
    """``(starts, lengths)`` of consecutive windows; each ends behind a word, unless a word is longer than two windows."""
    import numpy as np

    points = np.frombuffer(data, dtype=np.uint8)
    n = len(points)
    breaks = np.flatnonzero(points <= 32) + 1
    cuts = np.arange(width, n, width)
    at = np.searchsorted(breaks, cuts)
    ends = np.append(breaks, n)[at]
    bounds = np.unique(np.concatenate([[0], np.minimum(ends, cuts + 2 * width), [n]])).astype(np.uint64)
    bounds = bounds[bounds <= n]
    return bounds[:-1], np.diff(bounds)


def pieces(word: bytes) -> list[bytes]:
    """The word, or overlapping pieces of a longer one; the last ends with it."""
    if len(word) <= PIECE:
        return [word]
    return [word[i : i + PIECE] for i in (*range(0, len(word) - PIECE, STEP), len(word) - PIECE)]


class Distance:
    """Compressed lengths beside the two dictionaries."""

    def __init__(self, model: Model):
        import zstandard

        def compressor(content):
            if len(content) < 8:  # less than a dictionary may be
                return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
            # a level picks its strategy by the dictionary's size, and one of them finds nothing in inputs as short as a word: all is said here
            reach = max(18, (len(content) + 4 * WINDOW).bit_length())
            params = zstandard.ZstdCompressionParameters(
                strategy=zstandard.STRATEGY_BTLAZY2, min_match=MATCH, search_log=SEARCH_LOG, target_length=32, window_log=reach, chain_log=reach, hash_log=reach, write_content_size=False, write_dict_id=False
            )
            content = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=params)
            return zstandard.ZstdCompressor(dict_data=content, compression_params=params)

        self.ordinary, self.toxic = map(compressor, (model.ordinary, model.toxic + model.ordinary))
        # zstandard looks for no match in the last bytes of its input: behind a word goes text that both dictionaries hold
        self.carrier = model.ordinary[-TAIL:]
        self.empty = len(self.ordinary.compress(self.carrier))
        self.words: dict[bytes, tuple[float, int]] = {}

    def cost(self, word: bytes) -> int:
        """Bytes that a word takes beside the toxic dictionary."""
        return len(self.toxic.compress(b" " + word + b" " + self.carrier)) - self.empty

    def saving(self, piece: bytes) -> tuple[float, int]:
        """The share of its cost that the toxic dictionary saves on a piece, and how many bytes this is."""
        cost = len(self.ordinary.compress(piece + self.carrier)) - self.empty
        saved = cost - (len(self.toxic.compress(piece + self.carrier)) - self.empty)
        return (saved / cost, saved) if saved > 0 else (0.0, 0)

    def saved_on(self, word: bytes) -> tuple[float, int]:
        """The largest saving on a word or, if it is longer than a piece, on the windows in it."""
        most = self.saving(b" " + word + b" ") if len(word) <= PIECE else (0.0, 0)
        for piece in pieces(word) if len(word) > PIECE else ():
            if self.saving(b" " + piece + b" ")[1]:
                inner = {piece[i : i + n] for n in WIDTHS for i in range(len(piece) - n + 1)}
                most = max(most, *(self.saving(w + b" ") for w in inner))
        return most

    def features(self, text: str) -> list[float]:
        """1, the largest saving, the largest share, savings weighted by their shares in all and by length, and the same over different words."""
        data = text.lower().encode()
        words = data.translate(_BLANK).split()
        missing = set(words).difference(self.words)
        if len(self.words) + len(missing) > CACHE_ENTRIES:
            self.words.clear()
            missing = set(words)
        known = self.words
        if len(missing) > CACHE_ENTRIES or len(data) > CACHE_BYTES:
            known = {}  # the words of a very long text are not kept
            missing = set(words)
        known.update((w, self.saved_on(w)) for w in missing)
        counts = Counter(w for w in words if known[w][1])
        if not counts:
            return [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]
        found = [known[w] for w in counts]
        kinds = sum(share * saved for share, saved in found)
        total = sum(known[w][0] * known[w][1] * n for w, n in counts.items())
        return [1.0, float(max(saved for _, saved in found)), max(share for share, _ in found), math.log1p(total), math.log1p(1000.0 * total / (len(data) + 500)), math.log1p(kinds)]


def _grams(word: bytes) -> set[bytes]:
    padded = b" " + word + b" "
    return {padded[i : i + GRAM] for i in range(len(padded) - GRAM + 1)}


def _passage(word: bytes, telling) -> bytes:
    """From the first to the last telling n-gram of a word; empty if it has none."""
    padded = b" " + word + b" "
    at = [i for i in range(len(padded) - GRAM + 1) if padded[i : i + GRAM] in telling]
    return padded[at[0] : at[-1] + GRAM] if at else b""


def _logistic(x, y):
    """Weights; none but the first is negative, so that a saving lowers no score."""
    import numpy as np

    w = np.zeros(x.shape[1])
    used = list(range(x.shape[1]))
    while True:
        w[:] = 0
        w[used] = _newton(x[:, used], y)
        worst = min(used[1:], key=w.__getitem__, default=0)
        if not worst or w[worst] >= 0:
            return w
        used.remove(worst)


def _newton(x, y):
    import numpy as np

    w = np.zeros(x.shape[1])
    penalty = 1e-2 * np.eye(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def trained(size: int, samples: list[bytes], **options) -> bytes:
    """A dictionary trained on samples; all of them if they are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, **options).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)


def toxic_dictionary(passages: list[tuple[bytes, int]]) -> bytes:
    """The dictionary trained on toxic text, given as ``(passage, documents with it)``, frequent ones first.

    A sample has a number of passages in a row, as training counts nothing in
    samples of a few bytes; the more documents have one, the more samples do.
    What training leaves out goes in front, farthest from the window.
    """
    samples, rounds = [], max((n for _, n in passages), default=0)
    for k in range(rounds):
        going = [p for p, n in passages if n > k]
        going = going[k % len(going) :] + going[: k % len(going)]  # other neighbours each time
        samples += [b"".join(going[i : i + 8]) for i in range(0, len(going), 8)]
    size = sum(len(p) for p, _ in passages)
    content = trained(max(1024, 2 * size), samples, k=TRAIN_STRETCH, d=TRAIN_MATCH) if samples else b""
    return b"".join([*(p for p, _ in reversed(passages) if p not in content), content])


def fit(docs: DataFrame, labels: DataFrame, where=None, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model of the labelled documents that ``where`` (a condition on ``labels``) admits."""
    import numpy as np

    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & (F.lit(True) if where is None else where))
    known = known.groupBy(F.col(id_col).alias("id")).agg((F.max(label) > 0).cast("int").alias("y"))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return Model(base=share)
    # ids of the sample: at most SAMPLE_DOCS rows a class
    sample = None
    for y in (0, 1):
        some = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)
        sample = some if sample is None else sample.unionByName(some)
    # the sample has two classes of at most SAMPLE_DOCS ids; a row for each
    learned = docs.select(F.col(id_col).alias("id"), F.lower(text_or_empty(text)).alias("text")).join(F.broadcast(sample), "id").groupBy("id", "y").agg(F.min("text").alias("text"))
    scratch = Scratch(docs.sparkSession)
    learned = scratch.cut(learned)  # read four times

    # document frequency of words in each class; near copies, which agree on the least or greatest hash of five words in a row, count once
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - 4, F.lit(1))), lambda i: F.xxhash64(F.slice("words", i, 5)))
    single = learned.select("y", F.split("text", _BETWEEN).alias("words")).withColumn("runs", runs)
    single = single.select("y", F.array_distinct("words").alias("words"), F.array_min("runs").alias("low"), F.array_max("runs").alias("high"))
    # of those the least stays, so that a rerun learns the same
    single = single.groupBy("y", "low").agg(F.min(F.struct("high", "words")).alias("one")).select("y", "one.*")
    single = scratch.cut(single.groupBy("y", "high").agg(F.min("words").alias("words")))
    n1, n0 = (max(1, single.where(F.col("y") == y).count()) for y in (1, 0))
    by_word = single.select("y", F.explode("words").alias("word")).where("word <> ''").groupBy("word").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    by_word = scratch.cut(by_word)

    def gram_counts(batches):
        import pyarrow as pa

        toxic, plain = Counter(), Counter()
        for part in slices(batches, 4096):
            for w, a, b in zip(part.column("word").to_pylist(), part.column("a").to_pylist(), part.column("b").to_pylist(), strict=True):
                for g in _grams(w.encode()):
                    toxic[g] += a
                    plain[g] += b
        keys = [g for g, a in toxic.items() if a]
        yield pa.record_batch([pa.array(keys, pa.binary()), pa.array([toxic[g] for g in keys], pa.int64()), pa.array([plain[g] for g in keys], pa.int64())], names=["gram", "a", "b"])
        keys = [g for g, a in toxic.items() if not a]
        yield pa.record_batch([pa.array(keys, pa.binary()), pa.array([0] * len(keys), pa.int64()), pa.array([plain[g] for g in keys], pa.int64())], names=["gram", "a", "b"])

    by_gram = by_word.mapInArrow(gram_counts, "gram binary, a long, b long").groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    apart = F.col("a") / n1 > LEAST_RATIO * (F.col("b") + 0.5) / n0
    telling = by_gram.where((F.col("a") >= LEAST_DOCS) & apart)  # as many as the sample has
    telling = frozenset(bytes(r["gram"]) for r in telling.select("gram").collect())
    shared = docs.sparkSession.sparkContext.broadcast(telling)

    def passages(batches):
        import pyarrow as pa

        for part in slices(batches, 4096):
            out = [(_passage(w.encode(), shared.value), a) for w, a in zip(part.column("word").to_pylist(), part.column("a").to_pylist(), strict=True)]
            out = [x for x in out if x[0]]
            yield pa.record_batch([pa.array([p for p, _ in out], pa.binary()), pa.array([a for _, a in out], pa.int64())], names=["passage", "a"])

    found = by_word.where("a > 0").mapInArrow(passages, "passage binary, a long")
    whole = by_word.where((F.col("a") >= LEAST_WORD_DOCS) & apart).select(F.concat(F.lit(" "), "word", F.lit(" ")).cast("binary").alias("passage"), "a")
    found = found.unionByName(whole).groupBy("passage").agg(F.sum("a").alias("a"))
    found = [(bytes(r["passage"]), r["a"]) for r in found.orderBy(F.desc("a"), "passage").collect()]

    def some_windows(batches):
        import zlib

        import pyarrow as pa

        for part in slices(batches):
            out = []
            for t in part.column("text").to_pylist():
                data = t.encode()
                out += [data[int(s) : int(s + n)] for s, n in zip(*windows(data), strict=True)]
            yield pa.record_batch([pa.array([zlib.crc32(w) for w in out], pa.int64()), pa.array(out, pa.binary())], names=["key", "window"])

    ordinary = learned.where("y = 0").orderBy(F.xxhash64("id"), "id").limit(TRAIN_DOCS).select("text").mapInArrow(some_windows, "key long, window binary").distinct()
    ordinary = [bytes(r["window"]) for r in ordinary.orderBy("key", "window").select("window").collect()]
    content = trained(DICTIONARY_BYTES, ordinary)
    model = Model(ordinary=content, toxic=toxic_dictionary(found))

    if found:
        first = docs.sparkSession.sparkContext.broadcast(model)

        def mistaken(batches):
            import pyarrow as pa

            distance = Distance(first.value)
            for part in slices(batches, 4096):
                words = zip(part.column("word").to_pylist(), part.column("b").to_pylist(), strict=True)
                out = [(p, b) for w, b in words for p in dict.fromkeys(pieces(w.encode())) if distance.saved_on(p)[1]]
                yield pa.record_batch([pa.array([w for w, _ in out], pa.binary()), pa.array([b for _, b in out], pa.int64())], names=["word", "b"])

        # words of ordinary documents, or their pieces, that save bytes, as they are part of a toxic passage: the ordinary dictionary gets them too
        wrong = by_word.where((F.col("b") >= LEAST_WORD_DOCS) & ~apart).select("word", "b").mapInArrow(mistaken, "word binary, b long").groupBy("word").agg(F.sum("b").alias("b"))
        wrong = [bytes(r["word"]) for r in wrong.orderBy(F.desc("b"), "word").select("word").collect()]
        if wrong:
            model.ordinary = b" ".join([b"", *reversed(wrong), content])

    rows = score_features(learned, model, "text", ["id", "y"]).orderBy("id").select("y", "features").collect()  # in order, so that sums don't depend on partitions
    scratch.drop(learned, single, by_word)
    x, y = np.array([r["features"] for r in rows], dtype=np.float64), np.array([r["y"] for r in rows], dtype=np.float64)
    if len(set(y.tolist())) < 2:
        return Model(base=share)
    w = _logistic(x, y)
    # the sample may hold another share of toxic documents than the labels
    w[0] += math.log(share / (1 - share)) - math.log(y.mean() / (1 - y.mean()))
    model.weights = w.tolist()
    return model


def score_features(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, name: str = "features") -> DataFrame:
    """The columns ``keep`` (all, by default) of ``docs`` and an array ``name`` of feature values."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of bounded size
    token = hash((model.ordinary, model.toxic))
    kept = [c for c in (docs.columns if keep is None else keep) if c != name]
    reads = f"_{kept.index(text)}" if text in kept else "_text"  # a kept text isn't sent twice

    def run(batches):
        import pyarrow as pa

        features = hold(("distance", token), lambda: Distance(shared.value)).features
        for part in slices(batches):
            values = pa.array([features(t or "") for t in part.column(reads).to_pylist()], pa.list_(pa.float64()))
            yield pa.record_batch([*(part.column(f"_{i}") for i in range(len(kept))), values], names=[*(f"_{i}" for i in range(len(kept))), "out"])

    rows = docs.select(*[docs[c].alias(f"_{i}") for i, c in enumerate(kept)], *([] if text in kept else [text_or_empty(text).alias("_text")]))
    kinds = "".join(f"_{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(kept))
    return rows.mapInArrow(run, f"{kinds}out array<double>").select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(kept)], F.col("out").alias(name))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """The columns ``keep`` (all, by default) of ``docs``, a score from 0 to 1 and whether it reaches the threshold (1 or 0)."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    if not model.weights:
        scored = docs.select(*kept, F.lit(float(model.base)).alias(names[0]))
    else:
        name = free_name("features", docs.columns)
        scored = score_features(docs, model, text, kept, name)
        terms = [F.col(name)[i] * F.lit(w) for i, w in enumerate(model.weights)]
        scored = scored.select(*kept, (1 / (1 + F.exp(-sum(terms[1:], terms[0])))).alias(names[0]))
    return scored.withColumn(names[1], (F.col(names[0]) >= threshold).cast("int"))
