"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point alone.
An n-gram is the product of its letters' vectors, each rotated by its place;
a text is the sum of its n-grams; a language is the sum of the learned texts
of that language, each text weighing the same. A document gets the language
whose prototype has the largest cosine with the document's vector.

The vector of a text is never built n-gram by n-gram: the n-grams of a slice of
texts are counted with integer codes, the vectors of the distinct ones are made
once per slice, and a matrix product bundles all texts of the slice.

Defined results
---------------
* null text, or one without a letter: language ``und``, score 0; a single letter is enough for a language;
* rows with a null language are not learned from; with nothing learned, every
  document is ``und``;
* ties between languages: the one first in order; repeated rows stay;
* texts are read whole; input columns other than id and text don't matter;
* an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hold, slices, text_or_empty

DIMENSIONS = 1024
N = 3
#: N-grams whose vectors are held at once.
BLOCK = 8192
#: Fixed-point unit of learned sums, so that they don't depend on the order of adding.
UNIT = 1 << 24



def letter_vector(code: int):
    """The vector of a code point; 0 stands for any run of non-letters."""
    import numpy as np

    letters = _tables()[0]
    if code not in letters:
        bits = np.random.Generator(np.random.Philox(key=code)).integers(0, 2, DIMENSIONS, dtype=np.int8)
        letters[code] = (2 * bits - 1).astype(np.int8)
    return letters[code]


def _tables():
    """The vectors of letters met so far, and which code points are letters."""
    import numpy as np

    return hold("letters", lambda: ({}, np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)))


def ngram_codes(texts: list[str]):
    """``(rows, codes, letters)``: every n-gram of every text, in text order.

    A code is a number in base ``len(letters)``, the last letter lowest;
    ``rows`` tells the text. A text has a gap at either end, so that each of
    its letters is in an n-gram. N-grams without a letter are left out.
    """
    import numpy as np

    lowered = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    parts = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    letter = _tables()[1][points]
    first = np.ones(len(points), dtype=bool)
    first[1:] = parts[1:] != parts[:-1]
    keep = letter | first
    keep[1:] |= letter[:-1]  # of a run of non-letters the first stays, as a gap
    points, parts, letter = np.where(letter, points, 0)[keep], parts[keep], letter[keep]
    if len(points) < N:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(0, dtype=np.uint32)
    seen = np.zeros(int(points.max()) + 1, dtype=bool)
    seen[points] = True
    letters = np.flatnonzero(seen)
    place = np.zeros(len(seen), dtype=np.int64)
    place[letters] = np.arange(len(letters))
    place = place[points]
    window = len(points) - N + 1
    code, some = np.zeros(window, dtype=np.int64), np.zeros(window, dtype=bool)
    for k in range(N):
        code = code * len(letters) + place[k : k + window]
        some |= letter[k : k + window]
    some &= parts[:window] == parts[N - 1 :]
    return parts[:window][some], code[some], letters


def bundle(texts: list[str], groups=None, size: int | None = None):
    """``(vectors, counts)``: the bundled n-grams of each text, and how many there are.

    With ``groups`` (a number below ``size`` for each text) the texts of a
    group are bundled together, each text weighing 1.
    """
    import numpy as np

    rows, code, letters = ngram_codes(texts)
    counts = np.bincount(rows, minlength=len(texts)).astype(np.float64)
    base = max(1, len(letters))
    if base**N <= 1 << 22:
        seen = np.zeros(base**N, dtype=bool)
        seen[code] = True
        codes = np.flatnonzero(seen)
        column = np.zeros(base**N, dtype=np.int64)
        column[codes] = np.arange(len(codes))
        column = column[code]
    else:
        codes, column = np.unique(code, return_inverse=True)
    weights = None
    if groups is not None:
        weights = (1.0 / np.maximum(counts, 1))[rows]
        rows = np.asarray(groups)[rows]
    n = len(texts) if groups is None else size
    out = np.zeros((n, DIMENSIONS), dtype=np.float32)
    for at in range(0, len(codes), BLOCK):
        block = codes[at : at + BLOCK]
        inside = slice(None) if len(codes) <= BLOCK else (column >= at) & (column < at + BLOCK)
        cells = rows[inside] * len(block) + column[inside] - at
        table = np.bincount(cells, None if weights is None else weights[inside], minlength=n * len(block))
        out += table.reshape(n, len(block)).astype(np.float32) @ ngram_vectors(letters, block)
    return out, counts


def ngram_vectors(letters, codes):
    """One row per n-gram: the product of its letters' vectors, rotated by place."""
    import numpy as np

    table = np.stack([letter_vector(int(c)) for c in letters]) if len(letters) else np.zeros((1, DIMENSIONS), np.int8)
    base, out = max(1, len(letters)), np.ones((len(codes), DIMENSIONS), dtype=np.int8)
    for k in range(N):
        out *= np.roll(table, N - 1 - k, axis=1)[(codes // base ** (N - 1 - k)) % base]
    return out.astype(np.float32)


def learn(docs: DataFrame, where: Column | None = None, text: str = "text", lang: str = "lang") -> dict[str, list[int]]:
    """Prototypes of all languages in ``docs``: fixed-point sums over every row that ``where`` admits.

    Tasks send partial sums, a number per language and dimension; the driver
    gets one vector per language.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.lit(True) if where is None else where)).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        sums: dict[str, object] = {}
        for part in slices(batches):
            langs = part.column("lang").to_pylist()
            names = sorted(set(langs))
            vectors, _ = bundle(part.column("text").to_pylist(), [names.index(x) for x in langs], len(names))
            for name, v in zip(names, vectors, strict=True):
                sums[name] = sums.get(name, 0) + np.rint(v.astype(np.float64) * UNIT).astype(np.int64)
        if sums:
            yield pa.record_batch([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], names=["lang", "sums"])

    partial = rows.mapInArrow(run, "lang string, sums array<long>")
    summed = partial.select("lang", F.posexplode("sums").alias("i", "v")).groupBy("lang", "i").agg(F.sum("v").alias("v"))
    whole = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("s")).select("lang", F.transform("s", lambda x: x["v"]).alias("sums"))
    return {r["lang"]: r["sums"] for r in whole.orderBy("lang").collect()}


def classify(docs: DataFrame, prototypes: dict[str, list[int]], text: str = "text", keep: list[str] | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns ``keep`` (all, by default) of ``docs``, the language and its cosine (not below 0)."""
    langs = sorted(prototypes)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    reads = f"_{kept.index(text)}" if text in kept else "_text"  # a kept text isn't sent twice
    model = docs.sparkSession.sparkContext.broadcast((langs, [prototypes[n] for n in langs]))  # a vector per language

    def run(batches):
        import numpy as np
        import pyarrow as pa

        langs, sums = model.value
        protos = np.array(sums, dtype=np.float64).reshape(len(langs), DIMENSIONS)
        protos = (protos / np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-12)).T.astype(np.float32)
        for part in slices(batches):
            bundles, counts = bundle([t or "" for t in part.column(reads).to_pylist()])
            best, score, some = np.zeros(part.num_rows, dtype=int), np.zeros(part.num_rows), counts > 0
            if langs and part.num_rows:
                cosines = (bundles @ protos) / np.maximum(np.linalg.norm(bundles, axis=1, keepdims=True), 1e-12)
                best, score = cosines.argmax(axis=1), np.clip(cosines.max(axis=1), 0.0, 1.0)
            found = [langs[b] if ok and langs else "und" for b, ok in zip(best, some, strict=True)]
            values = [pa.array(found, pa.string()), pa.array(np.where(some, score, 0.0).astype(np.float64))]
            yield pa.record_batch([*(part.column(f"_{i}") for i in range(len(kept))), *values], names=[*(f"_{i}" for i in range(len(kept))), "lang", "score"])

    rows = docs.select(*[docs[c].alias(f"_{i}") for i, c in enumerate(kept)], *([] if text in kept else [text_or_empty(text).alias("_text")]))
    kinds = "".join(f"_{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(kept))
    out = rows.mapInArrow(run, f"{kinds}lang string, score double")
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(kept)], F.col("lang").alias(names[0]), F.col("score").alias(names[1]))
