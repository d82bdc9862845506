"""Vector codes: vectors as indexes into a codebook for each of their parts.

Components become integers, ``floor(scale * x)``, and vectors are cut into
consecutive parts. Codebooks are improved in rounds: every part goes to its
nearest entry, and an entry becomes the floor of the mean of its parts. All of
it is integer arithmetic, so results depend on no order of rows.

**Nearest entries by annular norm pruning.** By the triangle inequality an
entry within distance ``d`` of a part has a norm within ``d`` of the part's.
Entries are sorted by norm; a part starts at the entry of nearest norm, and a
binary search gives the interval of norms that its best distance so far allows,
both ends included. What lies in that annulus is evaluated exactly, nearest
norms first and a few entries at a time; after each step the interval is
searched anew with the better distance, until nothing in it is left. Norms are
floating numbers, so the interval is wider by more than their error; distances
are exact integers, and of equal ones the lower index wins.

**Spark.** A round is one pass over the vectors without a shuffle of them: a
task adds up its parts by codebook entry and sends one row of sums for each
component of an entry, which Spark adds up. What the driver sees is the size of
the codebooks, whatever the table has. Give a written table, it is read once a
round and twice more.

Defined results
---------------
* vectors that are null or hold null or non-finite components are dropped; all others stay, zero and repeated ones too;
* a table whose vectors differ in length is read as if zeros followed up to the
  longest, and so is one whose length ``parts`` does not divide;
* the first codebook has the vectors of the smallest ids, null last, equal ids by vector;
  with fewer vectors than entries, codebooks have as many entries as there are vectors;
* numbers whose squares don't fit 64 bits are compared as Python integers, with all entries; an error that does not fit is null;
* errors are summed over equal labels, null labels together;
* repeated rows stay; other input columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Entries on either side of a part's norm that one step evaluates.
STEP = 4
#: Vectors that a task handles at once.
BATCH_ROWS = 2048
#: Sums travel in pieces of so many bits, so that any number of tasks adds up in 64.
LIMB = 40


def usable(v: Column) -> Column:
    """Vectors without null or non-finite components."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite, F.lit(False))


def largest(width: int) -> int:
    """Integers up to this, either sign, have distances over ``width`` components that fit 64 bits."""
    return math.isqrt((1 << 62) // max(1, width)) // 2


def integers(column, width: int, scale: int = SCALE):
    """``rows x width`` integers of an Arrow column of lists: 64-bit ones, or Python's if some are too large."""
    import numpy as np
    import pyarrow as pa

    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    values = np.zeros((len(column), width), dtype=np.float64)
    inside = np.arange(width) < lengths[:, None]
    if pa.types.is_integer(flat.type) or pa.types.is_decimal(flat.type):  # may have more digits than a floating number
        exact = np.zeros((len(column), width), dtype=object)
        exact[inside] = [math.floor(scale * x) for x in flat.to_pylist()]
    else:
        values[inside] = flat.to_numpy(zero_copy_only=False)
        scaled = np.floor(values * scale)  # exact: the scale is a power of two
        if not len(scaled) or np.abs(scaled).max(initial=0) <= largest(width):
            return scaled.astype(np.int64)
        exact = np.array([[math.floor(scale * x) if abs(x) < 1e18 else scale * int(x) for x in row] for row in values.tolist()], dtype=object).reshape(len(column), width)
    return exact.astype(np.int64) if all(abs(x) <= largest(width) for x in exact.ravel()) else exact


@dataclass
class Codebook:
    """``parts x entries x width`` integers, and what the search needs: the entries of each part sorted by norm."""

    entries: object

    def __post_init__(self):
        import numpy as np

        parts, n, width = self.entries.shape
        if all(abs(x) <= largest(parts * width) for x in self.entries.ravel().tolist()):
            self.entries = self.entries.astype(np.int64)
            norms = np.sqrt((self.entries.astype(np.float64) ** 2).sum(axis=2))
            self.order = np.argsort(norms, axis=1, kind="stable")
            self.norms = np.take_along_axis(norms, self.order, axis=1)
            self.sorted = np.take_along_axis(self.entries, self.order[:, :, None], axis=1)
        else:
            self.order = None

    def nearest(self, part: int, x, counted: list | None = None):
        """``(index, squared distance)`` of the nearest entry of each row of ``x``; ``counted`` gets the number of distances evaluated."""
        import numpy as np

        if self.order is None or x.dtype == object:  # numbers of any size: all entries
            entries = self.entries[part].astype(object)
            distance = np.array([[sum((a - b) ** 2 for a, b in zip(row, e, strict=True)) for e in entries.tolist()] for row in x.astype(object).tolist()], dtype=object).reshape(len(x), len(entries))
            index = np.array([min(range(len(d)), key=d.__getitem__) for d in distance.tolist()], dtype=np.int64)
            return index, distance[np.arange(len(x)), index]
        norms, order, entries = self.norms[part], self.order[part], self.sorted[part]
        k = len(norms)
        own = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        best = np.full(len(x), np.iinfo(np.int64).max)
        index = np.full(len(x), k)
        alive = np.arange(len(x))
        low = np.clip(np.searchsorted(norms, own) - STEP // 2, 0, max(0, k - STEP))  # the first entries: those of nearest norm
        take_low, take_high = low, np.minimum(low + STEP, k)
        seen_low, seen_high = low.copy(), take_high.copy()
        sides = [(take_low, take_high)]
        while len(alive):
            for start, end in sides:
                for j in range(STEP):
                    at = start + j
                    on = np.flatnonzero(at < end)
                    if not len(on):
                        break
                    rows, at = alive[on], at[on]
                    distance = ((x[rows] - entries[at]) ** 2).sum(axis=1)
                    original = order[at]
                    better = (distance < best[rows]) | ((distance == best[rows]) & (original < index[rows]))
                    best[rows[better]], index[rows[better]] = distance[better], original[better]
                    if counted is not None:
                        counted.append(len(on))
            # the annulus that the best distance allows, ends included and wider than the error of the norms
            reach = np.sqrt(best[alive].astype(np.float64)) * (1 + 1e-9) + own[alive] * 1e-9 + 1e-6
            low = np.searchsorted(norms, own[alive] - reach, side="left")
            high = np.searchsorted(norms, own[alive] + reach, side="right")
            left, right = seen_low[alive] > low, seen_high[alive] < high
            more = left | right
            alive, low, high = alive[more], low[more], high[more]
            down, up = seen_low[alive], seen_high[alive]
            new_down, new_up = np.maximum(np.minimum(down, low), down - STEP), np.minimum(np.maximum(up, high), up + STEP)
            sides = [(new_down, down), (up, new_up)]
            seen_low[alive], seen_high[alive] = new_down, new_up
        return index, best

    def text(self) -> str:
        """All components in decimal, by part, entry and position."""
        return ",".join(map(str, self.entries.ravel().tolist()))


def assign(vectors, book: Codebook):
    """``rows x parts`` indexes and squared distances."""
    import numpy as np

    parts, _, width = book.entries.shape
    codes, errors = np.zeros((len(vectors), parts), dtype=np.int64), np.zeros((len(vectors), parts), dtype=vectors.dtype if book.order is not None else object)
    for p in range(parts):
        codes[:, p], errors[:, p] = book.nearest(p, vectors[:, p * width : (p + 1) * width])
    return codes, errors


def _pieces(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def _limbs(number: int):
    """``(position, piece)`` of an integer: pieces times ``2 ** (LIMB * position)`` add up to it."""
    at, edge = 0, 1 << (LIMB - 1)
    while not -edge <= number < edge:
        yield at, number & ((1 << LIMB) - 1)
        number >>= LIMB
        at += 1
    yield at, number


def _sums(vectors: DataFrame, book: Codebook, width: int, scale: int):
    """The next codebook: one pass, in which every task adds up the parts of each entry."""
    import numpy as np

    parts, n, each = book.entries.shape
    shared = vectors.sparkSession.sparkContext.broadcast(book)  # parts x entries x width numbers

    def run(batches):
        import pyarrow as pa

        counts = np.zeros((parts, n), dtype=np.int64)
        totals = np.zeros((parts, n, each), dtype=object)
        for piece in _pieces(batches):
            x = integers(piece.column("v"), width, scale)
            codes, _ = assign(x, shared.value)
            for p in range(parts):
                mine = x[:, p * each : (p + 1) * each]
                sums = np.zeros((n, each), dtype=x.dtype)
                np.add.at(sums, codes[:, p], mine)
                totals[p] += sums
                counts[p] += np.bincount(codes[:, p], minlength=n)
        out = [(p * n + e, -1, 0, int(counts[p, e])) for p, e in zip(*np.nonzero(counts), strict=True)]
        out += [(int(p * n + e), c, at, piece) for p, e in zip(*np.nonzero(counts), strict=True) for c in range(each) for at, piece in _limbs(int(totals[p, e, c]))]
        entry, component, limb, value = zip(*out, strict=True) if out else ((),) * 4
        yield pa.record_batch([pa.array(entry, pa.int32()), pa.array(component, pa.int32()), pa.array(limb, pa.int32()), pa.array(value, pa.int64())], names=["entry", "component", "limb", "value"])

    rows = vectors.select("v").mapInArrow(run, "entry int, component int, limb int, value long").groupBy("entry", "component", "limb").agg(F.sum("value").alias("value")).collect()  # the size of the codebook
    counts, totals = {}, {}
    for r in rows:
        if r["component"] < 0:
            counts[r["entry"]] = r["value"]
        else:
            key = r["entry"], r["component"]
            totals[key] = totals.get(key, 0) + (r["value"] << (LIMB * r["limb"]))
    entries = book.entries.astype(object)
    for (entry, component), total in totals.items():
        entries[entry // n, entry % n, component] = total // counts[entry]  # Python's division of integers is the floor
    return Codebook(entries)


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, id_col: str = "vec_id", vector: str = "embedding") -> Codebook:
    """The codebooks of a table; one without usable vectors has no entries."""
    import numpy as np
    import pyarrow as pa

    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("v")).where(usable(F.col("v")))
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    each = -(-longest // parts)
    first = rows.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").toArrow()  # as many vectors as a codebook has entries
    column = first.column("v").combine_chunks() if first.num_rows else pa.array([], pa.list_(pa.float64()))
    start = integers(column, parts * each, scale).reshape(first.num_rows, parts, each)
    book = Codebook(np.ascontiguousarray(start.transpose(1, 0, 2)))
    for _ in range(rounds if first.num_rows else 0):
        book = _sums(rows, book, parts * each, scale)
    return book


def encode(vectors: DataFrame, book: Codebook, scale: int = SCALE, keep: tuple[str, ...] = ("vec_id", "label"), vector: str = "embedding") -> DataFrame:
    """The columns ``keep`` of usable vectors, ``code`` (two hex digits a part) and ``error``."""
    shared = vectors.sparkSession.sparkContext.broadcast(book)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        parts, _, each = shared.value.entries.shape
        for piece in _pieces(batches):
            codes, errors = assign(integers(piece.column("v"), parts * each, scale), shared.value)
            total = [e if e < 1 << 63 else None for e in errors.sum(axis=1).tolist()]
            text = codes.astype(np.uint8).tobytes().hex()
            yield pa.record_batch([*piece.columns[:-1], pa.array([text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)], pa.string()), pa.array(total, pa.int64())], names=[*piece.schema.names[:-1], "code", "error"])

    rows = vectors.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], F.col(vector).alias("v")).where(usable(F.col("v")))
    kind = "".join(f"_{i} {vectors.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep)) + "code string, error long"
    return rows.mapInArrow(run, kind).select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "code", "error")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``id, code, error, label_error, codebooks_sha256`` of every usable vector.

    ``label_error`` is summed before it is shuffled, and joined by merge, whose
    large partitions adaptive execution splits if one label has much of the table.
    """
    book = fit(vectors, parts, entries, rounds, scale, id_col, vector)
    digest = hashlib.sha256(book.text().encode()).hexdigest()
    coded = Scratch(vectors.sparkSession).cut(encode(vectors, book, scale, (id_col, label), vector).toDF("id", "label", "code", "error"))
    sums = coded.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("label", "of")
    joined = coded.join(sums.hint("merge"), F.col("label").eqNullSafe(F.col("of")))
    return joined.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
