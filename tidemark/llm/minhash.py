"""Near-duplicate classes by DartMinHash signatures, banded joins and exact checks.

**Signatures.** A document is a weighted set of word shingles (weight 1 each by
default, or their counts). For every element the plane *weight x rank* is cut
into unit cells; a hash of element and cell tells how many darts (Poisson with
mean 1) lie in the cell and where. Darts beyond the element's weight are
ignored. Every dart belongs to one coordinate of the signature, and the dart of
lowest rank per coordinate is kept. As darts depend on element and cell alone,
two documents agree on a coordinate with probability equal to their weighted
Jaccard similarity. A document of total weight W looks at ranks up to t / W
for about t = k ln k + 2k darts in all, and further only while a coordinate has
none, so the work is linear in t + W however large k is.

**Classes.** Equal word sequences are folded first. Of the rest, every band of
the signature is a bucket; members are compared with one representative per
bucket, the smallest id. A pair is a link if the exact Jaccard similarity of its shingle sets
reaches the threshold. Connected links form classes. Buckets that then still
hold several classes lack comparisons: two members may be alike though neither
resembles the representative. There, every member outside the bucket's largest
class is compared with all members, exactly and in blocks: a task holds two
blocks of sets and multiplies their incidence matrices, so that pairs which are
no links never become rows. Copies and tight groups of any size thus cost a
comparison per document, and no pair of different texts that shares a band is
left out.

**Texts.** Only ids and band keys of all documents are written. The sets that
exact checks need are made again from the texts, for documents in a candidate
pair alone; a bitmap, sized by their count, tells those apart before any shuffle (a
false hit costs time, a join with the ids follows).

Defined results
---------------
* words are maximal runs of characters other than space, tab, line feed, vertical tab, form feed
  and carriage return, A-Z taken as a-z; a text of fewer than five words is one shingle of all its words;
* null text is empty; documents without a word are copies of one another;
* the class id is the smallest document id in the class, alone or not;
* repeated rows (same id and text) give repeated rows with the same class; a null id never stands for a class;
* rows of one id with different texts have their own classes, that of each text
* an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, free_name, hold, slices, text_or_empty

WORDS = 5
SIMILARITY = 0.8
#: 24 bands of 5 rows: a pair at similarity 0.8 shares a band with probability 0.9999.
BANDS, ROWS = 24, 5
COORDINATES = BANDS * ROWS
#: Bits of the bitmap of candidate ids for each candidate, and in all (16 MB); with more candidates the texts are joined with the ids instead.
BITS_PER_ID, MOST_BITS = 16, 1 << 27
#: Bits of a stretch of it, which one task makes: 64 kB.
STRETCH_BITS = 1 << 19
#: Length of the kept tables of powers: what a slice of texts needs; a longer text gets tables of its own, for as long as it is worked on.
KEPT_POWERS = (1 << 20) + (1 << 12)
#: Sets of a bucket and elements in them that meet in one task, and rows and columns of the matrices multiplied at once.
BLOCK_ROWS, BLOCK_SUM, BLOCK_PART, BLOCK_ELEMENTS = 4096, 1 << 20, 512, 2048

# ------------------------------------------------------------- hashing in numpy

_A, _B, _C = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB  # splitmix64 constants; fixed values
#: Cumulative Poisson(1) probabilities as 32-bit thresholds.
_POISSON = None


def mix(x):
    """The splitmix64 finalizer on an array of unsigned 64-bit numbers."""
    import numpy as np

    x = x + np.uint64(_A)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_B)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_C)
    return x ^ (x >> np.uint64(31))


def _power_table(size: int):
    """Powers of an odd base and of its inverse, modulo 2^64."""
    import numpy as np

    def make(size):
        base = np.uint64(0x100000001B3)
        inverse = np.uint64(pow(0x100000001B3, -1, 1 << 64))
        with np.errstate(over="ignore"):
            up = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size - 1, base))])
            down = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size - 1, inverse))])
        return up, down

    return make(size) if size > KEPT_POWERS else hold("shingle powers", lambda: make(KEPT_POWERS))


def word_hashes(data):
    """Hashes of the words in a byte array, and where each starts."""
    import numpy as np

    up, down = _power_table(len(data) + 1)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64)
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(lower) * up[: len(data)], dtype=np.uint64)])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts, width: int = WORDS):
    """``(hashes, owner, words)`` of a slice: distinct shingles of each text, sorted by owner and hash.

    ``words`` is the hash of the whole word sequence, 0 for none.
    """
    import numpy as np

    encoded = [t.encode() for t in texts]
    size = np.array([len(e) + 1 for e in encoded], dtype=np.int64)
    data = np.frombuffer(b" ".join(encoded) + b" ", dtype=np.uint8)
    ends = np.cumsum(size)
    hashes, starts = word_hashes(data)
    owner = np.searchsorted(ends, starts, side="right")
    count = np.bincount(owner, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    with np.errstate(over="ignore"):
        # position inside the document makes a sum of mixed words an ordered hash of the sequence
        position = np.arange(len(hashes)) - first[owner]
        keyed = mix(hashes ^ (position.astype(np.uint64) * np.uint64(_C)))
        total = np.concatenate([[np.uint64(0)], np.cumsum(keyed, dtype=np.uint64)])
        words = np.where(count > 0, mix(total[first + count] - total[first] + count.astype(np.uint64)), np.uint64(0))
        window = len(hashes) - width + 1
        if window > 0:
            h = np.zeros(window, dtype=np.uint64)
            for k in range(width):
                h = mix(h * np.uint64(_B) + hashes[k : k + window])
            whole = owner[:window] == owner[width - 1 :]
            h, own = h[whole], owner[:window][whole]
        else:
            h, own = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    short = np.flatnonzero(count < width)
    h, own = np.concatenate([h, words[short]]), np.concatenate([own, short])
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    times = np.diff(np.append(np.flatnonzero(new), len(h)))
    return h[new], own[new], times, words


def _darts(element, cell_weight, cell_rank):
    """All darts of some (element, weight cell, rank cell) triples: ``(which triple, weight, rank, identity)``."""
    global _POISSON
    import math

    import numpy as np

    if _POISSON is None:
        _POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])
    with np.errstate(over="ignore"):
        seed = mix(mix(element ^ (cell_weight.astype(np.uint64) * np.uint64(_B))) + cell_rank.astype(np.uint64) * np.uint64(_A))
        uniform = (seed >> np.uint64(11)).astype(np.float64) * 2.0**-53
        many = np.searchsorted(_POISSON, uniform)
        which = np.repeat(np.arange(len(element)), many)
        number = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        identity = mix(seed[which] + (number + 1).astype(np.uint64) * np.uint64(_C))
        place = mix(identity)
    rank = cell_rank[which] + (place >> np.uint64(32)).astype(np.float64) * 2.0**-32
    weight = cell_weight[which] + (place & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32
    return which, weight, rank, identity


def dart_signatures(hashes, owner, weights, texts: int, k: int = COORDINATES):
    """``texts x k`` signatures of the weighted sets given as parallel arrays (sorted by owner)."""
    import math

    import numpy as np

    signature = np.zeros((texts, k), dtype=np.uint64)
    lowest = np.full((texts, k), np.inf)
    total = np.bincount(owner, weights=weights, minlength=texts)
    limit = (k * math.log(k) + 2 * k) / np.maximum(total, 1e-9)
    todo = total > 0
    while todo.any():
        mine = todo[owner]
        element, own, weight = hashes[mine], owner[mine], weights[mine]
        ranks, columns = np.ceil(limit[own]).astype(np.int64), np.ceil(weight).astype(np.int64)
        cells = ranks * columns
        at = np.repeat(np.arange(len(element)), cells)
        number = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells)
        which, dart_weight, rank, identity = _darts(element[at], number % columns[at], number // columns[at])
        at = at[which]
        hit = (dart_weight < weight[at]) & (rank < limit[own[at]])
        at, rank, identity = own[at[hit]], rank[hit], identity[hit]
        with np.errstate(over="ignore"):
            slot = at * k + (mix(identity ^ np.uint64(_A)) % np.uint64(k)).astype(np.int64)
        order = np.argsort(-rank)  # of several darts in a slot the one written last, of lowest rank, stays
        lowest.ravel()[slot[order]], signature.ravel()[slot[order]] = rank[order], identity[order]
        # a coordinate without a dart: look again, at twice as many ranks
        todo &= np.isinf(lowest).any(axis=1)
        limit[todo] *= 2
    return signature


def band_keys(signature, bands: int = BANDS, rows: int = ROWS):
    """One 64-bit key per band, different bands having different keys."""
    import numpy as np

    keys = np.zeros((len(signature), bands), dtype=np.uint64)
    with np.errstate(over="ignore"):
        keys += np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(_A)
        for r in range(rows):
            keys = mix(keys * np.uint64(_B) + signature[:, r::rows][:, :bands])
    return keys


# ------------------------------------------------------------------- the joins


def sketch(docs: DataFrame, id_col: str = "doc_id", text: str = "text", weighting: str = "set") -> DataFrame:
    """``id, words, bands`` of every row: a hash of the word sequence (0: no word) and the keys of the bands."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for part in slices(batches):
            n = part.num_rows
            hashes, owner, times, words = shingle_sets(part.column("text").to_pylist())
            keys = band_keys(dart_signatures(hashes, owner, times.astype(np.float64) if weighting == "count" else np.ones(len(hashes)), n))
            bands = pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel().view(np.int64)))
            yield pa.record_batch([part.column("id"), pa.array(words.view(np.int64)), bands], names=["id", "words", "bands"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, "id long, words long, bands array<long>")


def element_sets(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", text: str = "text", weighting: str = "set") -> DataFrame:
    """``id, elements`` for the ids in ``ids``, one row each: the set that exact checks compare.

    Elements are 64-bit hashes of shingles and, with ``weighting="count"``, of
    each of their repetitions, so that the Jaccard similarity of the sets is
    the weighted one. ``ids`` should be a written table of distinct ids, it is
    read twice.
    """
    many = ids.count()
    bits = 1 << max(16, (many * BITS_PER_ID).bit_length())
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text).alias("text")).where("id is not null")
    rows = rows.withColumn("bit", F.pmod(F.xxhash64("id"), F.lit(bits)).cast("long"))
    if bits > MOST_BITS:  # too many for a bitmap: only texts of candidates go on
        rows, bitmap = rows.join(ids.select("id").hint("merge"), "id", "left_semi"), None
    else:
        bitmap = docs.sparkSession.sparkContext.broadcast(id_bitmap(ids, bits))  # at most MOST_BITS / 8 bytes

    def run(batches):
        import numpy as np
        import pyarrow as pa

        known = None if bitmap is None else np.frombuffer(bitmap.value, dtype=np.uint8)
        for batch in batches:
            if known is not None:
                bit = batch.column("bit").to_numpy()
                batch = batch.filter(pa.array((known[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1))
            for part in slices([batch]):
                n = part.num_rows
                hashes, owner, times, _ = shingle_sets(part.column("text").to_pylist())
                if weighting == "count":
                    number = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    with np.errstate(over="ignore"):
                        hashes, owner = mix(np.repeat(hashes, times) + number.astype(np.uint64)), np.repeat(owner, times)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
                yield pa.record_batch([part.column("id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.view(np.int64)))], names=["id", "elements"])

    sets = rows.mapInArrow(run, "id long, elements array<long>")
    # of several texts of one id the smallest set stays, on every run
    return sets.join(ids.select("id").hint("merge"), "id", "left_semi").groupBy("id").agg(F.min("elements").alias("elements"))


def id_bitmap(ids: DataFrame, bits: int) -> bytes:
    """A bit for the hash of every id: all ids have theirs set, and about one in ``BITS_PER_ID`` of all others.

    Ids are dealt by stretches of the bitmap, so the driver gets each stretch once, as bytes.
    """
    import numpy as np

    size = min(bits, STRETCH_BITS)
    bit = F.pmod(F.xxhash64("id"), F.lit(bits)).cast("long")
    spots = ids.select(F.floor(bit / size).cast("int").alias("stretch"), (bit % size).cast("int").alias("at")).distinct().repartition("stretch")

    def run(batches):
        import pyarrow as pa

        found: dict[int, object] = {}
        for batch in batches:
            stretch, at = (c.to_numpy() for c in batch.columns)
            for k in np.unique(stretch).tolist():
                mine = at[stretch == k]
                np.bitwise_or.at(found.setdefault(k, np.zeros(size // 8, dtype=np.uint8)), mine >> 3, (1 << (mine & 7)).astype(np.uint8))
        yield pa.record_batch([pa.array(list(found), pa.int32()), pa.array([x.tobytes() for x in found.values()], pa.binary())], names=["stretch", "bytes"])

    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    for r in spots.mapInArrow(run, "stretch int, bytes binary").collect():  # bits / 8 bytes in all
        bitmap[r["stretch"] * (size // 8) :][: size // 8] = np.frombuffer(r["bytes"], dtype=np.uint8)
    return bitmap.tobytes()


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose sets (``id, elements``) have at least this Jaccard similarity."""
    left = sets.select(F.col("id").alias("a"), F.col("elements").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("elements").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    # b, the head of a bucket, may be in most pairs: a merge join, which adaptive execution splits
    return pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a").where(shared >= similarity * (F.size("x") + F.size("y") - shared)).select("a", "b")


def _block_links(similarity: float):
    """Links between the sets of a block of minor members and those of a block of members of one bucket."""

    def run(minors, members):
        import numpy as np
        import pyarrow as pa

        def sets(t, prefix=""):
            elements = t.column(f"{prefix}elements").combine_chunks()
            return t.column(f"{prefix}id").to_numpy(), t.column(f"{prefix}label").to_numpy(), np.diff(elements.offsets.to_numpy()), elements.values.to_numpy()[elements.offsets[0].as_py() : elements.offsets[-1].as_py()]

        found = ([], [])
        if minors.num_rows and members.num_rows:
            id_x, label_x, n_x, x = sets(minors, "minor_")
            id_y, label_y, n_y, y = sets(members)
            row_x, row_y = np.repeat(np.arange(len(n_x)), n_x), np.repeat(np.arange(len(n_y)), n_y)
            # what one document alone holds is shared with nobody; a minor member may or may not be in this block of members, too
            values, count = np.unique(np.concatenate([y, x[~np.isin(id_x, id_y)[row_x]]]), return_counts=True)
            values = np.intersect1d(np.intersect1d(values[count > 1], x), y)
            at_x, at_y = np.searchsorted(values, x), np.searchsorted(values, y)
            for part in range(0, len(n_x) if len(values) else 0, BLOCK_PART):
                rows = slice(part, part + BLOCK_PART)
                shared = np.zeros((len(n_x[rows]), len(n_y)), dtype=np.float32)
                for low in range(0, len(values), BLOCK_ELEMENTS):
                    width = min(BLOCK_ELEMENTS, len(values) - low)
                    a, b = np.zeros((len(shared), width), dtype=np.float32), np.zeros((len(n_y), width), dtype=np.float32)
                    for matrix, row, at, value, first in ((a, row_x, at_x, x, part), (b, row_y, at_y, y, 0)):
                        inside = (at >= low) & (at < low + width) & (row >= first) & (row < first + len(matrix))
                        inside[inside] = values[at[inside]] == value[inside]
                        matrix[row[inside] - first, at[inside] - low] = 1
                    shared += a @ b.T
                enough = shared >= similarity * (n_x[rows, None] + n_y[None, :] - shared) - 1e-4
                i, j = np.nonzero(enough & (label_x[rows, None] != label_y[None, :]))
                exact = shared[i, j] >= similarity * (n_x[rows][i] + n_y[j] - shared[i, j].astype(np.float64))
                found[0].append(np.maximum(id_x[rows][i[exact]], id_y[j[exact]]))
                found[1].append(np.minimum(id_x[rows][i[exact]], id_y[j[exact]]))
        a, b = (np.concatenate(f) if f else np.zeros(0, dtype=np.int64) for f in found)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def bucket_links(rows: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links ``a > b`` of different label within buckets.

    ``rows`` has ``key, id, label, main``; at least one end of a link is
    outside the main label of its bucket. Buckets are dealt into blocks of at
    most about ``BLOCK_ROWS`` minor members and as many members, and of about
    ``BLOCK_SUM`` elements.
    """
    weighed = rows.join(sets.select("id", F.size("elements").cast("long").alias("weight")).hint("merge"), "id")
    minor = F.col("label") != F.col("main")
    blocks = lambda n, weight: F.greatest(F.lit(1), F.ceil(n / BLOCK_ROWS), F.ceil(weight / BLOCK_SUM)).cast("int")
    sizes = weighed.groupBy("key").agg(blocks(F.count("*"), F.sum("weight")).alias("parts"), blocks(F.count_if(minor), F.sum(F.when(minor, F.col("weight")).otherwise(0))).alias("minor_parts"))
    full = rows.join(sizes.hint("merge"), "key").join(sets.hint("merge"), "id")
    deal = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    minors = full.where("label != main").select("key", deal("minor_parts").alias("i"), every("parts").alias("j"), "id", "label", "elements")
    minors = minors.toDF(*[f"minor_{c}" for c in minors.columns])
    members = full.select("key", every("minor_parts").alias("i"), deal("parts").alias("j"), "id", "label", "elements")
    keys = ["key", "i", "j"]
    return minors.groupBy(*[f"minor_{k}" for k in keys]).cogroup(members.groupBy(*keys)).applyInArrow(_block_links(similarity), "a long, b long").distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``id, label``: the smallest id connected with each id of the links ``a, b``.

    Labels spread to neighbours and are then replaced by their own labels, so
    the rounds grow with the logarithm of the longest chain. Each round is a
    written table; those of earlier rounds are removed.
    """
    both = scratch.cut(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct(), few=True)
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label"))
    written = scratch.cut(labels, few=True)
    while True:
        labels = written.select("id", "label")
        # an id with most links is a hot key here: merge joins, which adaptive execution splits
        near = both.join(labels.hint("merge"), both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, labels["id"] == near["a"]).select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        spread = scratch.cut(spread, few=True)  # both sides of the next join are then shuffled for it, and can be split
        ahead = spread.select(F.col("id").alias("label"), F.col("label").alias("next"))
        jumped = scratch.cut(spread.join(ahead.hint("merge"), "label").select("id", "old", F.col("next").alias("label")), few=True)
        scratch.drop(written, spread)
        written = jumped
        if not jumped.where("label != old").limit(1).count():
            scratch.drop(both)
            return jumped.select("id", "label")


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, weighting: str = "set") -> DataFrame:
    """``id, class_id`` for every row of ``docs``. Runs its jobs when called; the result is one join of written tables.

    Whatever joins on a key that much of the table may share (a bucket, its
    head, a word sequence) is a merge join, whose large partitions adaptive
    execution splits; a broadcast chosen behind the shuffle would keep them whole.
    """
    scratch = Scratch(docs.sparkSession)
    base = scratch.cut(sketch(docs, id_col, text, weighting))
    first = scratch.cut(base.groupBy("words").agg(F.min("id").alias("rep")), few=True)

    # one row per different word sequence
    reps = base.join(first.select(F.col("rep").alias("id")).where("id is not null"), "id", "left_semi").where("words != 0")
    members = reps.select("id", F.explode("bands").alias("key")).distinct()
    heads = members.groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("last")).where("head != last").select("key", "head")
    shared = scratch.cut(members.join(heads.hint("merge"), "key"), few=True)

    tried = shared.where("id != head").select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()
    needed = scratch.cut(shared.select("id").distinct(), few=True)
    sets = scratch.cut(element_sets(docs, needed, id_col, text, weighting))
    links = scratch.cut(verified(tried, sets, similarity), few=True)
    scratch.drop(needed)
    labels = components(links, scratch)

    # buckets that hold several classes
    own = scratch.cut(shared.join(labels.hint("merge"), "id", "left").select("key", "id", F.coalesce("label", "id").alias("label")), few=True)
    scratch.drop(shared)
    per_class = own.groupBy("key", "label").agg(F.count("*").alias("size"))
    mixed = per_class.groupBy("key").agg(F.max_by("label", F.struct("size", "label")).alias("main"), F.count("*").alias("kinds")).where("kinds > 1").select("key", "main")
    open_rows = scratch.cut(own.join(mixed.hint("merge"), "key"), few=True)
    scratch.drop(own)
    more = scratch.cut(bucket_links(open_rows, sets, similarity), few=True)
    scratch.drop(open_rows, sets)
    if more.limit(1).count():
        labels = components(links.unionByName(more), scratch)
    scratch.drop(links, more)

    of_words = first.join(labels, first["rep"] == labels["id"], "left").select("words", F.coalesce("label", "rep").alias("class_id"))
    return base.select("id", "words").join(of_words.hint("merge"), "words", "left").select(F.col("id").alias(id_col), "class_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with the smallest id of each class; rows without an id stay.

    Of rows that share an id one stays: the one whose text has the smallest
    hash (equal texts being equal here), so that a rerun keeps the same.
    """
    scratch = Scratch(docs.sparkSession)
    kept, number = free_name("kept", docs.columns), free_name("number", docs.columns)
    found = classes(docs, id_col, text, similarity).where(F.col(id_col) == F.col("class_id"))
    ids = scratch.cut(found.groupBy(F.col(id_col).alias(kept)).agg((F.count("*") > 1).alias(number)))
    # texts go by merge join at every size, so that the plan is the one that was measured
    rows = docs.join(ids.select(kept).hint("merge"), docs[id_col] == F.col(kept), "left_semi")
    if ids.where(F.col(number)).limit(1).count():
        order = F.struct(F.xxhash64(text), F.xxhash64(*docs.columns))
        several, single = (ids.where(F.col(number) == x).select(kept).hint("merge") for x in (True, False))
        own = docs.join(several, docs[id_col] == F.col(kept), "left_semi").groupBy(F.col(id_col).alias(kept)).agg(F.min_by(F.struct(*docs.columns), order).alias(number))
        rows = docs.join(single, docs[id_col] == F.col(kept), "left_semi").unionByName(own.select(f"{number}.*"))
    if docs.where(F.col(id_col).isNull()).limit(1).count():
        rows = rows.unionByName(docs.where(F.col(id_col).isNull()))
    return rows
