"""Packing token sequences by bin completion with best-fit incumbents.

Documents are encoded, ended by an end id, and only those longer than a
sequence are cut. What is left to decide depends on nothing but how many
pieces of each length there are: a histogram of at most ``capacity`` rows,
whatever the size of the corpus. The plan is made on that histogram:

* best-fit decreasing gives an incumbent;
* bin completion goes through the lengths from the largest: it enumerates the
  undominated fillings of the room beside the largest piece, least waste
  first, applies each as often as the counts allow and then once, and
  backtracks over all others while the waste so far, and a lower bound for
  what is left, allow a better packing than the incumbent; what was left over
  before with no fewer sequences used is not searched again;
* a packing that meets the Martello-Toth bound ends the search, and so does
  the number of steps ``SEARCH_STEPS`` (packing is NP-hard); without the latter
  the packing is the smallest there is.

A pattern applied as often as it fits uses up at least one length, so a plan
has about ``capacity`` rows. Pieces get a rank among those of their length (from salted counts, so a
hot length is spread) and find sequence and offset from it by binary search.

Defined results
---------------
* null text is empty; an empty text is one piece that holds the end id alone;
* repeated rows are packed once each; other input columns are ignored;
* an empty table gives no rows;
* a sequence has no gaps: offsets follow one another from 0.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, hold, release, slices, text_or_empty

CAPACITY = 4096
#: Remembered chunks per Python process, after which the cache starts anew, and the size of the table of chunks met once.
CACHE_ENTRIES, MARK_BITS = 200_000, 22
#: Pieces of one length that are ranked together, on average; a length with more is dealt into parts.
SALT_ROWS = 512
#: The same in bytes of token ids, where pieces carry them.
SALT_BYTES = 16 << 20
#: Steps of the search, after which the incumbent stands even if no proof is found that it is the smallest packing.
SEARCH_STEPS = 300_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

# ---------------------------------------------------------------- encoding

#: Characters whose normal form and lower case the shortcut may rely on; others go to the library whole.
_PLAIN = re.compile("[\t-\r -~\xa1-İĲ-ɀ‐-‧‰-⁞€]*")
_LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha())
_NUMBERS = "".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == "N")
#: The tokenizer's own split pattern (fixed value), its classes spelled out for the plain range.
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+")


class Encoder:
    """Token ids of texts with a lower-casing tokenizer whose pre-tokens never span white space.

    White-space-separated chunks are encoded once each and remembered, as
    little-endian bytes, so a text is one join; a text with characters outside
    the plain range, or with a special token of the vocabulary in it, is
    encoded by the library as a whole. A chunk stays in the cache from its
    second appearance on; which were met once, a table of marks remembers.
    """

    def __init__(self, path: str):
        import numpy as np
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # for words that are already lower-case pre-tokens: the same merges without normalizing and splitting again
        self.merger = Tokenizer(self.tokenizer.model)  # the same model, not a copy of it
        self.merger.normalizer = normalizers.Sequence([])
        self.merger.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.cache: dict[str, bytes] = {}
        self.met = bytearray(1 << MARK_BITS)

    def _merge(self, words: list[str]) -> None:
        """Merges words in few calls and tells them apart by their end marks."""
        import numpy as np

        lines = [" ".join(words[i : i + 100]) for i in range(0, len(words), 100)]  # short lines keep the library quick
        ids = np.array([i for e in self.merger.encode_batch_fast(lines, add_special_tokens=False) for i in e.ids], dtype="<u4")
        ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        data = ids.tobytes()
        self.cache.update(zip(words, map(data.__getitem__, map(slice, [0, *ends], ends)), strict=False))

    def _learn(self, chunks: set[str]) -> set[str]:
        """Puts chunks into the cache; returns what was put there, words of the chunks included."""
        cache, find = self.cache, _WORDS.findall
        parts = [(c, x) for c in chunks if len(x := find(c)) != 1 or x[0] != c]
        new = chunks.difference([c for c, _ in parts])
        new.update([w for _, x in parts for w in x if w not in cache])
        if new:
            self._merge(list(new))
        for c, x in parts:
            cache[c] = b"".join([cache[w] for w in x])
        return new | chunks

    def _forget(self, chunks: set[str]) -> None:
        """Drops chunks that are met for the first time."""
        met, last, drop = self.met, (1 << MARK_BITS) - 1, self.cache.__delitem__
        for c in chunks:
            at = hash(c) & last
            if not met[at]:
                met[at] = 1
                drop(c)
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
            self.met = bytearray(1 << MARK_BITS)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        import numpy as np

        plain = [bool(_PLAIN.fullmatch(t)) and not any(s in t for s in self.special) for t in texts]
        chunks = [t.lower().split() if ok else () for t, ok in zip(texts, plain, strict=True)]
        missing = set().union(*chunks).difference(self.cache)
        fresh = self._learn(missing) if missing else missing
        whole = [t for t, ok in zip(texts, plain, strict=True) if not ok]
        whole = iter(self.tokenizer.encode_batch_fast(whole, add_special_tokens=False) if whole else ())
        get = self.cache.__getitem__
        out = [b"".join(map(get, x)) if ok else np.array(next(whole).ids, dtype="<u4").tobytes() for x, ok in zip(chunks, plain, strict=True)]
        self._forget(fresh)
        return out


def encoder(path: str) -> Encoder:
    return hold(("encoder", path), lambda: Encoder(path))


def encode_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1, with_ids: bool = False, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``."""

    def run(batches):
        import os
        import zlib

        import numpy as np
        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        end, step = end_id.to_bytes(4, "little"), 4 * capacity
        for part in slices(batches):
            rows, arrays = [], []
            for doc, ids in zip(part.column("id").to_pylist(), encoder(path).encode(part.column("text").to_pylist()), strict=True):
                ids += end
                for k, start in enumerate(range(0, len(ids), step)):
                    piece = ids[start : start + step]
                    rows.append((doc, k, start // 4, len(piece) // 4, zlib.crc32(piece)))
                    if with_ids:
                        arrays.append(np.frombuffer(piece, dtype="<u4").astype(np.int32))
            doc, k, start, length, crc = zip(*rows, strict=True) if rows else ((),) * 5
            columns = {"doc_id": pa.array(doc, pa.int64()), "piece": pa.array(k, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
            if with_ids:
                columns["ids"] = pa.array(arrays, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))


# ---------------------------------------------------------------- planning


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: ``[(lengths of a sequence, how many such)]``."""
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []  # sorted keys of open_bins

    def put(room, pattern, n):
        if room not in open_bins:
            open_bins[room] = []
            rooms.insert(bisect_right(rooms, room), room)
        open_bins[room].append((pattern, n))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_right(rooms, size - 1)
            if at < len(rooms):
                room = rooms[at]
                pattern, n = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(at)
            else:
                room, pattern, n = capacity, (), max(1, left // (capacity // size))
            each = min(room // size, max(1, left // n))
            used = min(n, left // each)
            if used < n and room != capacity:
                put(room, pattern, n - used)
            left -= used * each
            put(room - each * size, pattern + (size,) * each, used)
    return [(p, n) for groups in open_bins.values() for p, n in groups]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs, the best of the Martello-Toth bounds.

    For every k up to half the capacity: pieces longer than ``capacity - k``
    share no sequence with pieces of at least k, pieces over half the capacity
    share none with one another, and what lies between must fill the room they
    leave or new sequences. With k = 0 it is ``ceil(total / capacity)`` at least.
    """
    import numpy as np

    half, many = capacity // 2, np.zeros(capacity + 2, dtype=np.int64)
    many[list(counts)] = list(counts.values())
    upto, words = np.cumsum(many), np.cumsum(many * np.arange(capacity + 2))
    k = np.arange(half + 1)
    alone = upto[-1] - upto[capacity - k]
    paired, paired_words = upto[capacity - k] - upto[half], words[capacity - k] - words[half]
    small = words[half] - np.concatenate([[0], words])[k]
    return int((alone + paired + np.maximum(0, -((paired * capacity - paired_words - small) // capacity))).max())


def dominated(sums: int, several: int, spare: int, waste: int) -> bool:
    """Whether a piece that was left out could take the place of some that were taken.

    All are bit sets over lengths: ``sums`` has the totals of all subsets of
    what was taken, the empty one included, ``several`` those of two pieces or
    more, ``spare`` the lengths left out. A longer piece that fits in with the
    ``waste``, or one exactly as long as several, makes a filling at least as good.
    """
    if spare & several:
        return True
    near, far = sums << 1, 1  # sums moved by 1 to far
    while far < waste:
        step = min(far, waste - far)
        near, far = near | near << step, far + step
    return bool(waste and spare & near)


def fillings(counts: dict[int, int], room: int, most_waste, spend):
    """All undominated fillings of ``room``, least waste first, made one by one.

    ``most_waste()`` is the waste that is still of use, asked for as fillings
    are drawn; ``spend(n)`` is told of every step. For each waste, sizes are
    gone through from the largest; which sums the smaller ones can still reach
    is known beforehand, so that every branch ends in a filling, unless it is
    found to be dominated first.
    """
    sizes = sorted((s for s in counts if s <= room and counts[s]), reverse=True)
    full = (1 << (room + 1)) - 1
    reach = [1] * (len(sizes) + 1)  # bit s: the sizes from here on have a sum s
    for i in range(len(sizes) - 1, -1, -1):
        size, left, bits, each = sizes[i], min(counts[sizes[i]], room // sizes[i]), reach[i + 1], 1
        while left:
            each = min(each, left)
            bits |= (bits << each * size) & full
            left, each = left - each, each * 2
        reach[i] = bits
    rest = [0] * (len(sizes) + 1)  # the sizes from here on
    for i in range(len(sizes) - 1, -1, -1):
        rest[i] = rest[i + 1] | 1 << sizes[i]
    spend(len(sizes) + 1)

    def go(i, left, taken, sums, several, spare, waste):
        if not left:
            if not dominated(sums, several, spare | rest[i], waste):
                yield taken
            return
        while i < len(sizes) and reach[i] >> left & 1:
            size = sizes[i]
            if size <= left:
                most = min(counts[size], left // size)
                more = [(sums, several)]
                for _ in range(most):
                    x, y = more[-1]
                    more.append(((x | x << size) & full, (y | (y | x & ~1) << size) & full))
                for n in range(most, 0, -1):
                    spend(1)
                    x, y = more[n]
                    skipped = spare | (1 << size if n < counts[size] else 0)
                    if reach[i + 1] >> (left - n * size) & 1 and not dominated(x, y, skipped, waste):
                        yield from go(i + 1, left - n * size, taken + (size,) * n, x, y, skipped, waste)
            spare |= 1 << size
            i += 1
            spend(1)
            if dominated(sums, several, spare, waste):
                return

    waste = 0
    while waste <= min(room, most_waste()):
        if reach[0] >> (room - waste) & 1:
            yield from go(0, room - waste, (), 1, 0, 0, waste)
        waste += 1


class _Spent(Exception):
    pass


def plan(counts: dict[int, int], capacity: int = CAPACITY, steps: int = SEARCH_STEPS) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is used, over all pieces of the histogram.

    The packing is the smallest there is, unless the search takes more than
    ``steps`` steps; then it is the best that was found.
    """
    import random

    counts = {int(s): int(n) for s, n in counts.items() if n}
    if not counts:
        return []
    total = sum(s * n for s, n in counts.items())
    bound = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    most = sum(n for _, n in best)
    rng = random.Random(0)
    sign = {s: rng.getrandbits(128) | 1 for s in counts}  # the state of what is left is a sum of these
    left, state = dict(counts), sum(sign[s] * n for s, n in counts.items())
    waste, taken, spent = 0, 0, 0
    seen: dict[int, int] = {}
    stack: list[list] = []  # [fillings to come, pattern applied, times, whether to apply it once as well]

    def spend(n):
        nonlocal spent
        spent += n
        if spent > steps:
            raise _Spent

    def allowed():
        return (most - 1) * capacity - total - waste

    def apply(pattern, times):
        nonlocal state, waste, taken
        for s in pattern:
            left[s] = left.get(s, 0) - times
            state -= sign[s] * times
            if not left[s]:
                del left[s]
        waste += (capacity - sum(pattern)) * times
        taken += times

    def options():
        largest = max(left)
        others = {s: n - (s == largest) for s, n in left.items()}
        # what was learned on the way back may allow less waste than when the branch began
        return ((largest, *f) for f in fillings({s: n for s, n in others.items() if n}, capacity - largest, allowed, spend))

    try:
        while most > bound:
            spend(1)
            if not left:
                if taken < most:
                    best, most = [(p, n) for _, p, n, _ in stack], taken
            elif seen.get(state, most) > taken and allowed() >= 0 and taken + lower_bound(left, capacity) < most:
                seen[state] = taken
                stack.append([options(), (), 0, False])
            while stack:
                top = stack[-1]
                if top[1]:
                    apply(top[1], -top[2])
                pattern, once = top[1], top[3]
                if once:  # after as often as it fits: once, then any other filling
                    top[2:] = [1, False]
                else:
                    pattern = next(top[0], None)
                    if pattern is None:
                        stack.pop()
                        continue
                    times = min(left[s] // pattern.count(s) for s in set(pattern))
                    top[1:] = [pattern, times, times > 1]
                apply(pattern, top[2])
                break
            else:
                break
    except _Spent:
        pass
    return best


def slots(patterns: list[tuple[tuple[int, ...], int]]):
    """Plan as arrays sorted by (length, first rank): what :func:`place` searches."""
    import numpy as np

    rows, first, used = [], 0, {}
    for pattern, times in patterns:
        offset = 0
        for size in dict.fromkeys(pattern):
            each = pattern.count(size)
            rank = used.get(size, 0)
            rows.append((size, rank, each, first, offset))
            used[size] = rank + each * times
            offset += each * size
        first += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def place(sizes, ranks, table):
    """Sequence ids and offsets of pieces from their length and rank."""
    import numpy as np

    key = (table[:, 0] << 48) + table[:, 1]
    at = np.searchsorted(key, (sizes << 48) + ranks, side="right") - 1
    _, first, each, sequence, offset = table[at].T
    k = ranks - first
    return sequence + k // each, offset + (k % each) * sizes


# ---------------------------------------------------------------- the operator


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``pieces`` should be a written table, it is read twice."""
    # at most a row per length up to the capacity
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = pieces.sparkSession.sparkContext.broadcast(slots(plan(counts, capacity)))
    release()  # what the search for the plan took of the driver's memory

    each = 4 if "ids" in pieces.columns else 0
    parts = [(s, max(-(-n // SALT_ROWS), -(-n * s * each // SALT_BYTES))) for s, n in counts.items()]
    parts = pieces.sparkSession.createDataFrame(parts, "length long, parts long")
    salted = pieces.join(F.broadcast(parts), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("parts"))).drop("parts")
    per_salt = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    per_salt = cut_lineage(per_salt.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0))))

    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(own).cast("long")).join(per_salt.drop("n"), ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("skip") - 1).drop("skip", "salt").select(*pieces.columns, "rank")

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = place(length.to_numpy(), rank.to_numpy(), table.value)
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    # two numbers a row go to Python; token ids, if there are any, stay behind in the JVM
    return ranked.withColumn("_at", placed("length", "rank")).select(*pieces.columns, "_at.sequence_id", "_at.offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1, with_ids: bool = False, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes, cuts and packs documents: a row per piece, with its place."""
    return pack(cut_lineage(encode_pieces(docs, path, capacity, end_id, with_ids, id_col, text)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Packed token ids: ``sequence_id, ids, doc_ids``; a sequence is bounded by the capacity, so is its group."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"), F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"))
