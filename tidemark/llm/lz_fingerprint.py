"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed as LZ78 does: the next phrase is the longest phrase met
before plus one character. Texts with a common vocabulary of phrases compress
each other, so the likeness of two phrase sets stands for compression
distance. The set is hashed and kept as a one-permutation minimum-hash
signature of ``SLOTS`` slots of 16 bits, written in hex; the likeness of two
fingerprints is the share of equal slots.

:func:`edit_likeness` compares each document with an edited text and with the
next document in descending order of id. It range-partitions the documents
once, streams each sorted partition, and settles the last document of each
partition - one row per partition - in a small second step.

Defined results
---------------
* null text is empty; the fingerprint of an empty text is all zeros, alike only to itself;
* equal ids go by a hash of their text; a single document is its own next one;
* null ids come last in descending order; repeated rows stay;
* texts are parsed whole; an empty table gives no rows; input columns other than id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, hold, shuffle_partitions, slices, text_or_empty

#: Slots of a fingerprint.
SLOTS = 64
_M = 0x110000  # more than any code point

_ODD, _MULT, _LAST = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB  # splitmix64 constants; fixed values


def parse(points: list[int]):
    """``(ends, dictionary)``: where each phrase ends; the dictionary maps (phrase, character) to the phrase it makes, counted from 1 and scaled."""
    known: dict[int, int] = {}
    get, ends, node, count = known.get, [], 0, _M
    for at, c in enumerate(points):
        key = node + c
        node = get(key)
        if node is None:
            known[key] = count
            count += _M
            ends.append(at + 1)
            node = 0
    if points and (not ends or ends[-1] != len(points)):
        ends.append(len(points))
    return ends, known


def parse_on(points: list[int], ends: list[int], known: dict[int, int], start: int) -> list[int]:
    """Phrase ends of a text that equals an already parsed one up to ``start``; ``points`` is the text from the last shared phrase end on.

    Only phrases made within the shared part are looked up in ``known``.
    """
    shared = start
    made = shared * _M  # phrases up to this number belong to the shared part
    own: dict[int, int] = {}
    get, get_own, out, node, count = known.get, own.get, [], 0, made + _M
    for at, c in enumerate(points):
        key = node + c
        node = get(key)
        if node is None or node > made:
            node = get_own(key)
            if node is None:
                own[key] = count
                count += _M
                out.append(at + 1)
                node = 0
    if points and (not out or out[-1] != len(points)):
        out.append(len(points))
    return out


#: Length of the kept tables of powers; a longer text gets tables of its own, for as long as it is worked on.
KEPT_POWERS = 1 << 18


def _tables(size: int):
    import numpy as np

    def make(size):
        base, inverse = 0x100000001B3, pow(0x100000001B3, -1, 1 << 64)
        with np.errstate(over="ignore"):
            return tuple(np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size - 1, np.uint64(b)))]) for b in (base, inverse))

    return make(size) if size > KEPT_POWERS else hold("phrase powers", lambda: make(KEPT_POWERS))


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MULT)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_LAST)
    return x ^ (x >> np.uint64(31))


def signature(points, ends):
    """The minimum-hash slots of the phrases ``points[ends[i-1]:ends[i]]``."""
    import numpy as np

    slots = np.zeros(SLOTS, dtype=np.uint16)
    if not len(ends):
        return slots
    up, down = _tables(len(points) + 1)
    ends = np.asarray(ends, dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(_mix(points.astype(np.uint64) + np.uint64(_ODD)) * up[: len(points)], dtype=np.uint64)])
        h = np.sort(_mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
    slot, first = np.unique((h & np.uint64(SLOTS - 1)).astype(np.int64), return_index=True)
    values = (h[first] >> np.uint64(16)).astype(np.uint16) | np.uint16(1)  # 0 is left to the empty text
    # an empty slot takes what the next filled one holds, changed by the distance
    at = np.searchsorted(slot, np.arange(SLOTS)) % len(slot)
    far = ((slot[at] - np.arange(SLOTS)) % SLOTS).astype(np.uint16)
    return values[at] ^ (far << np.uint16(1))


def _points(text: str):
    import numpy as np

    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class Parsed:
    """A text with its phrases and fingerprint."""

    def __init__(self, text: str):
        self.text, self.points = text, _points(text)
        self.ends, self.known = parse(self.points.tolist())
        self.slots = signature(self.points, self.ends)

    def edited(self, following: Parsed):
        """``(text, slots)`` after the last half gave way to the start of ``following``."""
        import numpy as np

        half = len(self.points) // 2
        keep = len(self.points) - half
        text = self.text[:keep] + following.text[:half]
        points = np.concatenate([self.points[:keep], following.points[:half]])
        shared = int(np.searchsorted(self.ends, keep, side="right"))  # phrases that end within the kept part
        if shared == len(self.ends) and shared:
            shared -= 1  # the last one may be cut short by the end of the text
        start = self.ends[shared - 1] if shared else 0
        ends = self.ends[:shared] + [start + e for e in parse_on(points[start:].tolist(), self.ends, self.known, shared)]
        return text, signature(points, ends)


def to_hex(slots) -> str:
    return slots.astype(">u2").tobytes().hex()


def likeness(a, b) -> float:
    import numpy as np

    return float(np.mean(a == b))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, fingerprint`` of every row."""

    def run(batches):
        import pyarrow as pa

        for part in slices(batches):
            prints = [to_hex(Parsed(t).slots) for t in part.column("text").to_pylist()]
            yield pa.record_batch([part.column("id"), pa.array(prints, pa.string())], names=["id", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fingerprint string").withColumnRenamed("id", id_col)


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_ENDS = ", part int, side string, text string"


def _result(doc_id, this: Parsed, following: Parsed):
    import hashlib

    text, slots = this.edited(following)
    return doc_id, len(this.points), hashlib.sha256(text.encode()).hexdigest(), to_hex(this.slots), to_hex(slots), likeness(this.slots, slots), likeness(this.slots, following.slots)


def _batch(rows, ends: bool):
    import pyarrow as pa

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    if ends:
        names, kinds = [*names, "part", "side", "text"], [*kinds, pa.int32(), pa.string(), pa.string()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document compared with its edited text and with the next document, by descending id."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text).alias("text"))
    order = [F.col("id").desc_nulls_last(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(max(shuffle_partitions(docs.sparkSession), 2), *order).sortWithinPartitions(*order)

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        held, empty = None, (None,) * 7
        for part in slices(batches):
            out = []
            for doc, t in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                this = Parsed(t)
                if held is None:
                    out.append((*empty, number, "first", t))
                else:
                    out.append((*_result(*held, this), None, None, None))
                held = (doc, this)
            yield _batch(out, True)
        if held is not None:
            yield _batch([(held[0], *empty[1:], number, "last", held[1].text)], True)

    done = cut_lineage(ranged.mapInArrow(run, RESULT + _ENDS))

    # one document for each partition has its next one elsewhere
    lasts, firsts = done.where("side = 'last'"), done.where("side = 'first'").select(F.col("part").alias("from"), F.col("text").alias("next_text"))
    parts = done.where("side = 'first'").select("part")
    ahead = Window.orderBy("part")  # a row per partition
    following = parts.withColumn("from", F.lead("part").over(ahead)).withColumn("lowest", F.min("part").over(Window.partitionBy())).select("part", F.coalesce("from", "lowest").alias("from"))
    open_rows = lasts.select("doc_id", "text", "part").join(following, "part").join(firsts, "from").select("doc_id", "text", "next_text")

    def settle(batches):
        for part in slices(batches):
            yield _batch([_result(r["doc_id"], Parsed(r["text"]), Parsed(r["next_text"])) for r in part.to_pylist()], False)

    names = [c.split()[0] for c in RESULT.split(", ")]
    return done.where("side is null").select(*names).unionByName(open_rows.mapInArrow(settle, RESULT)).withColumnRenamed("doc_id", id_col)
