r"""Conversation repair by a forward Viterbi pass over the roles' grammar.

A sound conversation is ``(s?(ua)+)?`` in initials of its roles: perhaps a
system turn, then user and assistant by turns, ended by an assistant; or
nothing. Four states follow it: at the start, behind a system turn, behind a
user's, behind an assistant's. For each state the pass carries the cheapest way
to edit the turns so far into something that ends there, as the pair (cost,
audit string); a turn's layer is closed by insert transitions, of which two in
a row lead from any state to any other that can be reached, so no more are
needed. Edits and what they cost: keep a turn, re-role it to user or assistant,
delete it (blank and repeated turns must go), insert an empty one; a truncated
turn that stays costs extra.

**Audit strings are never compared as a whole.** The ways into the states of
one layer end in the edit of the same turn. Of two with equal cost neither
begins with the other (the rest would be inserts, which cost something), so
which is less is settled where they part, and stays so whatever is appended.
Each state therefore carries its place in that order, and one byte a state and
turn tells what was appended to which; the audit string is read from these
at the end. A conversation of n turns takes time and memory in proportion to n.

**Spark.** Rows are damaged, tested for blanks and truncation and cut down to
what is needed by built-in functions, dealt by conversation and sorted by turn
there; a task streams through its conversations. A conversation is one row of
the result, so its turns meet in one task, which costs its own length.

Defined results
---------------
* null role or text: one space; null turns come first; null conversation id: a conversation of its own;
* rows of equal turn go by role and text; repeated rows are turns of their own (and duplicates);
* role initials are the first character, case as it is; a role that is empty or has another initial can't be kept;
* a conversation without rows, all having been dropped, has zeros, an empty audit and no turns;
* an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_partitions

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: start, behind a system turn, behind a user's, behind an assistant's; a conversation may end in these.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: Where a user's or assistant's turn leads from each state, and a system turn.
_NEXT = {(START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT, (START, "s"): SYSTEM}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Where inserts lead: one is a user's turn or, behind one, an assistant's.
_INSERTED = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
MOST_INSERTS = 2
_FAR = 1 << 60


def _closures(state: int) -> list[tuple[int, int]]:
    """``(inserts, state)`` that a state can be closed to, none twice."""
    out, at = [(0, state)], state
    for k in range(1, MOST_INSERTS + 1):
        at = _INSERTED[at]
        if at not in [s for _, s in out]:
            out.append((k, at))
    return out


def _transitions(initial: str, fault: str) -> list[tuple[int, int, int, str]]:
    """``(from, to, cost, appended)`` of a turn: inserts before it, then its edit."""
    out = []
    for state in range(4):
        for k, at in _closures(state):
            before, cost = "I" * k, INSERT * k
            out.append((state, at, cost + DELETE, before + "D"))
            if fault not in ("blank", "duplicate"):
                cost += TRUNCATED * (fault == "truncated")
                if (at, initial) in _NEXT:
                    out.append((state, _NEXT[at, initial], cost, before + "K"))
                out += [(state, _NEXT[at, r], cost + REROLE, before + "R") for r in "ua" if (at, r) in _NEXT]
    return out


_APPENDED = [b * k + e for k in range(MOST_INSERTS + 1) for b, e in (("I", "D"), ("I", "K"), ("I", "R"))]
#: By initial (any other: blank) and fault: transitions into each state, what is appended as its number.
_STEPS = {
    (i, f): [[(s, c, a, _APPENDED.index(a)) for s, to, c, a in _transitions(i, f) if to == state] for state in range(4)] for i in ("s", "u", "a", " ") for f in ("", "blank", "duplicate", "truncated")
}


class Viterbi:
    """The pass over one conversation."""

    def __init__(self):
        self.cost = [0, _FAR, _FAR, _FAR]
        self.order = [0, 1, 2, 3]  # of the states' audit strings
        self.back = bytearray()

    def step(self, initial: str, fault: str) -> None:
        """Takes one turn with the first letter of its role and its first fault."""
        cost, order, best = self.cost, self.order, []
        for state, ways in enumerate(_STEPS[initial if initial in "sua" and initial else " ", fault]):
            found = min(((cost[s] + c, order[s], a, s, n) for s, c, a, n in ways if cost[s] < _FAR), default=(_FAR, state, "", 0, 0))
            best.append(found)
        self.cost = [b[0] for b in best]
        ranked = sorted(range(4), key=lambda k: (best[k][1], best[k][2], k))
        self.order = [ranked.index(k) for k in range(4)]
        self.back += bytes(b[3] << 4 | b[4] for b in best)

    def finish(self) -> tuple[int, list[str]]:
        """The least cost, and the edits appended for each turn; the last are inserts behind all turns."""
        ways = [(self.cost[s] + INSERT * k, self.order[s], "I" * k, s) for s in range(4) if self.cost[s] < _FAR for k, at in _closures(s) if at in ENDS]
        total, _, last, state = min(ways)
        out = [last]
        for at in range(len(self.back) - 4, -4, -4):
            choice = self.back[at + state]
            out.append(_APPENDED[choice & 15])
            state = choice >> 4
        return total, out[::-1]


def edited(turns: list[tuple[str, str]], edits: list[str]) -> list[tuple[str, str]]:
    """The (role, text) pairs that edits make of turns."""
    out, state = [], START

    def add(role, text):
        nonlocal state
        out.append((role, text))
        state = _NEXT[state, role[:1]]

    for k, steps in enumerate(edits):
        for e in steps:
            if e == "I":
                add(_ROLE[_INSERTED[state]], "")
            elif e == "R":
                add(_ROLE[_INSERTED[state]], turns[k][1])
            elif e == "K":
                add(*turns[k])
    return out


# ------------------------------------------------------------------ the operator


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, times``: rows with planted faults, by the checksum of ``conv_id:turn``; a dropped row has 0 ``times`` and no text, a repeated one 2."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1]).cast("binary")) % 20
    return conversations.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").when(kind == 0, "").otherwise(spaced[2]).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(spaced[3], ".!?", "")).otherwise(spaced[3]).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )


_BLANKS = " \t\n\v\f\r"


def _fault(text: Column) -> Column:
    """``blank``, ``truncated`` or empty."""
    end = F.substring(F.rtrim(text, F.lit(_BLANKS)), -1, 1)
    return F.when(end == "", "blank").when(~end.isin(".", "!", "?"), "truncated").otherwise("")


REPAIRED = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired array<struct<role:string,text:string>>"


def _repair(turns: list[tuple[str, str, str]]) -> dict:
    """Figures and repaired turns of a conversation's ``(role, text, fault)``."""
    seen, counts, pass_, illegal, before = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, Viterbi(), 0, None
    for role, text, fault in turns:
        if fault != "blank" and (role, text) in seen:
            fault = "duplicate"
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        if before is not None and before + role[:1] not in ("su", "ua", "au"):
            illegal += 1
        before = role[:1]
        pass_.step(role[:1], fault)
    cost, edits = pass_.finish()
    return counts | {"illegal": illegal, "cost": cost, "audit": "".join(edits), "repaired": edited([t[:2] for t in turns], edits)}


def _conversations(batches) -> Iterator[tuple[object, list, int]]:
    """``(conversation, its turns, gaps)`` of sorted rows."""
    key, turns, numbers, any_yet = None, [], (None, None, 0, None), False

    def gaps(low, high, distinct, _):
        return high - low + 1 - distinct if distinct else 0

    for batch in batches:
        for conv, turn, role, text, times, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if any_yet and conv != key:
                yield key, turns, gaps(*numbers)
            if not any_yet or conv != key:
                key, turns, numbers, any_yet = conv, [], (None, None, 0, None), True
            if times and turn is not None:  # turns come in order
                low, high, distinct, last = numbers
                numbers = (turn if low is None else low, turn, distinct + (turn != last), turn)
            turns += [(role, text, fault)] * times
    if any_yet:
        yield key, turns, gaps(*numbers)


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``conv_id, turn, role, text`` (and ``times``, how often a row stands): figures, audit and repaired turns."""

    def run(batches):
        import pyarrow as pa

        names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired")
        struct = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        kinds = [None, *[pa.int64()] * 6, pa.string(), struct]

        def batch(rows):
            columns = [[r[n] for r in rows] for n in names]
            columns[-1] = [[{"role": a, "text": b} for a, b in x] for x in columns[-1]]
            return pa.record_batch([pa.array(c, k or id_kind) for c, k in zip(columns, kinds, strict=True)], names=list(names))

        rows, size = [], 0
        it = iter(batches)
        first = next(it, None)
        if first is None:
            return
        id_kind = first.schema.field("conv_id").type

        def again():
            yield first
            yield from it

        for conv, own, gaps in _conversations(again()):
            rows.append(_repair(own) | {"conv_id": conv, "gaps": gaps})
            size += sum(len(t) for _, t, _ in own) + 64
            if size > 1 << 22:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)

    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    times = F.col("times") if "times" in turns.columns else F.lit(1)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.cast("int").alias("times"), _fault(text).alias("fault"))
    # the number of partitions is said, so that sorted conversations aren't put together behind the sort
    rows = rows.repartition(shuffle_partitions(turns.sparkSession), "conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")
    return rows.mapInArrow(run, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, {REPAIRED}")
