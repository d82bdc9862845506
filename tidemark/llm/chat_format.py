"""Chat formatting by token-level assembly.

A conversation becomes one text and one token sequence. Role and content of
each turn are encoded separately with an ordinary tokenizer, so no string in
them can become a reserved id; the reserved ids that mark turns are spliced
between the segments. The loss mask comes from the segments' lengths: +1 where
an assistant's content starts, -1 where it ends, and a prefix sum over the
sequence. In the text form, control strings that occur in content are escaped
reversibly, so the text can be taken apart again without the ids.

Defined results
---------------
* null role or text: empty; an empty turn keeps its marks;
* turns go by ``turn`` (null first), repeated rows and equal turns by role and text;
* null conversation id: rows of one conversation with id null;
* an empty table gives no rows; other input columns are ignored;
* a conversation is one row of the result, so its turns meet in one task; a
  hot conversation costs its own length and no more.
"""

from __future__ import annotations

import base64
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hold, slices

TURN, SEP, END = "<|turn|>", "<|sep|>", "<|end|>"
#: Strings that must not occur in formatted content; fixed values.
CONTROL = (TURN, SEP, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_FIND = re.compile(r"\\|(?=" + "|".join(map(re.escape, CONTROL)) + r").", re.S)
_BACK = re.compile(r"\\(.)", re.S)
_SPLIT = re.compile(re.escape(TURN) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END), re.S)

FORMATTED = "conv_id long, formatted string, input_ids array<int>, loss_mask array<byte>"


def escape(text: str) -> str:
    r"""Doubles each backslash and puts ``\.`` behind the first character of each control string.

    The result holds no control string: each occurrence, overlapping ones
    included, is broken behind its first character.
    """
    return _FIND.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\.", text)


def unescape(text: str) -> str:
    return _BACK.sub(lambda m: "\\" if m[1] == "\\" else "", text)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of a formatted conversation."""
    return [(unescape(a), unescape(b)) for a, b in _SPLIT.findall(formatted)]


def encoding(path: str):
    """The byte-level tokenizer of a tiktoken rank file, one per process."""

    def make():
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    return hold(("encoding", path), make)


def reserved_ids(path: str) -> dict[str, int]:
    """Ids right behind the vocabulary for the three marks."""
    first = encoding(path).max_token_value + 1
    return {mark: first + i for i, mark in enumerate((TURN, SEP, END))}


def assemble(turns: list[tuple[str, str]], path: str):
    """``(ids, mask)`` of a conversation; the mask is 1 on the content of assistants."""
    import numpy as np

    tokens, marks = encoding(path), reserved_ids(path)
    segments, flags = [], []
    for role, text in turns:
        for part, flag in (([marks[TURN]], 0), (tokens.encode_ordinary(escape(role)), 0), ([marks[SEP]], 0), (tokens.encode_ordinary(escape(text)), int(role == "assistant")), ([marks[END]], 0)):
            segments.append(part)
            flags.append(flag)
    ends = np.cumsum([len(s) for s in segments], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    size = int(ends[-1]) if len(ends) else 0
    steps = np.zeros(size + 1, dtype=np.int32)
    on = np.array(flags, dtype=bool)
    np.add.at(steps, starts[on], 1)
    np.add.at(steps, ends[on], -1)
    ids = np.fromiter((i for s in segments for i in s), dtype=np.int32, count=size)
    return ids, np.cumsum(steps[:-1]).astype(np.int8)


def loss_texts(ids, mask, path: str) -> list[str]:
    """The unescaped texts under the mask; each run of ones is one text."""
    import numpy as np

    mask = np.asarray(mask, dtype=np.int8)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
    return [unescape(encoding(path).decode(list(ids[a:b]))) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def format_chats(conversations: DataFrame, path: str) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, input_ids, loss_mask``."""
    turns = conversations.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns")
    )
    turns = turns.select("conv_id", F.transform("turns", lambda t: t["role"]).alias("roles"), F.transform("turns", lambda t: t["text"]).alias("texts"))

    def run(batches):
        import pyarrow as pa

        for part in slices(batches):
            formatted, ids, masks = [], [], []
            for roles, texts in zip(part.column("roles").to_pylist(), part.column("texts").to_pylist(), strict=True):
                pairs = list(zip(roles, texts, strict=True))
                formatted.append("".join(f"{TURN}{escape(r)}{SEP}{escape(t)}{END}" for r, t in pairs))
                i, m = assemble(pairs, path)
                ids.append(i)
                masks.append(m)
            yield pa.record_batch(
                [part.column("conv_id"), pa.array(formatted, pa.string()), pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8()))],
                names=["conv_id", "formatted", "input_ids", "loss_mask"],
            )

    return turns.mapInArrow(run, FORMATTED)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, n_loss_tokens long"


def digest_chats(formatted: DataFrame, path: str) -> DataFrame:
    """Reads formatted conversations back: turns from the text, loss texts from ids and mask."""

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        for part in slices(batches):
            out = {k: [] for k in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens")}
            for row in part.to_pylist():
                turns = read_turns(row["formatted"])
                loss = "".join(loss_texts(row["input_ids"], row["loss_mask"], path))
                for k, v in zip(
                    out,
                    (row["conv_id"], len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(row["formatted"]), len(row["input_ids"]), int(np.sum(row["loss_mask"]))),
                    strict=True,
                ):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.string() if "sha" in k else pa.int64()) for k, v in out.items()})

    return formatted.mapInArrow(run, DIGEST)
