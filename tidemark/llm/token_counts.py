"""Token counts by the whole-token shortcut.

A sentencepiece BPE model merges neighbouring symbols. If no piece of its
vocabulary holds a word mark (U+2581) behind another character, no merge can
cross the place between a character and a following mark, so the count of a
text is the sum over its *pre-tokens*: a run of marks with what follows it.
The same holds before a line feed when no longer piece holds one. Both facts
are proved on the vocabulary when the model is prepared; a model that fails
them is counted by the library on whole texts.

Preparing also finds, once and offline, the vocabulary strings that encode
alone as one token. Pre-tokens among them count one without any merge; each
other distinct pre-token is merged by the library once and remembered in a
cache of bounded size.

Defined results: null text is empty; an empty text has no tokens; every text
is counted whole, whatever its length; repeated rows stay; input columns other
than the id and the text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hold, slices, text_or_empty

MARK = "▁"
#: Remembered pre-tokens per Python process; the cache starts anew beyond it.
CACHE_ENTRIES = 200_000

def model(path: str):
    def make():
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)

    return hold(("pieces", path), make)


def prepare(path: str) -> dict:
    """Proofs and whole tokens of a model: ``additive``, ``lines``, ``whole``."""
    sp = model(path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    ordinary = [p for i, p in enumerate(pieces) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    additive = all(MARK not in p.lstrip(MARK) for p in ordinary) and sp.encode("a") == sp.encode("a", add_bos=False, add_eos=False)
    # the model must leave characters and spaces as they are, and put one mark in front
    probe = "A  ½ ﬁ b "
    additive = additive and "".join(sp.encode(probe, out_type=str)).startswith(MARK) and sp.decode(sp.encode(probe)) == probe
    lines = all("\n" not in p or p == "\n" for p in ordinary)
    whole = [p[1:] for p in ordinary if len(p) > 1 and p[0] == MARK and p[1] != MARK]
    counts = sp.encode(whole)
    return {"additive": additive, "lines": lines, "whole": frozenset(w for w, ids in zip(whole, counts, strict=True) if len(ids) == 1)}


class Counter:
    """Counts texts with one model; holds the bounded cache."""

    def __init__(self, path: str, facts: dict):
        self.sp, self.facts = model(path), facts
        self.cache: dict[str, int] = {}
        self._reset()

    def _reset(self):
        self.cache = dict.fromkeys(self.facts["whole"], 1)

    def count(self, texts: list[str]) -> list[int]:
        if not self.facts["additive"]:
            return [len(x) for x in self.sp.encode(texts, num_threads=1)]
        split = [self._chunks(t) for t in texts]
        get, missing = self.cache.get, set()
        for chunks in split:
            missing.update(c for c in chunks if get(c) is None)
        if missing:
            if len(self.cache) + len(missing) > CACHE_ENTRIES:
                self._reset()
                missing = {c for chunks in split for c in chunks if c not in self.cache}
            missing = list(missing)
            # a leading line feed is split off from the mark in front, which is then one token too many
            for c, ids in zip(missing, self.sp.encode([self._plain(c) for c in missing], num_threads=1), strict=True):
                self.cache[c] = 1 if c == MARK else len(ids) - (c[:1] == "\n")
        get = self.cache.__getitem__
        return [sum(map(get, chunks)) for chunks in split]

    @staticmethod
    def _plain(chunk: str) -> str:
        """What to encode so that the library's own first mark completes the chunk."""
        return chunk[1:].replace(MARK, " ") if chunk[:1] == MARK else chunk

    def _chunks(self, text: str) -> list[str]:
        """Pre-tokens: ``word`` stands for mark + word, a longer run of marks is spelled out, a leading line feed means no mark."""
        if not text:
            return []
        if MARK in text:
            text = text.replace(MARK, " ")
        if self.facts["lines"]:
            text = text.replace("\n", " \n")
        parts = text.split(" ")
        if "" not in parts and not (parts[0][:1] == "\n"):
            return parts
        # runs of spaces, or a text that starts or ends with one
        out, run, lines = [], 0, self.facts["lines"]
        for p in parts:
            if p and lines and p[0] == "\n":  # the space in front was put there for the split
                if run:
                    out.append(MARK * run)
                out.append(p)
                run = 0
            else:
                run += 1
                if p:
                    out.append(p if run == 1 else MARK * run + p)
                    run = 0
        if run:
            out.append(MARK * run)
        return out


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of every row."""
    # bounded by the vocabulary: tens of thousands of short strings
    facts = docs.sparkSession.sparkContext.broadcast(prepare(path))

    def run(batches):
        import pyarrow as pa

        counter = hold(("counter", path), lambda: Counter(path, facts.value))
        for part in slices(batches):
            counts = counter.count(part.column("text").to_pylist())
            yield pa.record_batch([part.column("id"), part.column("n_bytes"), pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text_or_empty(text)).cast("long").alias("n_bytes"), text_or_empty(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long").select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
