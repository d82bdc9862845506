"""BPE encoding by speculation and verification, and decoding.

**Speculate.** A word is cut greedily into the longest vocabulary tokens. Only
tokens that encode alone as themselves are proposed; which ones do is found
once, when the vocabulary is prepared.

**Verify.** A sequence of such tokens is what merging gives if and only if no
merge crosses the border of any two neighbours. Merges go by rank, and a merge
never has a lower rank than those that made its parts (checked on the
vocabulary), so the tokens at a border change in the order of their ranks: on
the left side along the right edge of the token's merge tree, on the right
side along the left edge. All adjacent pairs of all proposed words are tested
at once, from the whole tokens down to single bytes: a pair fails if what
stands at its border at some time can merge before either side goes on. Of
equal ranks the left one goes first, as in merging itself.

**Merge.** Words with a failing pair, and no others, are merged exactly by the
library's model. A vocabulary in which a token has two merges, or a merge that
comes before its parts, has all words merged exactly.

Chunks between ASCII white space are encoded once and remembered (in a cache of
bounded size); white space ends every pre-token of the tokenizer, and no normal
form or lower case reaches over it. Chunks of plain Latin are split by the
tokenizer's pattern here, all others by the tokenizer's own normalizer and
pre-tokenizer; special strings in a text become their ids, as in the library.

Decoding joins token strings as the tokenizer's ``decode`` does: this
vocabulary has no decoder, so they stand between single spaces, end marks
included.

Defined results: null text is empty; an empty text has no ids and decodes to an
empty text; texts are encoded whole; repeated rows stay; columns other than the
id and the text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hold, slices, text_or_empty
from tidemark.llm.packing import _PLAIN, _WORDS

END = "</w>"
#: Remembered chunks per Python process; the cache starts anew beyond it.
CACHE_ENTRIES = 300_000
_SPACE = re.compile("[\t-\r ]+")
_NONE = 1 << 40


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Vocabulary:
    """Merge trees of a BPE vocabulary with end-of-word marks, as arrays by token id."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        import numpy as np

        self.size = size = max(vocab.values()) + 1
        self.rank, self.left, self.right = np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int64)
        l, r = np.array([vocab[a] for a, _ in merges], dtype=np.int64), np.array([vocab[b] for _, b in merges], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        ranks = np.arange(len(merges), dtype=np.int64)
        self.rank[made], self.left[made], self.right[made] = ranks, l, r
        keys = l * size + r
        order = np.argsort(keys)
        self.keys, self.key_ranks = keys[order], ranks[order]
        self.sound = len(set(made.tolist())) == len(made) and bool((self.rank[l] < ranks).all() and (self.rank[r] < ranks).all())
        to_byte = {c: b for b, c in byte_letters().items()}
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        base = [len(t.removesuffix(END)) == 1 for t in vocab]
        stable = np.zeros(size, dtype=bool)
        if self.sound:
            stable[made] = ~self.crossed(l, r, ranks, ranks)
            # a token is stable if its parts are, too: parts have lower ranks, so they come first
            for t, a, b in zip(made.tolist(), l.tolist(), r.tolist(), strict=True):
                stable[t] &= (stable[a] or self.rank[a] < 0) and (stable[b] or self.rank[b] < 0)
        for (token, i), single in zip(vocab.items(), base, strict=True):
            if single or stable[i]:
                letters = token.removesuffix(END) if token != END else token
                if all(c in to_byte for c in letters):
                    (self.final if token.endswith(END) and token != END else self.inner)[bytes(to_byte[c] for c in letters)] = i
        self.starts = {t[:k] for t in self.inner for k in range(1, len(t) + 1)}

    def _ranks(self, x, y):
        """The rank of merging each pair; ``_NONE`` if it can't be merged."""
        import numpy as np

        wanted = x * self.size + y
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.key_ranks[at], _NONE) if len(self.keys) else np.full(len(wanted), _NONE)

    def crossed(self, x, y, left_ends, right_ends):
        """Whether a merge crosses the border of the tokens ``x`` and ``y`` while they grow, the last state of which ends at the given ranks."""
        import numpy as np

        bad, alive = np.zeros(len(x), dtype=bool), np.arange(len(x))
        while len(alive):
            m = self._ranks(x, y)
            hit = (m < left_ends) & (m <= right_ends)
            bad[alive[hit]] = True
            rx, ry = self.rank[x], self.rank[y]
            on = ~hit & ((rx >= 0) | (ry >= 0))
            alive, x, y, left_ends, right_ends, rx, ry = (v[on] for v in (alive, x, y, left_ends, right_ends, rx, ry))
            undo_left = rx > ry  # back in time: what was merged last comes apart first
            left_ends, right_ends = np.where(undo_left, rx, left_ends), np.where(undo_left, right_ends, ry)
            x, y = np.where(undo_left, self.right[x], x), np.where(undo_left, y, self.left[y])
        return bad

    def compatible(self, x, y):
        """Whether merging leaves each pair of neighbours as it is."""
        import numpy as np

        pairs, back = np.unique(x * self.size + y, return_inverse=True)
        never = np.full(len(pairs), _NONE - 1)
        return ~self.crossed(pairs // self.size, pairs % self.size, never, never)[back]

    def propose(self, word: bytes) -> list[int]:
        """Longest matches from the left; the last one holds the end of the word. Empty if bytes are missing in the vocabulary."""
        out, at, n = [], 0, len(word)
        inner, final, starts = self.inner, self.final, self.starts
        while at < n:
            found = final.get(word[at:])
            if found is not None:
                out.append(found)
                return out
            end, stop = at + 1, 0
            while end < n and (part := word[at:end]) in starts:
                token = inner.get(part)
                if token is not None:
                    found, stop = token, end
                end += 1
            if found is None:
                return []
            out.append(found)
            at = stop
        return out


class Codec:
    """Encodes and decodes with a tokenizer file; holds the bounded cache."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.vocabulary = Vocabulary(model["vocab"], [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]])
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        letters = byte_letters()
        self.letters = [letters[b] for b in range(256)]
        self.bytes = {c: b for b, c in letters.items()}
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.strings = [b""] * (max(names.values()) + 1)
        for token, i in names.items():
            self.strings[i] = token.encode()
        self.cache: dict[str, bytes] = {}
        #: Words proposed so far and those of them that were merged exactly.
        self.proposed = self.merged = 0

    # -- words

    def exact(self, word: bytes) -> bytes:
        import numpy as np

        return np.array([t.id for t in self.tokenizer.model.tokenize("".join(map(self.letters.__getitem__, word)))], dtype="<u4").tobytes()

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit numbers."""
        import numpy as np

        self.proposed += len(words)
        if not self.vocabulary.sound:
            self.merged += len(words)
            return [self.exact(w) for w in words]
        proposals = [self.vocabulary.propose(w) for w in words]
        sizes = np.array([len(p) for p in proposals], dtype=np.int64)
        flat = np.fromiter((i for p in proposals for i in p), dtype=np.int64, count=int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        wrong = sizes == 0
        if len(flat) > 1:
            inside = np.flatnonzero(owner[1:] == owner[:-1])
            fails = ~self.vocabulary.compatible(flat[inside], flat[inside + 1])
            wrong[owner[inside[fails]]] = True
        data, ends = flat.astype("<u4").tobytes(), 4 * np.cumsum(sizes)
        out = list(map(data.__getitem__, map(slice, (ends - 4 * sizes).tolist(), ends.tolist())))
        for i in np.flatnonzero(wrong).tolist():
            out[i] = self.exact(words[i])
        self.merged += int(wrong.sum())
        return out

    def _split(self, chunk: str) -> list[bytes]:
        """The pre-tokens of a chunk; one behind a null character is not plain."""
        if chunk[0] != "\0":
            return [w.encode() for w in _WORDS.findall(chunk)]
        normal = self.tokenizer.normalizer.normalize_str(chunk[1:])
        return [bytes(self.bytes[c] for c in w) for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    # -- texts

    def _chunks(self, text: str) -> list[str]:
        """Keys of the cache: chunks in lower case, ``\\0`` and the chunk for others, ``\\0\\0`` and the string for special ones."""
        if self.marks is None or not any(s in text for s in self.special):
            if _PLAIN.fullmatch(text):
                return text.lower().split()
            sections = [text]
        else:
            sections = self.marks.split(text)
        out = []
        for k, section in enumerate(sections):
            if k % 2:
                out.append("\0\0" + section)
            else:
                out += [c.lower() if _PLAIN.fullmatch(c) else "\0" + c for c in _SPACE.split(section) if c]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        chunks = [self._chunks(t) for t in texts]
        missing = set().union(*chunks).difference(self.cache)
        known, cache = self.cache, self.cache
        if len(cache) + len(missing) > CACHE_ENTRIES:
            cache.clear()
            missing = set().union(*chunks)
            if len(missing) > CACHE_ENTRIES:  # of one very long text: not kept
                known = {}
        if missing:
            special = {c for c in missing if c.startswith("\0\0") and c[2:] in self.special}
            ordinary = list(missing - special)
            parts = [self._split(c) for c in ordinary]
            words = list({w for p in parts for w in p})
            ids = dict(zip(words, self.words(words), strict=True))
            known.update((c, b"".join(map(ids.__getitem__, p))) for c, p in zip(ordinary, parts, strict=True))
            known.update((c, self.special[c[2:]].to_bytes(4, "little")) for c in special)
        get = known.__getitem__
        return [b"".join(map(get, c)) for c in chunks]

    def decode(self, ids: bytes) -> bytes:
        """The decoded text in UTF-8."""
        import numpy as np

        return b" ".join(map(self.strings.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def codec(path: str) -> Codec:
    return hold(("codec", path), lambda: Codec(path))


# ---------------------------------------------------------------- the operator


def encode(docs: DataFrame, path: str, decoded: bool = False, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_tokens, ids`` of every row, and the text that the ids decode to as ``decoded`` if asked for.

    ``ids`` is binary: little-endian unsigned 32-bit numbers; see :func:`as_arrays`.
    """

    def run(batches):
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        made = codec(path)
        for part in slices(batches):
            ids = made.encode(part.column("text").to_pylist())
            columns = [part.column("id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array(map(made.decode, ids), pa.binary()).cast(pa.string()))
            yield pa.record_batch(columns, names=["id", "n_tokens", "ids", "decoded"][: len(columns)])

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text).alias("text"))
    kind = f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids binary" + (", decoded string" if decoded else "")
    return rows.mapInArrow(run, kind).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, name: str = "decoded", ids: str = "ids") -> DataFrame:
    """``encoded`` with the text of its ``ids`` (null: null); other columns stay."""

    def run(batches):
        import pyarrow as pa

        made = codec(path)
        for part in batches:
            yield pa.record_batch([*part.columns[:-1], pa.array([None if x is None else made.decode(x).decode() for x in part.columns[-1].to_pylist()], pa.string())], names=[*part.schema.names[:-1], "out"])

    kept = [c for c in encoded.columns if c != name]
    rows = encoded.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(kept)], F.col(ids).alias("ids"))
    kind = "".join(f"_{i} {encoded.schema[c].dataType.simpleString()}, " for i, c in enumerate(kept)) + "out string"
    return rows.mapInArrow(run, kind).select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(kept)], F.col("out").alias(name))


def as_arrays(encoded: DataFrame, ids: str = "ids") -> DataFrame:
    """``encoded`` with its binary ids as an array of integers."""
    n = (F.octet_length(ids) / 4).cast("int")
    digits = lambda i: [F.hex(F.substring(F.col(ids), i * 4 + k, F.lit(1))) for k in (4, 3, 2, 1)]  # noqa: E731  the highest byte first
    number = lambda i: F.conv(F.concat(*digits(i)), 16, 10).cast("int")
    return encoded.withColumn(ids, F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), number)).otherwise(F.array().cast("array<int>")))
