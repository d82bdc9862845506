"""Language choice from definitions alone, and minimum hashes against the overlap of true phrase sets."""

import functools
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import langid, lz_fingerprint


@functools.cache
def letter(code, places):
    return np.roll(langid.letter_vector(code).astype(np.int64), places)


def bundled(text):
    """Sum of the text's n-gram vectors, letter by letter, and their number."""
    marks = []
    for c in f" {text.lower()} ":
        if c.isalpha():
            marks.append(ord(c))
        elif not marks or marks[-1]:
            marks.append(0)
    counts = defaultdict(int)
    for gram in zip(marks, marks[1:], marks[2:], strict=False):
        if any(gram):
            counts[gram] += 1
    total = np.zeros(langid.DIMENSIONS, dtype=np.int64)
    for gram, n in counts.items():
        total += n * np.prod([letter(c, 2 - k) for k, c in enumerate(gram)], axis=0)
    return total, sum(counts.values())


def test_language_choice_by_definition(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("text", F.substring("text", 1, 400)).orderBy("doc_id")
    rows = docs.select("doc_id", "text", "lang").collect()
    learned, asked = rows[:120], rows[100:200]
    sums = defaultdict(lambda: np.zeros(langid.DIMENSIONS))
    for r in learned:
        if r["lang"] is not None and r["text"] is not None:
            v, n = bundled(r["text"])
            sums[r["lang"]] += v / max(1, n)
    names = sorted(sums)
    protos = np.array([sums[x] / np.linalg.norm(sums[x]) for x in names])
    frame = lambda some: spark.createDataFrame([(r["doc_id"], r["text"], r["lang"]) for r in some], "doc_id long, text string, lang string")
    prototypes = langid.learn(frame(learned))
    assert sorted(prototypes) == names
    for name, p in zip(names, protos, strict=True):
        mine = np.array(prototypes[name], dtype=float)
        assert np.allclose(mine / np.linalg.norm(mine), p, atol=1e-5)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.classify(frame(asked), prototypes).collect()}
    for r in asked:
        v, n = bundled(r["text"] or "")
        if not n:
            assert got[r["doc_id"]] == ("und", 0.0)
            continue
        cosines = protos @ v / max(np.linalg.norm(v), 1e-12)
        best = np.sort(cosines)[::-1]
        assert abs(got[r["doc_id"]][1] - max(0.0, best[0])) < 1e-4
        if best[0] - best[1] > 1e-4:
            assert got[r["doc_id"]][0] == names[int(cosines.argmax())]


def phrases(text):
    known, at = set(), 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at:end] in known:
            end += 1
        known.add(text[at:end])
        at = end
    return known


def test_minimum_hashes_follow_the_overlap_of_phrase_sets(spark, sf):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    order = sorted(texts, reverse=True)
    got = {r["doc_id"]: r for r in lz_fingerprint.edit_likeness(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    errors = []
    for k, i in enumerate(order):
        text, following = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        for other, name in ((text[: len(text) - half] + following[:half], "near_edited"), (following, "near_next")):
            a, b = phrases(text), phrases(other)
            if min(len(a), len(b)) >= 200:
                errors.append(got[i][name] - len(a & b) / len(a | b))
            if text == other:
                assert got[i][name] == 1.0
    # 64 slots: a deviation of at most a sixteenth each, and no bias
    assert len(errors) > 50 and abs(np.mean(errors)) < 0.03 and np.mean(np.abs(errors)) < 0.07 and np.max(np.abs(errors)) < 0.3
