"""The stages take effect, one after another."""

import sys
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import langid, minhash, packing, toxicity
from tidemark.llm.queries import tokenizer

sys.path.insert(0, str(Path(__file__).parent))
from test_operators import brute_classes  # noqa: E402


def test_stages(spark):
    sf = "/root/testdata/sf0.01"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "near_duplicates", "mix_sources", "pack"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, sf).cache()
    assert clean.columns == docs.columns
    rejected = docs.join(clean.select("doc_id"), "doc_id", "left_anti").join(labels, "doc_id")
    assert rejected.where("toxic = 0").count() <= 0.01 * labels.where("toxic = 0").count() and rejected.where("toxic = 1").count() > 0.7 * labels.where("toxic = 1").count()
    scores = toxicity.score(clean, toxicity.fit(docs, labels))
    assert scores.where("predicted = 1").count() == 0
    known = stages["language_id"](spark, clean, sf).cache()
    assert clean.count() - known.count() == langid.classify(clean, langid.learn(clean)).where(f"lang_pred = 'und' or score <= {corpus_pipeline.CHANCE}").count()
    single = stages["near_duplicates"](spark, known, sf).cache()
    classes = minhash.classes(known)
    assert single.count() == classes.select("class_id").distinct().count()
    mixed = stages["mix_sources"](spark, single, sf).cache()
    assert mixed.columns == docs.columns and mixed.select("doc_id").distinct().join(single, "doc_id", "left_anti").count() == 0
    packed = stages["pack"](spark, mixed, sf)
    assert packed.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()


def test_run(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and all(r["offset"] + r["length"] <= 4096 for r in rows)
    assert corpus_pipeline.ORACLE_SQL is None


def test_awkward_table(spark, sf):
    """Nulls, empty and repeated rows, one id with two texts and clashing names go through every stage; an empty table gives nothing."""
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(60)
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "web", 0), (9003, " 12 ", "en", "web", 4), (None, "the one and the other", "en", "web", 21)], base.schema)
    one = base.limit(1)
    again = one.unionByName(one).unionByName(one.withColumn("text", F.lit("quite another text of more than five words")))
    docs = base.unionByName(odd).unionByName(again).withColumns({c: F.lit("clash") for c in ("_copies", "_copy", "_kept", "best", "_features", "score", "predicted", "_score", "_predicted", "_lang", "lang_pred", "size", "words", "id", "label", "length", "piece", "ids")})
    texts = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, sf).cache()
        if name != "pack":
            assert docs.columns == before.columns and docs.where("_copies <> 'clash' or best <> 'clash'").count() == 0
        assert stage(spark, before.limit(0), sf).count() == 0
        texts[name] = Counter((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()) if name != "pack" else None
    assert not {9001, 9002, 9003} & {d for d, _ in texts["language_id"]} and (None, "the one and the other") in texts["language_id"]
    # one row of each class of near copies, by brute force, and one of each id
    rows, kept = [(d, t) for d, t in texts["language_id"] if d is not None], {}
    for d, t in sorted(rows, key=str):
        kept.setdefault(d, t)
    classes = brute_classes({i: t for i, (_, t) in enumerate(sorted(rows, key=lambda x: (x[0], str(x[1]))))})
    assert len({d for d, _ in texts["near_duplicates"] if d is not None}) == len([d for d, _ in texts["near_duplicates"] if d is not None]) <= len(set(classes.values()))
    assert set(texts["near_duplicates"]) <= set(texts["language_id"]) and set(texts["mix_sources"]) <= set(texts["near_duplicates"])
    # the pieces of all mixed documents, each once
    library, want = Tokenizer.from_file(tokenizer("word_bpe_49k.json")), Counter()
    for (d, t), n in texts["mix_sources"].items():
        ids = len(library.encode(t or "", add_special_tokens=False).ids) + 1
        for k in range(0, ids, 4096):
            want[d, k // 4096, min(4096, ids - k)] += n
    rows = docs.collect()
    assert Counter((r["doc_id"], r["piece"], r["length"]) for r in rows) == want
    # the sequences hold the ids of those pieces and nothing else
    ids, filled = Counter(), 0
    for (_, t), n in texts["mix_sources"].items():
        for i in [*library.encode(t or "", add_special_tokens=False).ids, 1]:
            ids[i] += n
    for r in packing.sequences(docs).collect():
        assert len(r["ids"]) <= 4096
        ids.subtract(r["ids"])
        filled += len(r["ids"])
    assert filled == sum(r["length"] for r in rows) and not any(ids.values())
