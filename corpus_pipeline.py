"""From raw documents to packed training sequences.

The stages, in order: toxic documents go; documents whose language cannot be
told go; of near duplicates one document stays; sources are mixed to their
target weights, which drops and repeats documents; what is left is packed into
sequences. Every stage works on all that its predecessor kept.

Defined results
---------------
* null texts are empty; texts without a letter are dropped by ``language_id``,
  as no language can be told, so empty ones go there;
* without labels of both kinds nothing counts as toxic, unless all are;
* without a learned language every text is ``und`` and goes;
* rows that share an id are folded to one by ``near_duplicates``, the same on every run; rows without an id stay;
* ``mix_sources`` returns a row for each copy it takes, so an id may come several times and is then packed as often;
* texts are read whole; other columns, whatever their names, go through the first four stages unchanged;
* an empty table gives no rows at every stage.

``pack`` returns a row per piece with its token ids, its sequence and its place
there; ``packing.sequences`` puts the pieces of each sequence together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, minhash, mixing, packing, toxicity
from tidemark.llm.common import Scratch
from tidemark.llm.queries import table, tokenizer

#: Cosines up to this are what unrelated vectors have by chance: a standard deviation in 1024 dimensions.
CHANCE = 1 / 32


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, names=("_score", "_predicted"))
    return scored.where("_predicted = 0").select(*docs.columns)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = langid.classify(docs, langid.learn(docs), names=("_lang", "_score"))
    return found.where((F.col("_lang") != "und") & (F.col("_score") > CHANCE)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicate(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("near_duplicates", drop_near_duplicates),
    ("mix_sources", mix),
    ("pack", pack),
]

#: Models, signatures and packing plans are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result but the last is written and read again, and removed when the next one is written."""
    docs, written = table(spark, sf_dir, "documents"), Scratch(spark)
    for _, stage in STAGES[:-1]:
        kept = written.cut(stage(spark, docs, sf_dir))
        written.drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
