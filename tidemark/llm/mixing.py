"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow whose documents, in a fixed pseudo-random order and
repeated in rounds, are served one after another. A copy's *virtual finish
time* is the number of words its source has sent when the copy ends, divided
by the source's target. Serving all flows by virtual finish time and stopping
when the budget of words is spent gives each source its target share.

Nothing is ordered in one task: the running word count of a source is built
from the sums of hashed buckets plus a window inside each bucket. The copies
(ids and sizes, no texts) are then range-sorted by finish time; sums of the
ranges tell in which one the budget ends, and that one is cut by a running sum.

Defined results
---------------
* null or empty texts have size 0: they belong to their source, are never
  taken more than once and cost nothing;
* null source: a source of its own, last in order;
* repeated rows are documents of their own: they are counted, dealt out by
  number and never folded; rows that differ in any column are different, so of
  rows that share an id, or have none, each keeps its columns;
* equal finish times go by source, bucket and place inside it, which depend on columns of the row alone;
* an empty table, or one without a single word, takes nothing;
* input columns with names of the output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, free_name, shuffle_partitions

#: Weights by order of source, repeating.
WEIGHTS = (1, 2, 3)
#: A source gives at most this many times its own words, each document at most as many copies.
MOST_ROUNDS = 3
#: Documents of a source that share one hashed bucket, on average.
BUCKET_ROWS = 4096
#: Repeats of one row that are dealt out together.
REPEATS = 4096
#: The order of the mix.
ORDER = ("finish", "row_key", "round")


def word_count(text: Column) -> Column:
    """Runs of anything but space, tab, line feed, vertical tab, form feed and carriage return; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.0, weights=WEIGHTS, most: int = MOST_ROUNDS) -> DataFrame:
    """``source, source_size, docs, target`` of a table with ``source`` and ``size``.

    The k-th source in code-point order (null last) weighs ``weights[k % len]``.
    Together the targets are ``share`` of all words; a target above ``most``
    times its source is cut to that and the excess goes to the others by
    weight, until none is above. Only totals (three numbers a round) reach the
    driver; a round caps at least one source or is the last.
    """
    ranked = Window.orderBy(F.col("source").isNull(), "source")  # a row per source, not per document
    table = cut_lineage(
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
        .withColumn("k", F.row_number().over(ranked) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") % len(weights) + 1).cast("int")))
    )
    limit = F.col("source_size") * float(most)
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    per_weight = None
    while True:
        capped = F.lit(False) if per_weight is None else F.col("weight") * per_weight >= limit
        cut, rest = table.agg(F.sum(F.when(capped, limit).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        level = (total - (cut or 0.0)) / rest if rest else None
        if level is None or level == per_weight:
            break
        per_weight = level
        # a level only rises as sources are capped, so the set of capped ones only grows
        if not table.where((F.col("weight") * per_weight >= limit) & ~capped).limit(1).count():
            break
    target = F.least(F.col("weight") * F.lit(per_weight), limit) if per_weight is not None else F.lit(0.0)
    return table.select("source", "source_size", "docs", target.cast("double").alias("target"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0, share: float = 1.0, weights=WEIGHTS, most: int = MOST_ROUNDS
) -> DataFrame:
    """One row per copy the mix takes, without texts.

    Columns: the id, ``source``, ``row_key``, ``size``, ``source_size``,
    ``target``, ``round`` (from 0) and ``finish``; ordering by
    ``finish, row_key, round`` is the order of the mix.
    """
    return _mix(docs, id_col, text, source, seed, share, weights, most)[1]


def mix_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0, **options) -> DataFrame:
    """Every document with ``size``, ``source_size``, ``target`` and the words ``taken`` of it."""
    queue, copies = _mix(docs, id_col, text, source, seed, **{"share": 1.0, "weights": WEIGHTS, "most": MOST_ROUNDS} | options)
    per_row = copies.groupBy("row_key").agg(F.count("*").alias("copies"))
    return queue.join(per_row, "row_key", "left").select(
        id_col, source, "size", "source_size", "target", (F.col("size") * F.coalesce("copies", F.lit(0))).alias("taken"), F.coalesce("copies", F.lit(0)).alias("copies")
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    queue, copies = _mix(docs, id_col, text, source, seed, **{"share": 1.0, "weights": WEIGHTS, "most": MOST_ROUNDS} | options)
    key, content, count, several, copy = (free_name(n, docs.columns) for n in ("key", "content", "copies", "rows", "copy"))
    per_row = copies.groupBy("row_key").agg(F.count("*").alias("n"))
    taken = queue.join(per_row, "row_key").groupBy(F.col(id_col).alias(key), F.col("content").alias(content))
    taken = cut_lineage(taken.agg(F.sum("n").alias(count), F.count("*").alias(several)))
    rows = docs
    if taken.where(F.col(several) > 1).limit(1).count():  # rows alike in all columns: one of them stands for all
        own = free_name("own", docs.columns, [key, content])
        rows = docs.withColumns({key: docs[id_col], own: _content(docs, docs.columns)}).dropDuplicates([key, own]).drop(key, own)
    taken = taken.hint("merge")  # texts go by merge join at every size, so that the plan is the one that was measured
    rows = rows.join(taken, rows[id_col].eqNullSafe(taken[key]) & (_content(rows, docs.columns) == taken[content]))
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(count).cast("int")))).select(*docs.columns)


def _content(docs: DataFrame, columns: list[str]) -> Column:
    """128 bits of hash over some columns (those that may hold maps by their JSON form)."""
    told = [F.to_json(F.struct(docs[c])) if "map<" in docs.schema[c].dataType.simpleString() else docs[c] for c in columns]
    return F.struct(F.xxhash64(*told).alias("h1"), F.xxhash64(F.lit(1), *told).alias("h2"))


def in_mix_order(copies: DataFrame) -> DataFrame:
    """``copies`` range-partitioned and sorted by virtual finish time."""
    return copies.repartitionByRange(shuffle_partitions(copies.sparkSession), *ORDER).sortWithinPartitions(*ORDER)


def _mix(docs, id_col, text, source, seed, share, weights, most):
    rows = docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), _content(docs, docs.columns).alias("content"))
    # repeated rows are counted and made again in two steps, so that many of them are never one task's
    counted = rows.groupBy("id", "source", "size", "content").agg(F.count("*").alias("n"))
    dealt = counted.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / REPEATS))))
    first = F.col("part") * REPEATS
    dealt = dealt.withColumn("number", F.explode(F.sequence(first, F.least(F.col("n"), first + REPEATS) - 1)))
    sizes = cut_lineage(dealt.select("id", "source", "size", "content", F.xxhash64("id", "content", "number", F.lit(seed)).alias("shuffled")))
    targets = source_targets(sizes, share, weights, most)
    buckets = F.greatest(F.lit(1), F.ceil(F.col("docs") / BUCKET_ROWS)).cast("long")
    # the upper bits of the shuffled key pick the bucket, so buckets are consecutive stretches of the shuffled order
    unsigned = F.shiftrightunsigned("shuffled", 33)
    spread = targets.withColumn("buckets", buckets)
    rows = _on_source(sizes, F.broadcast(spread) if spread.count() <= 10_000 else spread).withColumn("bucket", F.floor(unsigned * F.col("buckets") / F.lit(1 << 31)).cast("long"))

    key = ["source", "bucket"]
    sums = rows.groupBy(*key).agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*key, F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("start")).withColumnRenamed("bucket", "b_bucket").withColumnRenamed("source", "b_source")
    inside = Window.partitionBy(*key).orderBy("shuffled", "id", "content", "size").rowsBetween(Window.unboundedPreceding, 0)
    queue = rows.withColumn("upto", F.sum("size").over(inside)).withColumn("place", F.count("*").over(inside))
    queue = queue.join(starts, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    queue = cut_lineage(
        queue.select(
            F.col("id").alias(id_col), F.col("source").alias(source), "content", "size", "source_size", "target", (F.col("start") + F.col("upto")).alias("served"),
            F.concat_ws("-", F.coalesce(F.xxhash64("source"), F.lit(0)), "bucket", "place").alias("row_key"),
        )
    )

    # copies of a round: the words of the rounds before come on top; a copy that starts past 1.5 targets can't be reached
    rounds = F.sequence(F.lit(0), F.lit(most - 1))
    copies = (
        queue.where((F.col("size") > 0) & (F.col("target") > 0))
        .withColumn("round", F.explode(rounds))
        .withColumn("finish", (F.col("round") * F.col("source_size") + F.col("served")) / F.col("target"))
    )
    budget = int(round((targets.agg(F.sum("target")).first()[0] or 0.0)))
    # the queue: copies range-sorted by finish time; whole ranges are in or out, and one is cut where the budget ends
    ranged = cut_lineage(in_mix_order(copies).withColumn("range", F.spark_partition_id()))
    sums = ranged.groupBy("range").agg(F.sum("size").alias("words")).withColumn("upto", F.sum("words").over(Window.orderBy("range")))  # a row per range
    edge = sums.where(F.col("upto") > budget).agg(F.min(F.struct("range", "upto", "words")).alias("e")).first()["e"]
    if edge is None:
        return queue, ranged.drop("range")
    run = Window.partitionBy("range").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    last = ranged.where(F.col("range") == edge["range"]).withColumn("run", F.sum("size").over(run)).where(F.col("run") <= budget - (edge["upto"] - edge["words"])).drop("run")
    return queue, ranged.where(F.col("range") < edge["range"]).unionByName(last).drop("range")


def _on_source(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` with the columns of their source's row in ``table`` (null meets null)."""
    table = table.withColumnRenamed("source", "t_source")
    return rows.join(table, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
