"""Aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import bucket


def share(part: Column, whole: Column) -> Column:
    """``part / whole``, 0.0 where the whole is 0 or null."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.lit(0.0)).otherwise(part / whole)


def count_where(test: Column) -> Column:
    return F.count_if(test)


def distinct_where(test: Column, column: str) -> Column:
    return F.count_distinct(F.when(test, F.col(column)))


def edges(df: DataFrame, source: str, target: str, ts: str, amount: str, grains=("day", "week", "month", "year"), extra_keys=(), flags=(), currency: str | None = None) -> DataFrame:
    """Edge table: a row per (from, to, bucket) with counts, amounts and the active window, all granularities in one scan.

    Rows are summed by the shortest bucket that the others are made of. A sum that
    has a longer bucket to itself, as those next to it in time tell, is that
    bucket's row as it is; only the others are summed again.
    """
    edge = [*extra_keys, f"from_{source}", f"to_{target}"]
    rows = df.withColumn("_at", bucket(F.col(ts), "hour" if "hour" in grains else "day"))
    sums = {"tx_count": F.sum, "total_amount": F.sum} | ({"currency_hint": F.max} if currency else {}) | {"first_event_ts": F.min, "last_event_ts": F.max} | {f"{f}_edge": F.max for f in flags}
    short = rows.groupBy(*extra_keys, F.col(source).alias(f"from_{source}"), F.col(target).alias(f"to_{target}"), "_at").agg(
        F.count("*").alias("tx_count"),
        F.sum(F.coalesce(amount, F.lit(0.0))).alias("total_amount"),
        *([F.max(currency).alias("currency_hint")] if currency else []),
        F.min(ts).alias("first_event_ts"),
        F.max(ts).alias("last_event_ts"),
        *[F.max(f).alias(f"{f}_edge") for f in flags],
    )
    near = Window.partitionBy(*edge).orderBy("_at")  # a row per short bucket
    short = short.withColumns({"_before": F.lag("_at").over(near), "_behind": F.lead("_at").over(near)})
    shared = lambda g: bucket(F.col("_at"), g).eqNullSafe(bucket(F.col("_before"), g)) | bucket(F.col("_at"), g).eqNullSafe(bucket(F.col("_behind"), g))
    # a row for each longer bucket that others share, and one for all that it has to itself, whose bits are its key: one aggregate sees both, and df is read once
    spot = lambda g, start, own: F.struct(g.cast("string").alias("_grain"), start.alias("_start"), own.cast("int").alias("_own"))
    own = sum((F.when(shared(g), 0).otherwise(1 << i) for i, g in enumerate(grains)), F.lit(0))
    spots = [F.when(own > 0, spot(F.lit(None), F.col("_at"), own)), *[F.when(shared(g), spot(F.lit(g), bucket(F.col("_at"), g), F.lit(0))) for g in grains]]
    placed = short.select(*edge, *sums, F.inline(F.array(*spots))).where("_own is not null")
    summed = placed.groupBy(*edge[::-1], "_start", "_grain", "_own").agg(*[f(c).alias(c) for c, f in sums.items()])
    name = lambda g, start: F.struct(g.alias("bucket_granularity"), start.alias("bucket_start"))
    each = [F.when(F.col("_own") == 0, name(F.col("_grain"), F.col("_start"))), *[F.when(F.col("_own").bitwiseAND(1 << i) > 0, name(F.lit(g), bucket(F.col("_start"), g))) for i, g in enumerate(grains)]]
    names = [*extra_keys, "bucket_granularity", "bucket_start", *edge[len(extra_keys) :]]
    out = summed.select(*edge, *sums, F.inline(F.array(*each))).where("bucket_granularity is not null").select(*names, *sums)
    window = F.unix_timestamp("last_event_ts") - F.unix_timestamp("first_event_ts")
    return out.withColumn("active_window_sec", window).withColumn(
        "tx_per_day", F.when(F.col("active_window_sec") > 0, F.col("tx_count") / (F.col("active_window_sec") / 86400.0)).otherwise(F.col("tx_count").cast("double"))
    )


def confusion(outcome: Column) -> list[Column]:
    """Counts of the four outcomes, then precision, recall, F1 and false-positive rate; 0 where a denominator is 0."""
    tp, fp, tn, fn = (F.count_if(outcome == o) for o in ("TRUE_POSITIVE", "FALSE_POSITIVE", "TRUE_NEGATIVE", "FALSE_NEGATIVE"))
    return [
        tp.alias("tp"), fp.alias("fp"), tn.alias("tn"), fn.alias("fn"),
        share(tp, tp + fp).alias("precision"), share(tp, tp + fn).alias("recall"), share(2 * tp, 2 * tp + fp + fn).alias("f1"), share(fp, fp + tn).alias("fpr"),
    ]


def pivot(df: DataFrame, keys: list[str], column: str, values: list[str], agg: Column) -> DataFrame:
    """Pivot over a given list of values: no pass over the data to find them."""
    return df.groupBy(*keys).pivot(column, values).agg(agg)


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: count, mean, sample deviation, minimum and maximum, in one pass."""
    stats = F.array(*[F.struct(F.lit(c).alias("column"), F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev(c).alias("stddev"), F.min(F.col(c).cast("double")).alias("least"), F.max(F.col(c).cast("double")).alias("most")) for c in columns])
    return df.agg(stats.alias("s")).select(F.inline("s"))


def histogram(df: DataFrame, key: Column, name: str = "bucket") -> DataFrame:
    return df.groupBy(key.alias(name)).agg(F.count("*").alias("n"))
