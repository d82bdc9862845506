"""Quantiles and distinct counts that roll up: mergeable sketch states kept per fine bucket.

Exact percentiles and distinct counts of hours say nothing about those of a
day. The states here do: a KLL sketch of a value and an HLL sketch of a key,
both of bounded size, are made per bucket in one partial aggregate, can be
written as binary columns, and merge into any coarser bucket without the rows.

With ``k`` items a KLL sketch keeps buckets of up to about ``k`` values exactly; beyond that the
rank of what it returns is off by about ``rank_error(k)`` of the bucket's rows
(99 per cent confidence). An HLL sketch of ``2 ** lg`` registers has a relative
deviation of about ``1.04 / sqrt(2 ** lg)``, and counts small sets exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import bucket

#: Items of a KLL sketch and, as a power of two, registers of an HLL sketch.
K, LG = 2048, 14


def rank_error(k: int = K) -> float:
    """Normalised rank error of a KLL sketch, by the published fit of its single-sided error."""
    return 2.296 / k**0.9723


def states(df: DataFrame, keys: list[str], ts: str, grain: str, value: str, distinct: str | None = None, k: int = K, lg: int = LG) -> DataFrame:
    """Keys, ``bucket, n, total, low, high, quantiles`` and, with ``distinct``, ``uniques``, of each fine bucket. Null values count in none but ``uniques``."""
    v = F.col(value).cast("double")
    aggregates = [F.count(v).alias("n"), F.sum(v).alias("total"), F.min(v).alias("low"), F.max(v).alias("high"), F.kll_sketch_agg_double(v, F.lit(k)).alias("quantiles")]
    if distinct is not None:
        aggregates.append(F.hll_sketch_agg(F.col(distinct), F.lit(lg)).alias("uniques"))
    return df.groupBy(*keys, bucket(F.col(ts), grain).alias("bucket")).agg(*aggregates)


def merge(fine: DataFrame, keys: list[str], grain: str | None) -> DataFrame:
    """States of coarser buckets from those of finer ones; without ``grain`` one of all time per key."""
    by = [*keys, *([bucket(F.col("bucket"), grain).alias("bucket")] if grain else [])]
    aggregates = [F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("quantiles").alias("quantiles")]
    if "uniques" in fine.columns:
        aggregates.append(F.hll_union_agg("uniques").alias("uniques"))
    return fine.groupBy(*by).agg(*aggregates)


def quantile(p: float, state: str = "quantiles") -> Column:
    """A quantile of a state; null for one without values."""
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(state, F.lit(p)))


def read(merged: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """Figures of states: ``n, mean, low, high``, the named quantiles and ``distinct``."""
    figures = [F.try_divide("total", "n").alias("mean"), "low", "high", *[quantile(p).alias(name) for name, p in quantiles.items()]]
    if "uniques" in merged.columns:
        figures.append(F.hll_sketch_estimate("uniques").alias("distinct"))
    return merged.select(*[c for c in merged.columns if c not in ("total", "low", "high", "quantiles", "uniques")], *figures)


def rank_gap(df: DataFrame, merged: DataFrame, keys: list[str], ts: str, grain: str, value: str, name: str, p: float) -> DataFrame:
    """How far the true rank of a state's quantile is from ``p``, as a share of the bucket's rows: keys, ``bucket``, ``name``. One pass over the rows."""
    at = merged.select(*[F.col(k).alias(f"_m_{k}") for k in keys], F.col("bucket").alias("_bucket"), quantile(p).alias("_q"))
    rows = df.select(*keys, bucket(F.col(ts), grain).alias("bucket"), F.col(value).cast("double").alias("_v")).where("_v is not null")
    joined = rows.join(at, [F.col("bucket") == F.col("_bucket"), *[F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys]])
    below, upto = F.count_if(F.col("_v") < F.col("_q")) / F.count("*"), F.count_if(F.col("_v") <= F.col("_q")) / F.count("*")
    return joined.groupBy(*keys, "bucket").agg(F.greatest(F.lit(0.0), below - p, p - upto).alias(name))
