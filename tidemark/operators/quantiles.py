"""Exact discrete quantiles of groups of any size: a quantile is a value of the group, the least with enough rows up to it.

Rows are counted by value before the shuffle, and the counts are summed along
the values, slice by slice where a group may hold much of the table. No task
holds a group's rows.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import running_in_slices

#: Rank error, as a share of the rows, of the bounds between slices; it makes slices uneven, results stay exact.
BOUNDS_ACCURACY = 1000


def place(p: float, n: Column) -> Column:
    """The place, from 1, of a quantile among ``n`` ordered rows, in whole numbers: ``p * n`` as doubles may miss it by one."""
    part = Fraction(str(p))
    up = n * part.numerator + (part.denominator - 1)
    return F.greatest(F.lit(1), ((up - up % part.denominator) / part.denominator).cast("long"))


def bounds(df: DataFrame, columns: list[str], slices: int) -> dict[str, list[float]]:
    """Up to ``slices - 1`` values of each column that cut it into slices of about as many rows; one pass."""
    parts = [k / slices for k in range(1, slices)]
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), parts, BOUNDS_ACCURACY).alias(f"_b_{i}") for i, c in enumerate(columns)]).first()
    return {c: sorted(set(found[f"_b_{i}"] or [])) for i, c in enumerate(columns)}


def discrete_quantiles(df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float], slice_: Callable[[Column], Column] | None = None) -> DataFrame:
    """Keys and the named quantiles of the non-null values; groups without values are left out.

    ``slice_`` makes a slice of a value (and the keys) and must not fall along the values; it cuts groups with very many different ones.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    if slice_ is None:
        upto = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = counts.withColumn("_upto", F.sum("_n").over(upto))
    else:
        ranked = running_in_slices(counts.withColumn("_slice", slice_(F.col("_v"))), keys, "_slice", [F.asc("_v")], {"_upto": F.col("_n")})
    sizes = counts.groupBy(*[F.col(k).alias(f"_q_{k}") for k in keys]).agg(F.sum("_n").alias("_all"))
    ranked = ranked.join(sizes, [F.col(k).eqNullSafe(F.col(f"_q_{k}")) for k in keys] or F.lit(True))
    least = [F.min(F.when(F.col("_upto") >= place(p, F.col("_all")), F.col("_v"))).alias(name) for name, p in quantiles.items()]
    return ranked.groupBy(*keys).agg(*least)
