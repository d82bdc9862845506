"""Window operators; every ordering ends in a tie-breaker, so results don't depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order (Spark limits rows per group before the shuffle too)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def recency(df: DataFrame, keys: list[str], order: list[Column], name: str = "recent_rank_desc") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def running(df: DataFrame, keys: list[str], order: list[Column], value: str, where: Column | None = None, slice_: Column | None = None) -> DataFrame:
    """``cum_tx_count`` and ``cum_tx_amount`` up to each row, over rows that ``where`` admits.

    With ``slice_``, such as the day of the first order column, keys with very many rows are summed slice by slice.
    """
    test = F.lit(True) if where is None else where
    sums = {"cum_tx_count": F.when(test, 1).otherwise(0), "cum_tx_amount": F.when(test, F.coalesce(value, F.lit(0.0))).otherwise(0.0)}

    def cold(df):
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({n: F.sum(v).over(w) for n, v in sums.items()})

    def hot(df):
        return running_in_slices(df.withColumn("_slice", slice_), keys, "_slice", order, sums).drop("_slice")

    return cold(df) if slice_ is None else by_heat(df, keys, cold, hot)


def share_of_total(df: DataFrame, value: str, name: str = "share", keys: list[str] | None = None) -> DataFrame:
    """Share of the sum over all rows, or over the keys. Meant for aggregated rows."""
    return df.withColumn(name, F.col(value) / F.sum(value).over(Window.partitionBy(*(keys or []))))


def period_change(df: DataFrame, period: str, values: list[str], keys: list[str] | None = None) -> DataFrame:
    """``prev_x`` and ``x_change_pct`` by period; 0 where there is no period before. Meant for aggregated rows."""
    w = Window.partitionBy(*(keys or [])).orderBy(period)
    before = {f"prev_{v}": F.lag(v).over(w) for v in values}
    df = df.withColumns(before)
    return df.withColumns({f"{v}_change_pct": F.when(F.coalesce(F.col(f"prev_{v}"), F.lit(0)) == 0, 0.0).otherwise((F.col(v) - F.col(f"prev_{v}")) / F.col(f"prev_{v}") * 100) for v in values})


def trailing_count(df: DataFrame, keys: list[str], ts: str, millis: int, name: str) -> DataFrame:
    """Rows of the key within so many milliseconds up to each row, itself and its peers included."""

    def cold(df):
        w = Window.partitionBy(*keys).orderBy(F.unix_millis(ts)).rangeBetween(-millis, 0)
        return df.withColumn(name, F.count("*").over(w))

    def hot(df):
        # slices as long as the window: a row's window ends in its own slice and begins there or in the one before, whose rows come along
        copies = F.array(F.struct(F.floor(F.unix_millis(ts) / (millis + 1)).alias("_slice"), F.lit(1).alias("_own")), F.struct((F.floor(F.unix_millis(ts) / (millis + 1)) + 1).alias("_slice"), F.lit(0).alias("_own")))
        w = Window.partitionBy(*keys, "_slice").orderBy(F.unix_millis(ts)).rangeBetween(-millis, 0)
        return df.select("*", F.inline(copies)).withColumn(name, F.count("*").over(w)).where("_own = 1").drop("_slice", "_own")

    return by_heat(df, keys, cold, hot)


def most_recent(df: DataFrame, candidates: list[str], k: int, tie: list[str]) -> DataFrame:
    """The ``k`` latest rows by the first of the candidate columns that there is; without one, the first by ``tie``."""
    found = [F.desc_nulls_last(c) for c in candidates if c in df.columns][:1]
    return df.orderBy(*found, *tie).limit(k)


# ------------------------------------------------------------------ keys with much of the table

#: Rows of a key above which its history is cut into slices of time.
HOT_ROWS = 1_000_000


def running_in_slices(df: DataFrame, keys: list[str], slice_: str, order: list[Column], sums: dict[str, Column], peers: bool = False) -> DataFrame:
    """Running sums over the keys, where no task holds more than a slice of a key.

    ``slice_`` must not fall along ``order``. Sums of slices are taken before the
    shuffle; those of the slices before a row's are carried to it, and a window
    inside the slice does the rest. With ``peers`` rows of equal order count in (one order column then).
    """
    on = [*keys, slice_]
    df = df.withColumns({f"_v_{n}": v for n, v in sums.items()})
    totals = df.groupBy(*on).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    before = Window.partitionBy(*keys).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)  # a row per slice
    carried = totals.select(*[F.col(c).alias(f"_c_{c}") for c in on], *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in sums])
    w = Window.partitionBy(*on).orderBy(*order)
    w = w.rangeBetween(Window.unboundedPreceding, Window.currentRow) if peers else w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = df.withColumns({n: F.sum(f"_v_{n}").over(w) for n in sums})
    out = inside.join(carried, [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in on])
    out = out.withColumns({n: F.col(n) + F.col(f"_b_{n}") for n in sums})
    return out.drop(*[f"_v_{n}" for n in sums], *[f"_b_{n}" for n in sums], *[f"_c_{c}" for c in on])


def by_heat(df: DataFrame, keys: list[str], cold, hot, limit: int | None = None) -> DataFrame:
    """``cold(df)``, but ``hot`` of the rows whose key has more than ``limit`` rows; a pass over the keys alone tells them apart."""
    limit = HOT_ROWS if limit is None else limit
    large = df.groupBy(*[F.col(k).alias(f"_h_{k}") for k in keys]).agg(F.count("*").alias("_n")).where(F.col("_n") > limit).drop("_n")
    if not large.limit(1).count():
        return cold(df)
    on = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys]
    return cold(df.join(large, on, "left_anti")).unionByName(hot(df.join(large, on, "left_semi")))
