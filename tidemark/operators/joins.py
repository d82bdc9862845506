"""Joins with more to them than a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import latest_per_key


def enrich(df: DataFrame, other: DataFrame, keys: list[str], columns: list[str], order: list[Column], prefix: str = "") -> DataFrame:
    """Left join to the latest row per key of ``other``; the join can't multiply rows."""
    right = latest_per_key(other.select(*keys, *[c for c in columns if c not in keys], *[]), keys, order) if order else other.select(*keys, *columns).dropDuplicates(keys)
    right = right.select(*keys, *[F.col(c).alias(prefix + c) for c in columns])
    return df.join(right, keys, "left")


#: Parts among which a join deals rows without a key.
NULL_PARTS = 4096


def left_join_known(df: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on a key that much of ``df`` may lack: rows without it match nothing and are dealt among tasks, where a plain join sends them all to one."""
    apart = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(NULL_PARTS)) + 1).otherwise(0)
    # always 0, but no literal: that would be folded into a filter, and rows be dealt by the key alone
    other = right.where(F.col(key).isNotNull()).withColumn("_apart", F.pmod(F.xxhash64(key), F.lit(1)))
    return df.withColumn("_apart", apart.cast("long")).join(other, [key, "_apart"], "left").drop("_apart")


#: Rows of a large table that a task should get of a shuffle.
TASK_ROWS = 500_000


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by the keys among enough tasks for ``rows`` rows, if the session's shuffle partitions are too few for them."""
    tasks = -(-rows // TASK_ROWS)
    return df if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(tasks, *keys)


def flag_by_key(df: DataFrame, other: DataFrame, keys: list[str], flag: Column, name: str) -> DataFrame:
    """Left join to the maximum of a flag per key; 0 without a match."""
    flags = other.groupBy(*keys).agg(F.max(flag.cast("int")).alias(name))
    return df.join(flags, keys, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def best_match(df: DataFrame, config: DataFrame, on: list[str], tenant: str, row_key: list[str], order: list[Column], default: str = "DEFAULT", keep: list[str] | None = None) -> DataFrame:
    """Left join on keys to the row of the same tenant or, failing that, of the default one.

    An equi-join with the choice of tenant as residual; the best row per
    ``row_key`` is then kept (0 exact, 1 default, 2 none), ties by ``order``.
    Keys should have the types of ``config``'s. ``df`` is read twice: keys with
    more rows than a task should get are dealt among tasks by ``row_key``, and
    their few rows of ``config`` sent to each; the tasks grow in number with ``df``.
    """
    as_text = lambda prefix: F.to_json(F.struct(*[F.col(prefix + c).cast("string").alias(f"k{i}") for i, c in enumerate(on)]))
    sizes = df.groupBy(as_text("").alias("_h")).agg(F.count("*").alias("_n"))
    # at most eight rows for each task, and one with the sum of the other keys; eight places a task, so that tasks are alike
    most = max(1, TASK_ROWS // 8)
    found = sizes.groupBy(F.when(F.col("_n") > most, F.col("_h")).alias("_h")).agg(F.sum("_n").alias("_n")).collect()
    rows = sum(r["_n"] for r in found)
    hot = F.broadcast(df.sparkSession.createDataFrame([(r["_h"], -(-r["_n"] // most)) for r in found if r["_h"] is not None], "_h string, _parts long"))
    # one column as text, so that no key that is constant drops out of the join and has it shuffle again
    place = lambda part: F.concat_ws("/", part.cast("string"), "_h")
    parts = F.coalesce("_parts", F.lit(1))
    left = df.withColumn("_h", as_text("")).join(hot, "_h", "left").withColumn("_place", place(F.pmod(F.xxhash64(*row_key), parts))).drop("_h", "_parts")
    right = config.select(*[F.col(c).alias(f"_c_{c}") for c in config.columns]).where(" and ".join(f"`_c_{c}` is not null" for c in on))
    right = right.withColumn("_h", as_text("_c_")).join(hot, "_h", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).withColumn("_c_place", place(F.col("_part"))).drop("_h", "_parts", "_part")
    left, right = spread(left, rows, "_place"), spread(right, rows, "_c_place")
    either = (F.col(tenant) == F.col(f"_c_{tenant}")) | (F.col(f"_c_{tenant}") == default)
    rank = F.when(F.col(f"_c_{tenant}") == F.col(tenant), 0).when(F.col(f"_c_{tenant}") == default, 1).otherwise(2)
    joined = left.join(right, [F.col("_place") == F.col("_c_place"), either], "left").withColumn("match_rank", rank)
    # where row_key has the keys, it tells the place, which is named so that the rows stay in their tasks
    within = [*row_key, "_place"] if set(on) <= set(row_key) else row_key
    joined = joined if within != row_key else spread(joined, rows, *row_key)
    best = joined.withColumn("_rn", F.row_number().over(Window.partitionBy(*within).orderBy("match_rank", *order))).where("_rn = 1")
    kept = keep if keep is not None else [c for c in config.columns if c not in (*on, tenant)]
    return best.select(*df.columns, "match_rank", *[F.col(f"_c_{c}").alias(c) for c in kept])


def bridge(df: DataFrame, middle: DataFrame, end: DataFrame, first_key: str, second_key: str) -> DataFrame:
    """Two left joins, ``df -> middle`` by the first key and on to ``end`` by the second; both sides one row per key."""
    return df.join(middle, first_key, "left").join(end, second_key, "left")


def either_key(df: DataFrame, other: DataFrame, first: tuple[str, str], second: tuple[str, str], columns: list[str]) -> DataFrame:
    """Left join on ``first`` or, where that has no match, on ``second``: two equi-joins instead of a nested loop.

    The keys of ``other`` should be unique; a row takes the match of the first
    key if there is one.
    """
    a = other.where(F.col(first[1]).isNotNull()).select(F.col(first[1]).alias("_k1"), F.struct(*columns).alias("_m1")).dropDuplicates(["_k1"])
    b = other.where(F.col(second[1]).isNotNull()).select(F.col(second[1]).alias("_k2"), F.struct(*columns).alias("_m2")).dropDuplicates(["_k2"])
    out = left_join_known(df, a.withColumnRenamed("_k1", first[0]), first[0])
    out = left_join_known(out, b.withColumnRenamed("_k2", second[0]), second[0]).withColumn("_m", F.coalesce("_m1", "_m2"))
    return out.select(*df.columns, *[F.col(f"_m.{c}").alias(c) for c in columns])


#: Rows of either side that an interval join compares at once, and pairs that one of its tasks should compare.
BLOCK_ROWS, TASK_PAIRS = 2_000, 16_000_000


def interval_points(intervals: DataFrame, points: DataFrame, keys: list[str], start: str, end: str, ts: str, residual: Column | None = None, before: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Each pair of an interval ``[start, end]`` (open if ``end`` is null, and without what is not before ``before``, if that is not null) and a point in it that shares the keys, once; and the intervals that have one.

    Both are equi-joins: an interval is spread over the two to nine stretches of
    time that it covers, up to the last point of its keys, a stretch being as
    long as an eighth of the interval or less than eight times that. Intervals
    and points that meet in a stretch are dealt into blocks, and the blocks among
    tasks by the number of pairs, not by the size of what is shuffled.
    """
    micros = lambda c: F.unix_micros(F.col(c))
    points = points.withColumnsRenamed({k: f"_p_{k}" for k in keys}).where(F.col(ts).isNotNull())
    last = points.groupBy(*[f"_p_{k}" for k in keys]).agg(F.max(ts).alias("_last")).withColumnsRenamed({f"_p_{k}": f"_l_{k}" for k in keys})
    until = F.least(micros("_last"), micros(end), *([micros(before) - 1] if before else []))
    spread = intervals.join(last, [F.col(k) == F.col(f"_l_{k}") for k in keys]).withColumn("_until", until).where(micros(start) <= F.col("_until")).drop("_last", *[f"_l_{k}" for k in keys])
    # stretches of 8^n microseconds
    spread = spread.withColumn("_level", (3 * F.floor(F.log2(F.greatest(F.col("_until") - micros(start), F.lit(1 << 20))) / 3)).cast("int"))
    at = lambda c: F.expr(f"shiftright({c}, _level)")
    spread = spread.withColumn("_on", F.explode(F.sequence(at(f"unix_micros(`{start}`)"), at("_until")))).drop("_until")
    levels = [r[0] for r in spread.select("_level").distinct().collect()]  # at most 15
    if not levels:
        return spread.drop("_level", "_on").join(points.drop(*[f"_p_{k}" for k in keys]).limit(0)), intervals.limit(0)
    points = points.withColumn("_level", F.explode(F.array(*[F.lit(v) for v in levels]))).withColumn("_on", at(f"unix_micros(`{ts}`)"))
    stretch, own = [*keys, "_level", "_on"], [f"_p_{k}" for k in keys]
    blocks = lambda n: F.ceil(F.col(n) / BLOCK_ROWS).cast("int")
    many = spread.groupBy(*stretch).agg(F.count("*").alias("_many"))
    times = points.groupBy(*own, "_level", "_on").agg(F.count("*").alias("_times")).withColumnsRenamed(dict(zip(own, keys, strict=True)))
    sizes = many.join(times, stretch)
    pairs = sizes.agg(F.sum(F.col("_many") * F.col("_times"))).first()[0] or 0
    tasks = max(int(spread.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pairs // TASK_PAIRS))
    rows_of = lambda df, n: F.pmod(F.xxhash64(*df.columns), blocks(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    left = spread.join(sizes, stretch).withColumn("_a", rows_of(spread, "_many")).withColumn("_b", every("_times")).drop("_many", "_times")
    right = points.join(sizes.withColumnsRenamed(dict(zip(keys, own, strict=True))), [*own, "_level", "_on"])
    right = right.withColumn("_b", rows_of(points, "_times")).withColumn("_a", every("_many")).drop("_many", "_times")
    # one column as text, so that no key that is constant drops out of the join and has it shuffle again
    place = lambda names: F.to_json(F.struct(*[F.col(n).alias(f"k{i}") for i, n in enumerate([*names, "_level", "_on", "_a", "_b"])]))
    left = left.withColumn("_place", place(keys)).drop("_level", "_on", "_a", "_b").repartition(tasks, "_place")
    right = right.withColumn("_p_place", place(own)).drop("_level", "_on", "_a", "_b", *own).repartition(tasks, "_p_place").hint("merge")
    on = [F.col("_place") == F.col("_p_place"), F.col(ts) >= F.col(start), F.col(end).isNull() | (F.col(ts) <= F.col(end))]
    on += [F.col(before).isNull() | (F.col(ts) < F.col(before))] if before else []
    on += [residual] if residual is not None else []
    return left.join(right, on).drop("_place", "_p_place"), left.join(right, on, "left_semi").drop("_place")


def bucket_interval(intervals: DataFrame, points: DataFrame, keys: list[str], start: str, end: str, ts: str, how: str = "left", residual: Column | None = None) -> DataFrame:
    """Points within ``[start, end]`` (open if ``end`` is null) that share the keys, among them the time bucket."""
    right = points.withColumnsRenamed({k: f"_p_{k}" for k in keys})
    on = [F.col(k) == F.col(f"_p_{k}") for k in keys] + [F.col(ts) >= F.col(start), F.col(end).isNull() | (F.col(ts) <= F.col(end))]
    if residual is not None:
        on.append(residual)
    return intervals.join(right, on, how).drop(*[f"_p_{k}" for k in keys])
