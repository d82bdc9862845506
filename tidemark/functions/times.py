"""Time: normalising, bucketing and comparing periods."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAINS = ("hour", "day", "week", "month", "quarter", "year")
PERIODS = {"LAST_7_DAYS": 7, "LAST_30_DAYS": 30, "LAST_90_DAYS": 90, "YEAR": 365}
ALL_START = "1970-01-01 00:00:00"
ALL_END = "2999-12-31 00:00:00"


def with_timestamps(df: DataFrame) -> DataFrame:
    """Zone-less timestamp columns cast once to timestamps of the session's zone."""
    return df.withColumns({c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"})


def epoch_ms_to_ts(c: Column) -> Column:
    """Epoch milliseconds, as number or text, to a timestamp; null if unreadable."""
    return F.timestamp_millis(c.try_cast("double").cast("long"))


def iso_to_ts(c: Column) -> Column:
    """ISO-8601 text, with or without a trailing ``Z``, to a timestamp; null if unreadable."""
    return F.try_to_timestamp(F.regexp_replace(c, "Z$", ""))


def millis_between(start: Column, end: Column) -> Column:
    return F.unix_millis(end) - F.unix_millis(start)


def bucket(ts: Column, grain: str) -> Column:
    """Start of the period; weeks start on Monday; ``all`` is one period."""
    return F.lit(ALL_START).cast("timestamp") if grain == "all" else F.date_trunc(grain, ts)


def bucket_end(start: Column, grain: Column) -> Column:
    """First moment after the bucket."""
    step = lambda g, e: F.when(grain == g, start + F.expr(f"INTERVAL {e}"))
    return F.coalesce(step("hour", "1 HOUR"), step("day", "1 DAY"), step("week", "7 DAYS"), step("month", "1 MONTH"), step("quarter", "3 MONTHS"), step("year", "1 YEAR"), F.lit(ALL_END).cast("timestamp"))


def next_start(start: str, grain: str) -> Column:
    """Start of the bucket behind one, as the session's calendar has it; null for ``all``."""
    days = lambda g, e: F.when(F.col(grain) == g, F.expr(e.format(f"to_date(`{start}`)")).cast("timestamp"))
    hour = F.when(F.col(grain) == "hour", F.col(start) + F.expr("INTERVAL 1 HOUR"))
    return F.coalesce(hour, days("day", "date_add({}, 1)"), days("week", "date_add({}, 7)"), days("month", "add_months({}, 1)"), days("quarter", "add_months({}, 3)"), days("year", "add_months({}, 12)"))


def explode_grains(df: DataFrame, ts: str, grains=("day", "week", "month", "year")) -> DataFrame:
    """A row per granularity with ``bucket_granularity`` and ``bucket_start``: one scan in place of a union of scans."""
    spots = F.array(*[F.struct(F.lit(g).alias("bucket_granularity"), bucket(F.col(ts), g).alias("bucket_start")) for g in grains])
    return df.select("*", F.inline(spots))


def resolve_date_range(period: str, today: date, start: date | None = None, end: date | None = None) -> tuple[date | None, date | None]:
    """Explicit bounds win; ``ALL_HISTORY`` has none; the named periods are so many days up to today."""
    if start or end:
        return start, end
    if period == "ALL_HISTORY":
        return None, None
    if period not in PERIODS:
        raise ValueError(f"unknown period {period!r}")
    return today - timedelta(days=PERIODS[period]), today


def previous_range(start: date, end: date) -> tuple[date, date]:
    """The period of the same length that ends the day before ``start``."""
    return start - (end - start) - timedelta(days=1), start - timedelta(days=1)


def in_date_range(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Rows whose date lies within both bounds, inclusive; a missing bound is none. Compares timestamps, so files can be skipped."""
    c = F.col(ts)
    if start is not None:
        df = df.where(c >= F.lit(str(start)).cast("timestamp"))
    if end is not None:
        df = df.where(c < F.lit(str(end)).cast("timestamp") + F.expr("INTERVAL 1 DAY"))
    return df


def pct_change(now: Column, before: Column) -> Column:
    """Change in per cent, 0 where there is nothing before."""
    return F.when(before.isNull() | (before == 0), F.lit(0.0)).otherwise((now - before) / before * 100)


def trend(now: Column, before: Column, flat: float = 0.0) -> Column:
    change = pct_change(now, before)
    return F.when(change > flat, "up").when(change < -flat, "down").otherwise("flat")
