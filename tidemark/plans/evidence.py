"""Per-rule evidence in bulk: the independent variable of a rule for every row at once, by windows per account.

``df`` has an account column, ``ts`` and a tie-breaker; "up to now" includes
peers with the same timestamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import nested
from tidemark.operators.windows import by_heat, latest_per_key, running_in_slices, trailing_count


def _day(ms: Column) -> Column:
    return F.floor(ms / 86_400_000)


def lifetime_count(df: DataFrame, keys: list[str], ts: str, name: str = "lifetime_count") -> DataFrame:
    """Rows of the key up to each row's time in milliseconds, peers included (rules of pair and account history); very long histories day by day."""

    def cold(df):
        w = Window.partitionBy(*keys).orderBy(ts).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(name, F.count("*").over(w))

    def hot(df):
        return running_in_slices(df.withColumn("_slice", _day(F.col(ts))), keys, "_slice", [F.asc(ts)], {name: F.lit(1).cast("long")}, peers=True).drop("_slice")

    return by_heat(df, keys, cold, hot)


def recent_count(df: DataFrame, keys: list[str], ts: str, millis: int, name: str = "recent_count") -> DataFrame:
    return trailing_count(df, keys, ts, millis, name)


def gap_before(df: DataFrame, keys: list[str], ts: str, name: str = "gap_ms") -> DataFrame:
    """Milliseconds since the last activity strictly before; 0 if there is none. Very long histories go day by day."""
    ms = F.unix_millis(ts)

    def cold(df):
        w = Window.partitionBy(*keys).orderBy(ms).rangeBetween(Window.unboundedPreceding, -1)
        return df.withColumn(name, F.coalesce(ms - F.max(ms).over(w), F.lit(0)))

    def hot(df):
        # the last moment of the days before, a row a day; inside a day a window
        days = df.groupBy(*[F.col(k).alias(f"_d_{k}") for k in keys], _day(ms).alias("_d")).agg(F.max(ms).alias("_last"))
        before = Window.partitionBy(*[f"_d_{k}" for k in keys]).orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
        days = days.withColumn("_before", F.max("_last").over(before)).drop("_last")
        w = Window.partitionBy(*keys, "_slice").orderBy(ms).rangeBetween(Window.unboundedPreceding, -1)
        out = df.withColumn("_slice", _day(ms)).withColumn("_inside", F.max(ms).over(w))
        out = out.join(days, [*[F.col(k).eqNullSafe(F.col(f"_d_{k}")) for k in keys], F.col("_slice").eqNullSafe(F.col("_d"))])
        return out.withColumn(name, F.coalesce(ms - F.coalesce("_inside", "_before"), F.lit(0))).select(*df.columns, name)

    return by_heat(df, keys, cold, hot)


def gap_to_previous(df: DataFrame, keys: list[str], ts: str, tie: str, name: str = "previous_gap_ms") -> DataFrame:
    """Milliseconds between each row and the one before it in order; null for the first. Very long histories go day by day."""
    ms = F.unix_millis(ts)

    def cold(df):
        return df.withColumn(name, ms - F.lag(ms).over(Window.partitionBy(*keys).orderBy(ts, tie)))

    def hot(df):
        # the first row of a day is behind the last of the days before
        days = df.groupBy(*[F.col(k).alias(f"_d_{k}") for k in keys], _day(ms).alias("_d")).agg(F.max(ms).alias("_last"))
        before = Window.partitionBy(*[f"_d_{k}" for k in keys]).orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
        days = days.withColumn("_before", F.max("_last").over(before)).drop("_last")
        inside = F.lag(ms).over(Window.partitionBy(*keys, "_slice").orderBy(ts, tie))
        out = df.withColumn("_slice", _day(ms)).withColumn("_inside", inside)
        out = out.join(days, [*[F.col(k).eqNullSafe(F.col(f"_d_{k}")) for k in keys], F.col("_slice").eqNullSafe(F.col("_d"))])
        return out.withColumn(name, ms - F.coalesce("_inside", "_before")).select(*df.columns, name)

    return by_heat(df, keys, cold, hot)


def account_age(df: DataFrame, keys: list[str], ts: str, name: str = "age_ms") -> DataFrame:
    """Milliseconds since the key's first row: an aggregate before the shuffle, joined back."""
    first = df.groupBy(*[F.col(k).alias(f"_f_{k}") for k in keys]).agg(F.min(F.unix_millis(ts)).alias("_first"))
    return df.join(first.hint("merge"), [F.col(k).eqNullSafe(F.col(f"_f_{k}")) for k in keys]).withColumn(name, F.unix_millis(ts) - F.col("_first")).select(*df.columns, name)


def over_threshold(amount: Column, threshold: Column, fallback: float = 10_000.0) -> Column:
    return F.coalesce(amount, F.lit(0.0)) >= F.coalesce(threshold, F.lit(fallback))


def age_in_years(document: str | Column, path: str, at: Column) -> Column:
    """Whole years from a birth date in a JSON document; one born on 29 February is a year older on 1 March of other years."""
    born = F.try_to_timestamp(F.get_json_object(document, path)).cast("date")
    before = F.struct(F.month(at), F.dayofmonth(at)) < F.struct(F.month(born), F.dayofmonth(born))
    return (F.year(at) - F.year(born) - before.cast("int")).cast("int")


def accounts_per_party(df: DataFrame, party: str, account: str) -> DataFrame:
    return df.groupBy(party).agg(F.count_distinct(account).alias("accounts"))


def bands(rules: DataFrame) -> DataFrame:
    """A row per rule and band or exit condition of each rule's newest configuration."""
    kind = "array<struct<subRuleRef:string,reason:string,lowerLimit:double,upperLimit:double>>"
    latest = latest_per_key(rules, ["tenant_id", "rule_id", "rule_cfg"], [F.desc_nulls_last("rule_updated_ts"), F.desc("record_hash")])
    tagged = lambda c, what: F.transform(F.coalesce(F.from_json(c, kind), F.array().cast(kind)), lambda b: F.struct(F.lit(what).alias("kind"), b["subRuleRef"].alias("sub_rule_ref"), b["reason"].alias("reason"), b["lowerLimit"].alias("lower_limit"), b["upperLimit"].alias("upper_limit")))
    return latest.select("tenant_id", "rule_id", "rule_cfg", "max_query_range_ms", F.inline_outer(F.concat(tagged("bands_json", "BAND"), tagged("exit_conditions_json", "EXIT"))))


def merge_rules(results: Column, override: str = "EFRuP@1.0.0") -> dict[str, Column]:
    """Rules of all typologies with the largest weight of each, and the override rule apart."""
    flat = nested.flatten_present(F.transform(nested.present(results), lambda t: nested.present(t["ruleResults"])))
    ordered = F.array_sort(F.transform(F.filter(flat, lambda r: r["id"] != override), lambda r: F.struct((-F.coalesce(r["wght"], F.lit(0))).alias("w"), r["id"].alias("id"), r["subRuleRef"].alias("ref"))))
    return {"merged_rules": nested.first_per_key(ordered, "id", "array<struct<w:bigint,id:string,ref:string>>"), "override_rule": nested.first_where(flat, lambda r: r["id"] == override, lambda r: r["subRuleRef"])}
