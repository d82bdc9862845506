"""Case tracking: open cases by state and category, inflow and outflow of a period with reopening, dispositions, and the lists behind the figures.

A case counts once however many rows and alerts it has. Alerts are reduced to
a category per case by one aggregate; all counts of a frame come from one scan.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import in_date_range
from tidemark.operators.aggregates import share
from tidemark.plans.executive import AUTOMATIC
from tidemark.plans.metrics import case_categories, closed

# States that a case closes in without a person, in which it is being reopened, and what a final state says.
AUTO_CLOSED = ("STATUS_71_AUTOCLOSED_CONFIRMED", "STATUS_72_AUTOCLOSED_REFUTED")
REOPENING = ("STATUS_31_PENDING_CASE_REOPENING_APPROVAL",)
DISPOSITIONS = {
    "STATUS_71_AUTOCLOSED_CONFIRMED": "CONFIRMED", "STATUS_82_CLOSED_CONFIRMED": "CONFIRMED", "STATUS_72_AUTOCLOSED_REFUTED": "REFUTED", "STATUS_81_CLOSED_REFUTED": "REFUTED", "STATUS_83_CLOSED_INCONCLUSIVE": "INCONCLUSIVE", "STATUS_99_ABANDONED": "ABANDONED",
}


def _done() -> Column:
    return F.coalesce(closed(F.col("status")), F.lit(False))


def _within(ts: str, start: date, end: date) -> Column:
    return F.coalesce(F.to_date(ts).between(F.lit(start), F.lit(end)), F.lit(False))


def with_category(cases: DataFrame, alerts: DataFrame) -> DataFrame:
    """Cases with ``case_category``, UNKNOWN without alerts."""
    kinds = case_categories(alerts.withColumn("alert_type_norm", F.upper("alert_type_norm")))
    return cases.join(kinds.withColumnRenamed("category", "case_category"), "case_id", "left").withColumn("case_category", F.coalesce("case_category", F.lit("UNKNOWN")))


def case_counts(cases: DataFrame, alerts: DataFrame, start: date, end: date) -> DataFrame:
    """``frame, value, cases``: open ones by ``status`` and ``category``, those closed in the period by ``disposition``, and the share of each in its frame in per cent."""
    said = F.coalesce(*[F.when(F.col("status") == s, d) for s, d in DISPOSITIONS.items()], F.lit("UNKNOWN"))
    frame = lambda name, value, test: F.struct(F.lit(name).alias("frame"), value.alias("value"), test.alias("in"))
    ended = _done() & _within("case_updated_ts", start, end)
    rows = with_category(cases, alerts).select("case_id", F.inline(F.array(frame("status", F.col("status"), ~_done()), frame("category", F.col("case_category"), ~_done()), frame("disposition", said, ended))))
    counted = rows.where("in").groupBy("frame", "value", "case_id").agg(F.lit(1).alias("one")).groupBy("frame", "value").agg(F.count("*").alias("cases"))
    totals = counted.groupBy("frame").agg(F.sum("cases").alias("all"))
    return counted.join(totals, "frame").select("frame", "value", "cases", (F.col("cases") / F.col("all") * 100).alias("pct"))


def case_flow(cases: DataFrame, alerts: DataFrame, start: date, end: date) -> DataFrame:
    """One row: cases with an alert of the period, cases made by hand in it, cases closed in it, by themselves and in all, and the shares of these that are being reopened."""
    per_case = cases.groupBy("case_id").agg(
        F.max((F.coalesce(F.col("case_creation_type") != AUTOMATIC, F.lit(False)) & _within("case_created_ts", start, end)).cast("int")).alias("manual"), F.max((_done() & _within("case_updated_ts", start, end)).cast("int")).alias("ended"),
        F.max((F.col("status").isin(*AUTO_CLOSED) & _within("case_updated_ts", start, end)).cast("int")).alias("auto"), F.max(F.col("status").isin(*REOPENING).cast("int")).alias("reopened"),
    )
    one = lambda *names: F.count_if(sum((F.coalesce(F.col(n), F.lit(0)) for n in names), F.lit(0)) == len(names))
    out = per_case.agg(one("manual").alias("manual_cases"), one("auto").alias("auto_closed_cases"), one("auto", "reopened").alias("auto_closed_reopened"), one("ended").alias("closed_cases"), one("ended", "reopened").alias("closed_reopened"))
    inflow = in_date_range(alerts.where("case_id is not null"), "created_at_ts", start, end).select("case_id").distinct().agg(F.count("*").alias("cases_from_alerts"))
    out = out.join(inflow.hint("broadcast"), F.lit(True))  # a row each
    return out.withColumns({"auto_closure_reopen_rate": share(F.col("auto_closed_reopened"), F.col("auto_closed_cases")), "reopened_case_rate": share(F.col("closed_reopened"), F.col("closed_cases"))})


def case_lists(cases: DataFrame, alerts: DataFrame, start: date, end: date) -> DataFrame:
    """The cases behind the figures, a row for each list a case is on: ``list, case_id, status, case_category, case_creation_type, case_created_ts, case_updated_ts``."""
    on = {"open": ~_done(), "new": _within("case_created_ts", start, end), "closed": _done() & _within("case_updated_ts", start, end), "reopened": F.col("status").isin(*REOPENING)}
    lists = F.filter(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in on.items()]), lambda x: x.isNotNull())
    rows = with_category(cases, alerts).withColumn("list", F.explode(lists))
    return rows.select("list", "case_id", "status", "case_category", "case_creation_type", "case_created_ts", "case_updated_ts").distinct()


def case_periods(cases: DataFrame, alerts: DataFrame, now: tuple[date, date], before: tuple[date, date]) -> DataFrame:
    """A row per period, ``current`` and ``previous``: cases created in it by origin, by kind of their alerts of the same period, closed, automatically closed and reopened ones, and the owners' mean closure rate.

    Rates are in per cent, an owner's rounded to two places before the mean; 0 without a closed case or an owner.
    """
    label = lambda ts: F.when(_within(ts, *now), "current").when(_within(ts, *before), "previous")
    kind = F.upper("alert_type_norm")
    said = alerts.where("case_id is not null").select("case_id", label("created_at_ts").alias("period"), kind.alias("kind")).where("period is not null")
    any_ = lambda test, name: F.max(F.coalesce(test, F.lit(False)).cast("int")).alias(name)
    said = said.groupBy("case_id", "period").agg(any_(F.col("kind").isin("AML", "FRAUD_AND_AML"), "aml"), any_(F.col("kind").isin("FRAUD", "FRAUD_AND_AML"), "fraud"), any_(F.col("kind") == "FRAUD_AND_AML", "mixed"))
    rows = cases.withColumn("period", label("case_created_ts")).where("period is not null").join(said, ["case_id", "period"], "left")
    done, status, automatic = F.coalesce(closed(F.col("status"), "like"), F.lit(False)), F.upper("status"), F.col("case_creation_type") == AUTOMATIC
    counts = {
        "cases_from_alerts": automatic, "manual_cases": ~automatic, "aml_cases": F.col("aml") == 1, "fraud_cases": F.col("fraud") == 1, "fraud_aml_cases": F.col("mixed") == 1, "auto_closed_cases": status.like("%AUTO%CLOSED%"), "closed_cases": done, "reopened_cases": F.col("has_parent_case") == 1,
    }
    out = rows.groupBy("period").agg(*[F.count_if(test).alias(n) for n, test in counts.items()])
    owners = rows.where("case_owner_user_id is not null").groupBy("period", "case_owner_user_id").agg(F.round(F.count_if(done) / F.count("*") * 100, 2).alias("rate"))
    out = out.join(owners.groupBy("period").agg(F.avg("rate").alias("avg_closure_rate_pct")), "period", "left")
    return out.withColumns({"avg_closure_rate_pct": F.coalesce("avg_closure_rate_pct", F.lit(0.0)), "reopened_rate_pct": share(F.col("reopened_cases"), F.col("closed_cases")) * 100})


def disposition_times(cases: DataFrame, alerts: DataFrame, start: date, end: date, by: tuple[str, ...] = ("case_type", "status")) -> DataFrame:
    """Hours: from creation to end of cases closed in the period (frame ``closed``), and from an alert of the period to its case's last change, by columns of cases: ``frame, value, cases, avg_hours``.

    Alerts are reduced to their number and mean time per case before the join, so an alert counts once and no case is repeated.
    """
    ended = cases.where(F.coalesce(closed(F.col("status"), "contains"), F.lit(False)) & _within("case_updated_ts", start, end))
    whole = ended.agg(F.lit("closed").alias("frame"), F.lit("all").alias("value"), F.count("*").alias("cases"), (F.avg("created_to_updated_ms") / 3_600_000).alias("avg_hours"))
    told = in_date_range(alerts.where("case_id is not null"), "created_at_ts", start, end).groupBy("case_id").agg(F.count("*").alias("alerts"), F.sum(F.unix_timestamp("created_at_ts")).alias("at"))
    rows = told.join(cases.select("case_id", "case_updated_ts", *by), "case_id", "left")
    # the sum of the times from each alert to the case's last change
    hours = (F.unix_timestamp("case_updated_ts") * F.col("alerts") - F.col("at")) / 3600
    frames = F.array(*[F.struct(F.lit(c).alias("frame"), F.col(c).cast("string").alias("value")) for c in by])
    timed = rows.select(F.inline(frames), hours.alias("hours"), F.when(F.col("case_updated_ts").isNotNull(), F.col("alerts")).alias("n")).groupBy("frame", "value")
    return whole.unionByName(timed.agg(F.count("*").alias("cases"), F.try_divide(F.sum("hours"), F.sum("n")).alias("avg_hours")))
