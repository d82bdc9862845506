"""The typology dashboard: inventory of cases against the period before, tasks and investigations, ages and times to disposition, cases of high value.

Alerts and payments are reduced to a row per case first, so nothing counts
twice where a case has several alerts: a case's value is that of its largest
payment.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import trend
from tidemark.operators.joins import left_join_known
from tidemark.plans.executive import AUTOMATIC, CONFIRMED, INCONCLUSIVE, REFUTED, pct
from tidemark.plans.metrics import closed

#: Changes of up to so many per cent are no trend.
FLAT = 5.0
Period = tuple[date, date]


def _in(ts: str, period: Period) -> Column:
    return F.to_date(ts).between(*[F.lit(d) for d in period])


def _done() -> Column:
    return F.coalesce(closed(F.col("status"), "like"), F.lit(False))


def per_case(alerts: DataFrame, payments: DataFrame) -> DataFrame:
    """What a case's alerts and their payments say of it: kinds of alerts, whether it closes by itself, the largest amount."""
    paid = payments.where("tx_msg_id is not null").groupBy("tx_msg_id").agg(F.max((F.col("tx_status") == "BLOCKED").cast("int")).alias("blocked"), F.max("tx_amount").alias("paid"))
    rows = left_join_known(alerts.where("case_id is not null").select("case_id", "tx_msg_id", "alert_type_norm", "prediction_outcome_norm"), paid, "tx_msg_id")
    kind, outcome = F.col("alert_type_norm"), F.col("prediction_outcome_norm")
    by_itself = (outcome == "FALSE_POSITIVE") | ((kind == "FRAUD") & (outcome == "TRUE_POSITIVE") & (F.col("blocked") == 1))
    any_ = lambda test, name: F.max(F.coalesce(test, F.lit(False)).cast("int")).alias(name)
    return rows.groupBy("case_id").agg(any_(kind == "AML", "aml"), any_(kind == "FRAUD", "fraud"), any_(kind == "FRAUD_AND_AML", "fraud_aml"), any_(by_itself, "auto_closed"), F.max("paid").alias("case_value"))


def case_inventory_periods(cases: DataFrame, alerts: DataFrame, payments: DataFrame, now: Period, before: Period) -> DataFrame:
    """One row: open cases and their kinds, inflow and outflow of both periods with their trends, automatic closure and reopening."""
    told = per_case(alerts, payments)
    rows = cases.join(told, "case_id", "left")
    automatic, reopened, auto = F.col("case_creation_type") == AUTOMATIC, F.col("has_parent_case") == 1, F.col("auto_closed") == 1
    flow = {}
    for suffix, period in (("", now), ("_before", before)):
        created, updated = _in("case_created_ts", period), _in("case_updated_ts", period)
        flow |= {f"cases_from_alerts{suffix}": automatic & created, f"manual_cases{suffix}": ~automatic & created, f"cases_closed{suffix}": _done() & updated}
    counts = {"total_open_cases": ~_done(), "aml_cases": F.col("aml") == 1, "fraud_cases": F.col("fraud") == 1, "fraud_aml_cases": F.col("fraud_aml") == 1, **flow, "auto_closed_cases": auto & _in("case_updated_ts", now), "auto_reopened": auto & reopened, "reopened": reopened, "closed": _done()}
    out = rows.agg(*[F.count_if(test).alias(name) for name, test in counts.items()])
    # one row each: cases that close by themselves may be unknown to the table of cases
    out = out.join(told.agg(F.count_if(F.col("auto_closed") == 1).alias("auto_total")).hint("broadcast"), F.lit(True))
    out = out.withColumns({"auto_closure_reopen_rate_pct": pct("auto_reopened", "auto_total"), "reopened_case_rate_pct": pct("reopened", "closed")})
    grown = lambda n: F.when((F.col(f"{n}_before") == 0) & (F.col(n) > 0), "up").otherwise(trend(F.col(n), F.col(f"{n}_before"), FLAT))
    out = out.withColumns({f"{n}_trend": grown(n) for n in ("cases_from_alerts", "manual_cases", "cases_closed")})
    return out.drop("auto_reopened", "reopened", "closed", "auto_total")


def task_inventory(tasks: DataFrame, cases: DataFrame, now: Period) -> DataFrame:
    """One row: open tasks, also per user who has some, and cases with tasks created or completed in the period."""
    is_open = F.col("is_completed") == 0
    users = tasks.where(is_open).groupBy("assigned_user_id").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("open_tasks"), F.count("*").alias("users"))
    worked = tasks.groupBy("case_id").agg(F.max(_in("task_created_ts", now).cast("int")).alias("created"), F.max((_in("task_completed_ts", now) & (F.col("is_completed") == 1)).cast("int")).alias("done"))
    flow = cases.select("case_id").distinct().join(worked, "case_id").agg(F.count_if(F.col("created") == 1).alias("investigations_created"), F.count_if(F.col("done") == 1).alias("investigations_closed"))
    return users.join(flow.hint("broadcast"), F.lit(True)).select("open_tasks", (F.col("open_tasks") / F.greatest("users", F.lit(1))).alias("avg_tasks_per_user"), "investigations_created", "investigations_closed")  # a row each


def task_counts(tasks: DataFrame) -> DataFrame:
    """Tasks by status, and open ones by group: ``frame, value, tasks``; both from one scan."""
    frames = F.array(F.struct(F.lit("status").alias("frame"), F.col("status").alias("value"), F.lit(True).alias("in")), F.struct(F.lit("open_by_group").alias("frame"), F.col("candidate_group").alias("value"), (F.col("is_completed") == 0).alias("in")))
    return tasks.select(F.inline(frames)).where("in").groupBy("frame", "value").agg(F.count("*").alias("tasks"))


AGES = ((7, "0-7 days (new)"), (14, "8-14 days (active)"), (30, "15-30 days (maturing)"), (60, "31-60 days (aged)"))


def timeliness(cases: DataFrame, alerts: DataFrame, today: date) -> DataFrame:
    """Open cases by age, and hours to disposition in all, by disposition and by kind of alert: ``frame, value, cases, avg_hours``."""
    days = F.date_diff(F.lit(today), F.to_date("case_created_ts"))
    age = F.coalesce(*[F.when(days <= most, name) for most, name in AGES], F.lit("60+ days (critical)"))
    took = F.when((F.col("created_to_updated_ms") > 0) & F.col("status").isin(REFUTED, CONFIRMED, INCONCLUSIVE), F.col("created_to_updated_ms"))
    frame = lambda name, value, test: F.struct(F.lit(name).alias("frame"), value.cast("string").alias("value"), F.coalesce(test, F.lit(False)).alias("in"), took.alias("took"))
    kinds = alerts.where("case_id is not null").groupBy("case_id").agg(F.collect_set("alert_type_norm").alias("kinds"))  # a few kinds of alerts
    rows = cases.join(kinds, "case_id", "left")
    single = F.array(frame("age", age, ~_done()), frame("all", F.lit("all"), took.isNotNull()), frame("disposition", F.col("status"), took.isNotNull()))
    of_kind = F.transform(F.when(F.coalesce(F.size("kinds"), F.lit(0)) > 0, F.col("kinds")).otherwise(F.array(F.lit(None).cast("string"))), lambda k: frame("alert_type", k, took.isNotNull()))
    out = rows.select(F.inline(F.concat(single, of_kind))).where("in").groupBy("frame", "value")
    return out.agg(F.count("*").alias("cases"), F.when(F.col("frame") != "age", F.avg("took") / 3_600_000).alias("avg_hours"))


def high_value_open(cases: DataFrame, alerts: DataFrame, payments: DataFrame, threshold: float = 10_000.0) -> tuple[DataFrame, DataFrame]:
    """Open cases from a value on: one row with their count, sum and mean; and the ten of highest value."""
    rows = cases.where(~_done()).join(per_case(alerts, payments).select("case_id", "case_value"), "case_id").where(F.col("case_value") >= threshold)
    summary = rows.agg(F.count("*").alias("high_value_count"), F.coalesce(F.sum("case_value"), F.lit(0.0)).alias("total_value_at_risk"), F.coalesce(F.avg("case_value"), F.lit(0.0)).alias("avg_value_per_case"))
    return summary, rows.select("case_id", "case_value", "status", "case_created_ts").orderBy(F.desc("case_value"), "case_id").limit(10)
