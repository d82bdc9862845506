"""The typology dashboard over the star tables, each with the same query in SQL; roles as in the executive queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.plans import typologies
from tidemark.plans.executive_queries import BEFORE, NOW, STAR, alerts, cases, payments, rate, tasks
from tidemark.plans.queries import query, r8

_DONE = "(status LIKE '%CLOSED%' OR status LIKE '%COMPLETE%' OR status LIKE '%DISPOSED%')"
_PER_CASE = """, k AS (SELECT case_id, bool_or(alert_type_norm = 'AML') AS aml, bool_or(alert_type_norm = 'FRAUD') AS fraud, bool_or(alert_type_norm = 'FRAUD_AND_AML') AS mixed,
      bool_or(prediction_outcome_norm = 'FALSE_POSITIVE' OR (alert_type_norm = 'FRAUD' AND prediction_outcome_norm = 'TRUE_POSITIVE' AND payments.tx_status = 'BLOCKED')) AS auto, max(payments.tx_amount) AS v FROM alerts LEFT JOIN payments USING (tx_msg_id) GROUP BY 1)"""
_AT = {"": "year({0}) = 1997", "_before": "year({0}) = 1996"}
_FLOW = ", ".join(
    f"count(*) FILTER (case_creation_type = 'AUTOMATIC_SYSTEM' AND {t.format('case_created_ts')}) AS cases_from_alerts{s}, count(*) FILTER (case_creation_type <> 'AUTOMATIC_SYSTEM' AND {t.format('case_created_ts')}) AS manual_cases{s}, count(*) FILTER ({_DONE} AND {t.format('case_updated_ts')}) AS cases_closed{s}"
    for s, t in _AT.items()
)
_TREND = ", ".join(f"CASE WHEN {n}_before = 0 THEN CASE WHEN {n} > 0 THEN 'up' ELSE 'flat' END WHEN ({n} - {n}_before) / {n}_before * 100 > 5 THEN 'up' WHEN ({n} - {n}_before) / {n}_before * 100 < -5 THEN 'down' ELSE 'flat' END AS {n}_trend" for n in ("cases_from_alerts", "manual_cases", "cases_closed"))


@query(
    f"""{STAR}{_PER_CASE}, c AS (SELECT count(*) FILTER (NOT {_DONE}) AS total_open_cases, count(*) FILTER (aml) AS aml_cases, count(*) FILTER (fraud) AS fraud_cases, count(*) FILTER (mixed) AS fraud_aml_cases, {_FLOW}, count(*) FILTER (auto AND year(case_updated_ts) = 1997) AS auto_closed_cases,
      count(*) FILTER (auto AND has_parent_case = 1) AS ar, count(*) FILTER (has_parent_case = 1) AS re, count(*) FILTER ({_DONE}) AS cl FROM cases LEFT JOIN k USING (case_id)), n AS (SELECT count(*) FILTER (auto) AS au FROM k)
    SELECT c.* EXCLUDE (ar, re, cl), {rate('ar', 'au', 'auto_closure_reopen_rate_pct')}, {rate('re', 'cl', 'reopened_case_rate_pct')}, {_TREND} FROM c, n"""
)
def met_21_inventory(spark, d):
    out = typologies.case_inventory_periods(cases(spark, d), alerts(spark, d), payments(spark, d), NOW, BEFORE)
    return out.withColumns({c: r8(c) for c in out.columns if c.endswith("_pct")})


@query(
    f"""{STAR} SELECT (SELECT count(*) FROM tasks WHERE is_completed = 0) AS open_tasks, round((SELECT count(*) / count(DISTINCT assigned_user_id) FROM tasks WHERE is_completed = 0), 8) AS avg_tasks_per_user,
    (SELECT count(DISTINCT case_id) FROM tasks JOIN cases USING (case_id) WHERE year(task_created_ts) = 1997) AS investigations_created, (SELECT count(DISTINCT case_id) FROM tasks JOIN cases USING (case_id) WHERE is_completed = 1 AND year(task_created_ts + INTERVAL 5 DAY) = 1997) AS investigations_closed"""
)
def met_21_tasks(spark, d):
    rows = tasks(spark, d).withColumn("task_completed_ts", F.col("task_created_ts") + F.expr("INTERVAL 5 DAY"))
    return typologies.task_inventory(rows, cases(spark, d), NOW).withColumn("avg_tasks_per_user", r8("avg_tasks_per_user"))


@query(f"{STAR} SELECT 'status' AS frame, status AS value, count(*) AS tasks FROM tasks GROUP BY 2 UNION ALL SELECT 'open_by_group', candidate_group, count(*) FROM tasks WHERE is_completed = 0 GROUP BY 2")
def met_21_task_counts(spark, d):
    return typologies.task_counts(tasks(spark, d))


_TOOK = "created_to_updated_ms > 0 AND status IN ('STATUS_81_CLOSED_REFUTED', 'STATUS_82_CLOSED_CONFIRMED', 'STATUS_83_CLOSED_INCONCLUSIVE')"


@query(
    f"""{STAR}, a AS (SELECT CASE WHEN d <= 7 THEN '0-7 days (new)' WHEN d <= 14 THEN '8-14 days (active)' WHEN d <= 30 THEN '15-30 days (maturing)' WHEN d <= 60 THEN '31-60 days (aged)' ELSE '60+ days (critical)' END AS value
      FROM (SELECT date_diff('day', CAST(case_created_ts AS DATE), DATE '1999-06-30') AS d FROM cases WHERE NOT {_DONE})), t AS (SELECT * FROM cases WHERE {_TOOK}), k AS (SELECT DISTINCT case_id, alert_type_norm FROM alerts)
    SELECT 'age' AS frame, value, count(*) AS cases, NULL::DOUBLE AS avg_hours FROM a GROUP BY 2 UNION ALL SELECT 'all', 'all', count(*), round(avg(created_to_updated_ms) / 3600000, 8) FROM t HAVING count(*) > 0
    UNION ALL SELECT 'disposition', status, count(*), round(avg(created_to_updated_ms) / 3600000, 8) FROM t GROUP BY 2 UNION ALL SELECT 'alert_type', alert_type_norm, count(*), round(avg(created_to_updated_ms) / 3600000, 8) FROM t LEFT JOIN k USING (case_id) GROUP BY 2"""
)
def met_21_timeliness(spark, d):
    return typologies.timeliness(cases(spark, d), alerts(spark, d), date(1999, 6, 30)).withColumn("avg_hours", r8("avg_hours"))


@query(f"{STAR}{_PER_CASE}, h AS (SELECT v FROM cases JOIN k USING (case_id) WHERE NOT {_DONE} AND v >= 10000) SELECT count(*) AS high_value_count, round(coalesce(sum(v), 0), 2) AS total_value_at_risk, round(coalesce(avg(v), 0), 4) AS avg_value_per_case FROM h")
def met_21_high_value(spark, d):
    summary, _ = typologies.high_value_open(cases(spark, d), alerts(spark, d), payments(spark, d))
    return summary.select("high_value_count", F.round("total_value_at_risk", 2).alias("total_value_at_risk"), F.round("avg_value_per_case", 4).alias("avg_value_per_case"))


@query(f"{STAR}{_PER_CASE} SELECT case_id, v AS case_value, status, strftime(case_created_ts, '%Y-%m-%d') AS created FROM cases JOIN k USING (case_id) WHERE NOT {_DONE} AND v >= 10000 ORDER BY v DESC, case_id LIMIT 10")
def met_21_top_cases(spark, d):
    _, top = typologies.high_value_open(cases(spark, d), alerts(spark, d), payments(spark, d))
    return top.select("case_id", "case_value", "status", F.date_format("case_created_ts", "yyyy-MM-dd").alias("created"))
