"""Case tracking and the supervisor's page over the star tables, each with the same query in SQL; roles as in the executive queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import case_tracking, executive
from tidemark.plans.executive_queries import BEFORE, CASES, END, NOW, STAR, START, alerts, cases, frame, tasks
from tidemark.plans.queries import query, r8

_FINAL = "('STATUS_71_AUTOCLOSED_CONFIRMED', 'STATUS_72_AUTOCLOSED_REFUTED', 'STATUS_81_CLOSED_REFUTED', 'STATUS_82_CLOSED_CONFIRMED', 'STATUS_83_CLOSED_INCONCLUSIVE', 'STATUS_99_ABANDONED')"
#: Cases as in the executive queries, but that urgent open ones of some customers have a second row, in which they are being reopened.
_ROWS = f"""{STAR}, k AS (SELECT case_id, max(CASE alert_type_norm WHEN 'FRAUD_AND_AML' THEN 3 WHEN 'FRAUD' THEN 2 WHEN 'AML' THEN 1 ELSE 0 END) AS r FROM alerts WHERE case_id IS NOT NULL GROUP BY 1),
    rows AS (SELECT * FROM cases UNION ALL SELECT * REPLACE ('STATUS_31_PENDING_CASE_REOPENING_APPROVAL' AS status) FROM cases WHERE case_id % 7 = 0),
    c AS (SELECT rows.*, CASE r WHEN 3 THEN 'FRAUD_AND_AML' WHEN 2 THEN 'FRAUD' WHEN 1 THEN 'AML' ELSE 'UNKNOWN' END AS cat FROM rows LEFT JOIN k USING (case_id))"""


def _cases(spark, d):
    rows = frame(spark, d, "orders", CASES)
    return rows.unionByName(rows.where("case_id % 7 = 0").withColumn("status", F.lit("STATUS_31_PENDING_CASE_REOPENING_APPROVAL")))


@query(
    f"""{_ROWS}, f AS (SELECT 'status' AS frame, status AS value, count(DISTINCT case_id) AS cases FROM c WHERE status NOT IN {_FINAL} GROUP BY 2 UNION ALL SELECT 'category', cat, count(DISTINCT case_id) FROM c WHERE status NOT IN {_FINAL} GROUP BY 2
    UNION ALL SELECT 'disposition', CASE WHEN status LIKE '%CONFIRMED' THEN 'CONFIRMED' WHEN status LIKE '%REFUTED' THEN 'REFUTED' WHEN status LIKE '%INCONCLUSIVE' THEN 'INCONCLUSIVE' ELSE 'ABANDONED' END, count(DISTINCT case_id) FROM c WHERE status IN {_FINAL} AND year(case_updated_ts) = 1997 GROUP BY 2)
    SELECT frame, value, cases, round(cases / sum(cases) OVER (PARTITION BY frame) * 100, 8) AS pct FROM f"""
)
def met_06_counts(spark, d):
    return case_tracking.case_counts(_cases(spark, d), alerts(spark, d), START, END).withColumn("pct", r8("pct"))


@query(
    f"""{_ROWS}, p AS (SELECT case_id, bool_or(case_creation_type <> 'AUTOMATIC_SYSTEM' AND year(case_created_ts) = 1997) AS m, bool_or(status IN {_FINAL} AND year(case_updated_ts) = 1997) AS e, bool_or(status LIKE '%AUTOCLOSED%' AND year(case_updated_ts) = 1997) AS a, bool_or(status LIKE 'STATUS_31%') AS r FROM c GROUP BY 1)
    SELECT count(*) FILTER (m) AS manual_cases, count(*) FILTER (a) AS auto_closed_cases, count(*) FILTER (a AND r) AS auto_closed_reopened, count(*) FILTER (e) AS closed_cases, count(*) FILTER (e AND r) AS closed_reopened, (SELECT count(DISTINCT case_id) FROM alerts WHERE year(created_at_ts) = 1997) AS cases_from_alerts,
      round(CASE WHEN count(*) FILTER (a) = 0 THEN 0 ELSE count(*) FILTER (a AND r) / count(*) FILTER (a) END, 8) AS auto_closure_reopen_rate, round(CASE WHEN count(*) FILTER (e) = 0 THEN 0 ELSE count(*) FILTER (e AND r) / count(*) FILTER (e) END, 8) AS reopened_case_rate FROM p"""
)
def met_06_flow(spark, d):
    out = case_tracking.case_flow(_cases(spark, d), alerts(spark, d), START, END)
    return out.withColumns({c: r8(c) for c in ("auto_closure_reopen_rate", "reopened_case_rate")})


@query(
    f"""{_ROWS}, l AS (SELECT 'open' AS list, * FROM c WHERE status NOT IN {_FINAL} UNION ALL SELECT 'new', * FROM c WHERE year(case_created_ts) = 1997 UNION ALL SELECT 'closed', * FROM c WHERE status IN {_FINAL} AND year(case_updated_ts) = 1997 UNION ALL SELECT 'reopened', * FROM c WHERE status LIKE 'STATUS_31%')
    SELECT DISTINCT list, case_id, status, cat AS case_category, case_creation_type, strftime(case_created_ts, '%Y-%m-%d') AS created FROM l"""
)
def met_06_lists(spark, d):
    """The drill-downs: every case on each list it belongs to."""
    out = case_tracking.case_lists(_cases(spark, d), alerts(spark, d), START, END)
    return out.select("list", "case_id", "status", "case_category", "case_creation_type", F.date_format("case_created_ts", "yyyy-MM-dd").alias("created"))


def _page(spark, d):
    return executive.supervisor(cases(spark, d), tasks(spark, d), F.lit("1999-07-01").cast("timestamp"), START, END)


@query(f"{STAR} SELECT status, count(*) AS cases, count(*) FILTER (status NOT IN {_FINAL}) AS open_cases, count(*) FILTER (status IN {_FINAL}) AS closed_cases, round(count(*) / sum(count(*)) OVER (), 8) AS share FROM cases GROUP BY 1")
def met_11_inventory(spark, d):
    return _page(spark, d)["inventory"].withColumn("share", r8("share"))


@query(f"{STAR} SELECT assigned_user_id, count(*) AS tasks, count(*) FILTER (is_completed = 1) AS completed, count(*) FILTER (sla_breached = 1) AS breached, round(avg(task_duration_ms) / 3600000, 8) AS avg_hours FROM tasks GROUP BY 1")
def met_11_workload(spark, d):
    return _page(spark, d)["workload"].withColumn("avg_hours", r8("avg_hours"))


@query(f"{STAR}, a AS (SELECT CAST(floor(date_diff('second', case_created_ts, TIMESTAMP '1999-07-01') / 86400) AS BIGINT) AS d FROM cases WHERE NOT (status LIKE '%CLOSED%' OR status LIKE '%COMPLETE%' OR status LIKE '%DISPOSED%')) SELECT CASE WHEN d <= 7 THEN '0-7' WHEN d <= 14 THEN '8-14' WHEN d <= 30 THEN '15-30' WHEN d <= 60 THEN '31-60' ELSE '60+' END AS age_bucket, count(*) AS cases FROM a GROUP BY 1")
def met_11_ages(spark, d):
    return _page(spark, d)["ages"]


_WHEN = "CASE year({0}) WHEN 1997 THEN 'current' WHEN 1996 THEN 'previous' END"
_CLOSED = "(status LIKE '%CLOSED%' OR status LIKE '%COMPLETE%' OR status LIKE '%DISPOSED%')"


@query(
    f"""{STAR}, s AS (SELECT case_id, {_WHEN.format('created_at_ts')} AS period, bool_or(alert_type_norm IN ('AML', 'FRAUD_AND_AML')) AS aml, bool_or(alert_type_norm IN ('FRAUD', 'FRAUD_AND_AML')) AS fraud, bool_or(alert_type_norm = 'FRAUD_AND_AML') AS mixed FROM alerts GROUP BY ALL),
    c AS (SELECT cases.*, {_WHEN.format('case_created_ts')} AS period FROM cases), o AS (SELECT period, avg(r) AS r FROM (SELECT period, case_owner_user_id, round(count(*) FILTER ({_CLOSED}) / count(*) * 100, 2) AS r FROM c WHERE case_owner_user_id IS NOT NULL GROUP BY ALL) GROUP BY 1),
    p AS (SELECT c.period, count(*) FILTER (case_creation_type = 'AUTOMATIC_SYSTEM') AS cases_from_alerts, count(*) FILTER (case_creation_type <> 'AUTOMATIC_SYSTEM') AS manual_cases, count(*) FILTER (aml) AS aml_cases, count(*) FILTER (fraud) AS fraud_cases, count(*) FILTER (mixed) AS fraud_aml_cases,
      count(*) FILTER (status LIKE '%AUTO%CLOSED%') AS auto_closed_cases, count(*) FILTER ({_CLOSED}) AS closed_cases, count(*) FILTER (has_parent_case = 1) AS reopened_cases FROM c LEFT JOIN s ON c.case_id = s.case_id AND c.period = s.period WHERE c.period IS NOT NULL GROUP BY 1)
    SELECT p.*, round(coalesce(o.r, 0), 6) AS avg_closure_rate_pct, round(CASE WHEN closed_cases = 0 THEN 0 ELSE reopened_cases / closed_cases * 100 END, 8) AS reopened_rate_pct FROM p LEFT JOIN o USING (period)"""
)
def met_17_periods(spark, d):
    out = case_tracking.case_periods(cases(spark, d), alerts(spark, d), NOW, BEFORE)
    return out.withColumns({"avg_closure_rate_pct": F.round("avg_closure_rate_pct", 6), "reopened_rate_pct": r8("reopened_rate_pct")})


@query(
    f"""{STAR}, a AS (SELECT alerts.case_id, case_creation_type, status, epoch(case_updated_ts) - epoch(created_at_ts) AS s FROM alerts LEFT JOIN cases USING (case_id) WHERE year(created_at_ts) = 1997)
    SELECT 'closed' AS frame, 'all' AS value, count(*) AS cases, round(avg(created_to_updated_ms) / 3600000, 6) AS avg_hours FROM cases WHERE status LIKE '%CLOSED%' AND year(case_updated_ts) = 1997
    UNION ALL SELECT 'case_creation_type', case_creation_type, count(DISTINCT case_id), round(avg(s) / 3600, 6) FROM a GROUP BY 2 UNION ALL SELECT 'status', status, count(DISTINCT case_id), round(avg(s) / 3600, 6) FROM a GROUP BY 2"""
)
def met_09_disposition_times(spark, d):
    return case_tracking.disposition_times(cases(spark, d), alerts(spark, d), START, END, ("case_creation_type", "status")).withColumn("avg_hours", F.round("avg_hours", 6))
