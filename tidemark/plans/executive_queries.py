"""Executive metrics over the star tables, each with the same query in SQL.

Orders are payments and, by the same key, cases; line items are alerts and
tasks. Lines 5 and up have no payment message, so their payment is found by the
alert's own end-to-end id.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.operators import joins, windows
from tidemark.plans import executive
from tidemark.plans.queries import query, scratch, table
from tidemark.sources import sinks

ALERTS = {
    "alert_id": "concat(CAST(l_orderkey AS {text}), '-', CAST(l_linenumber AS {text}))",
    "case_id": "l_orderkey",
    "tx_msg_id": "CASE WHEN l_linenumber <= 4 THEN CAST(l_orderkey AS {text}) END",
    "tx_original_e2e_id": "CAST(l_suppkey AS {text})",
    "alert_type_norm": "CASE l_returnflag WHEN 'A' THEN 'AML' WHEN 'N' THEN 'FRAUD' ELSE 'FRAUD_AND_AML' END",
    "prediction_outcome_norm": "CASE WHEN l_tax > 0.055 THEN 'TRUE_POSITIVE' WHEN l_tax > 0.035 THEN 'FALSE_POSITIVE' WHEN l_tax > 0.015 THEN 'FALSE_NEGATIVE' ELSE 'TRUE_NEGATIVE' END",
    "tx_amount": "CASE WHEN l_quantity > 25 THEN l_extendedprice END",
    "tx_status": "CAST(NULL AS {text})",
    "created_at_ts": "l_shipdate",
}
PAYMENTS = {
    "transaction_id": "o_orderkey",
    "tx_msg_id": "CAST(o_orderkey AS {text})",
    "end_to_end_id": "CAST(o_custkey AS {text})",
    "tx_type": "CASE WHEN o_orderpriority = '5-LOW' THEN 'pacs.002.001.12' ELSE 'pacs.008.001.10' END",
    "tx_status": "CASE o_orderstatus WHEN 'F' THEN 'BLOCKED' WHEN 'O' THEN 'ACCC' ELSE 'RJCT' END",
    "tx_amount": "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END",
    "event_ts": "o_orderdate",
    "ingested_at_ts": "o_orderdate",
    "evaluated": "o_orderpriority <> '4-NOT SPECIFIED'",
}
CASES = {
    "case_id": "o_orderkey",
    "status": "CASE WHEN o_orderstatus = 'O' THEN 'STATUS_20_IN_PROGRESS' WHEN o_orderstatus = 'P' THEN 'STATUS_10_ASSIGNED' WHEN o_orderpriority = '1-URGENT' THEN 'STATUS_82_CLOSED_CONFIRMED' "
    "WHEN o_orderpriority = '2-HIGH' THEN 'STATUS_81_CLOSED_REFUTED' WHEN o_orderpriority = '3-MEDIUM' THEN 'STATUS_83_CLOSED_INCONCLUSIVE' WHEN o_orderpriority = '5-LOW' THEN 'STATUS_90_COMPLETE' ELSE 'STATUS_71_AUTOCLOSED_CONFIRMED' END",
    "case_creation_type": "CASE WHEN o_totalprice < 150000 THEN 'MANUAL' ELSE 'AUTOMATIC_SYSTEM' END",
    "has_parent_case": "CASE WHEN o_totalprice > 300000 THEN 1 ELSE 0 END",
    "case_owner_user_id": "CASE WHEN o_orderstatus <> 'P' THEN o_custkey END",
    "created_to_updated_ms": "(o_custkey - 50) * 60000",
    "case_created_ts": "o_orderdate",
    "case_updated_ts": "o_orderdate + INTERVAL {days30}",
}
TASKS = {
    "task_id": ALERTS["alert_id"],
    "case_id": "l_orderkey",
    "status": "CASE l_linestatus WHEN 'O' THEN 'STATUS_20_IN_PROGRESS' ELSE 'STATUS_30_COMPLETED' END",
    "is_completed": "CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END",
    "candidate_group": "CASE l_returnflag WHEN 'R' THEN 'INVESTIGATIONS' ELSE 'REVIEW' END",
    "task_name": "CASE l_linenumber WHEN 1 THEN 'File SAR' WHEN 2 THEN 'File str' ELSE 'Review' END",
    "task_created_ts": "l_shipdate",
    "assigned_user_id": "l_suppkey",
    "sla_breached": "CASE l_returnflag WHEN 'A' THEN 1 ELSE 0 END",
    "task_duration_ms": "l_quantity * 3600000",
}


def frame(spark, d, name, columns):
    return table(spark, d, name).selectExpr(*[f"{e.format(text='STRING', days30='30 DAYS')} AS {c}" for c, e in columns.items()])


def cte(name, columns, source):
    return f"{name} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source})".format(text="VARCHAR", days30="30 DAY")


def alerts(spark, d):
    return frame(spark, d, "lineitem", ALERTS)


def payments(spark, d):
    return frame(spark, d, "orders", PAYMENTS)


def cases(spark, d):
    return frame(spark, d, "orders", CASES)


def tasks(spark, d):
    return frame(spark, d, "lineitem", TASKS)


STAR = "WITH " + ", ".join([cte("alerts", ALERTS, "lineitem"), cte("payments", PAYMENTS, "orders"), cte("cases", CASES, "orders"), cte("tasks", TASKS, "lineitem")])
DAYS = """, received AS (SELECT CAST(ingested_at_ts AS DATE) AS d, count(DISTINCT tx_msg_id) AS transactions_received FROM payments GROUP BY 1),
    seen AS (SELECT CAST(ingested_at_ts AS DATE) AS d, count(DISTINCT tx_msg_id) AS transactions_evaluated FROM payments WHERE evaluated GROUP BY 1)"""
DAY = "strftime(d, '%Y-%m-%d') AS metric_date"


def rate(part: str, whole: str, name: str) -> str:
    return f"round(CASE WHEN coalesce({whole}, 0) = 0 THEN 0.0 ELSE {part} / {whole} * 100 END, 8) AS {name}"


def speed(part: str, name: str) -> str:
    r = f"(CASE WHEN coalesce(transactions_evaluated, 0) = 0 THEN 0.0 ELSE {part} / transactions_evaluated * 100 END)"
    before = f"lag({r}) OVER (ORDER BY d)"
    return f"round(CASE WHEN {before} <> 0 THEN ({r} - {before}) / {before} * 100 END, 6) AS {name}"


def shown(df, rounded: dict[str, int] | None = None):
    """Dates as text, doubles to eight places or as given."""
    out = df.withColumns({c: F.round(c, (rounded or {}).get(c, 8)) for c, kind in df.dtypes if kind == "double"})
    return out.withColumn("metric_date", F.date_format("metric_date", "yyyy-MM-dd")) if "metric_date" in df.columns else out


@query(
    f"""{STAR}{DAYS}, j AS (SELECT CAST(created_at_ts AS DATE) AS d, a.tx_msg_id, alert_id, alert_type_norm, p.tx_status AS state FROM alerts a LEFT JOIN payments p USING (tx_msg_id)),
    c AS (SELECT d, count(DISTINCT tx_msg_id) AS transactions_generated_alert, count(DISTINCT alert_id) AS total_alerts, count(DISTINCT tx_msg_id) FILTER (alert_type_norm IN ('AML', 'FRAUD_AND_AML')) AS aml_alert_transactions,
      count(DISTINCT tx_msg_id) FILTER (alert_type_norm IN ('FRAUD', 'FRAUD_AND_AML')) AS fraud_alert_transactions, count(DISTINCT alert_id) FILTER (state IN ('BLOCKED', 'RJCT')) AS interdiction_alerts,
      count(DISTINCT alert_id) FILTER (state = 'BLOCKED') AS block_condition_alerts, count(DISTINCT tx_msg_id) FILTER (state = 'BLOCKED') AS blocked_transactions,
      count(DISTINCT alert_id) FILTER (state = 'ACCC') AS override_alerts, count(DISTINCT tx_msg_id) FILTER (state = 'ACCC') AS override_transactions FROM j GROUP BY 1)
    SELECT {DAY}, c.* EXCLUDE (d), coalesce(transactions_received, 0) AS transactions_received, coalesce(transactions_evaluated, 0) AS transactions_evaluated,
      {rate('transactions_generated_alert', 'transactions_received', 'received_alert_rate_pct')}, {rate('transactions_generated_alert', 'transactions_evaluated', 'evaluated_alert_rate_pct')},
      {rate('aml_alert_transactions', 'transactions_evaluated', 'aml_alert_rate_pct')}, {rate('fraud_alert_transactions', 'transactions_evaluated', 'fraud_alert_rate_pct')},
      {rate('interdiction_alerts', 'transactions_evaluated', 'overall_interdiction_rate_pct')}, {rate('blocked_transactions', 'transactions_evaluated', 'block_condition_rate_pct')},
      {rate('override_transactions', 'transactions_evaluated', 'override_condition_rate_pct')}, {rate('override_transactions', 'transactions_generated_alert', 'override_rate_pct')}, {rate('blocked_transactions', 'transactions_generated_alert', 'block_rate_pct')},
      {speed('aml_alert_transactions', 'aml_alert_velocity_pct_change')}, {speed('fraud_alert_transactions', 'fraud_alert_velocity_pct_change')}
    FROM c LEFT JOIN received USING (d) LEFT JOIN seen USING (d)"""
)
def met_25_alerts(spark, d):
    p = payments(spark, d)
    return shown(executive.daily_alerts(alerts(spark, d), p, p.where("evaluated")), {"aml_alert_velocity_pct_change": 6, "fraud_alert_velocity_pct_change": 6})


@query(
    f"""{STAR}, k AS (SELECT case_id, bool_or(alert_type_norm = 'AML') AS aml, bool_or(alert_type_norm = 'FRAUD') AS fraud, bool_or(alert_type_norm = 'FRAUD_AND_AML') AS mixed FROM alerts GROUP BY 1),
    w AS (SELECT DISTINCT case_id FROM tasks WHERE status = 'STATUS_20_IN_PROGRESS'), t AS (SELECT CAST(task_created_ts AS DATE) AS d, count(*) FILTER (is_completed = 0) AS open_tasks FROM tasks GROUP BY 1),
    c AS (SELECT CAST(case_created_ts AS DATE) AS d, count(*) AS total_cases_created, count(*) FILTER (case_creation_type = 'AUTOMATIC_SYSTEM') AS cases_from_alerts, count(*) FILTER (case_creation_type <> 'AUTOMATIC_SYSTEM') AS manual_cases_created,
      count(*) FILTER (status LIKE '%CLOSED%' OR status LIKE '%AUTO%') AS auto_closed_cases, count(*) FILTER (status LIKE '%CLOSED%' AND has_parent_case = 1) AS auto_closed_reopened, count(*) FILTER (has_parent_case = 1) AS cases_reopened,
      count(*) FILTER (status LIKE '%CLOSED%' OR status LIKE '%COMPLETE%') AS total_cases_closed, count(*) FILTER (aml) AS aml_cases, count(*) FILTER (fraud) AS fraud_cases, count(*) FILTER (mixed) AS fraud_aml_cases,
      count(*) FILTER (w.case_id IS NOT NULL) AS cases_with_open_investigations, count(*) FILTER (status = 'STATUS_82_CLOSED_CONFIRMED') AS confirmed_cases, count(*) FILTER (status = 'STATUS_81_CLOSED_REFUTED') AS refuted_cases,
      count(*) FILTER (status = 'STATUS_83_CLOSED_INCONCLUSIVE') AS inconclusive_cases, count(*) FILTER (created_to_updated_ms > 0) AS cases_with_duration, count(case_owner_user_id) AS cases_with_owner, avg(created_to_updated_ms) FILTER (created_to_updated_ms > 0) AS ms
      FROM cases LEFT JOIN k ON cases.case_id = k.case_id LEFT JOIN w ON cases.case_id = w.case_id GROUP BY 1)
    SELECT {DAY}, c.* EXCLUDE (d, ms), round(ms / 3600000, 8) AS avg_mttd_hours, round(ms / 86400000, 8) AS avg_mttd_days, coalesce(open_tasks, 0) AS open_tasks, {rate('manual_cases_created', 'total_cases_created', 'manual_case_rate_pct')},
      {rate('auto_closed_reopened', 'auto_closed_cases', 'auto_closure_reopen_rate_pct')}, {rate('cases_reopened', 'total_cases_closed', 'reopened_case_rate_pct')},
      {rate('cases_with_open_investigations', 'cases_from_alerts', 'investigation_conversion_rate_pct')}, {rate('confirmed_cases', 'total_cases_closed', 'confirmation_rate_pct')} FROM c LEFT JOIN t USING (d)"""
)
def met_26_cases(spark, d):
    return shown(executive.daily_case_metrics(cases(spark, d), alerts(spark, d), tasks(spark, d)))


BRIDGE = """, first_payment AS (SELECT end_to_end_id AS e2e, tx_amount, tx_status, event_ts FROM payments WHERE tx_type = 'pacs.008.001.10' QUALIFY row_number() OVER (PARTITION BY end_to_end_id ORDER BY event_ts, transaction_id) = 1),
    paid AS (SELECT a.case_id, a.alert_type_norm, a.prediction_outcome_norm AS outcome, coalesce(m.end_to_end_id, a.tx_original_e2e_id) AS e2e, coalesce(a.tx_amount, b.tx_amount, r.tx_amount) AS amount,
      coalesce(b.tx_status, r.tx_status, m.tx_status) AS state, coalesce(b.event_ts, r.event_ts, m.event_ts) AS ts
      FROM alerts a LEFT JOIN payments m ON a.tx_msg_id = m.tx_msg_id LEFT JOIN first_payment b ON m.end_to_end_id = b.e2e LEFT JOIN first_payment r ON a.tx_original_e2e_id = r.e2e)"""


@query(
    f"""{STAR}{DAYS}{BRIDGE}, pairs AS (SELECT CAST(case_created_ts AS DATE) AS d, c.case_id, e2e, max(status) AS status, max(case_creation_type) AS made, bool_or(outcome = 'TRUE_POSITIVE') AS tp, bool_or(outcome = 'FALSE_POSITIVE') AS fp, bool_or(outcome = 'FALSE_NEGATIVE') AS fn,
      max(coalesce(amount, 0)) AS amount, max(CASE WHEN state IN ('BLOCKED', 'REJECTED', 'RJCT') THEN coalesce(amount, 0) ELSE 0 END) AS prevented, min(abs(epoch(case_created_ts) - epoch(ts))) AS lag FROM cases c LEFT JOIN paid p ON c.case_id = p.case_id GROUP BY 1, 2, 3),
    one AS (SELECT d, case_id, max(status) AS status, max(made) AS made, bool_or(tp) AS tp, bool_or(fp) AS fp, bool_or(fn) AS fn, sum(amount) AS amount, sum(prevented) AS prevented, sum(lag) AS lag, count(lag) AS lags FROM pairs GROUP BY 1, 2),
    f AS (SELECT d, count(*) FILTER (status = 'STATUS_82_CLOSED_CONFIRMED') AS confirmed_cases, coalesce(sum(amount) FILTER (status = 'STATUS_82_CLOSED_CONFIRMED'), 0) AS v, coalesce(sum(prevented) FILTER (status = 'STATUS_82_CLOSED_CONFIRMED'), 0) AS pv,
      count(*) FILTER (status = 'STATUS_81_CLOSED_REFUTED') AS refuted_cases, count(*) FILTER (status = 'STATUS_83_CLOSED_INCONCLUSIVE') AS inconclusive_cases, count(*) FILTER (tp) AS true_positives, count(*) FILTER (fp) AS false_positives, count(*) FILTER (fn) AS false_negatives,
      count(*) FILTER (status = 'STATUS_82_CLOSED_CONFIRMED' AND made <> 'AUTOMATIC_SYSTEM') AS manual_detected_fraud, sum(lag) FILTER (status = 'STATUS_82_CLOSED_CONFIRMED') / nullif(sum(lags) FILTER (status = 'STATUS_82_CLOSED_CONFIRMED'), 0) / 3600 AS h FROM one GROUP BY 1),
    a AS (SELECT CAST(created_at_ts AS DATE) AS d, count(DISTINCT tx_msg_id) AS transactions_with_alerts FROM alerts GROUP BY 1)
    SELECT {DAY}, f.* EXCLUDE (d, v, pv, h), round(v, 2) AS confirmed_fraud_value, round(pv, 2) AS prevented_fraud_value, round(h, 8) AS avg_detection_lag_hours, round(h / 24, 8) AS avg_detection_lag_days,
      coalesce(transactions_with_alerts, 0) AS transactions_with_alerts, coalesce(transactions_evaluated, 0) AS transactions_evaluated,
      round(CASE WHEN true_positives + false_positives = 0 THEN 0 ELSE true_positives / (true_positives + false_positives) END, 8) AS precision, round(CASE WHEN true_positives + false_negatives = 0 THEN 0 ELSE true_positives / (true_positives + false_negatives) END, 8) AS recall_tpr,
      round(CASE WHEN 2 * true_positives + false_positives + false_negatives = 0 THEN 0 ELSE 2 * true_positives / (2 * true_positives + false_positives + false_negatives) END, 8) AS f1_score,
      {rate('false_positives', 'transactions_with_alerts', 'false_positive_rate_pct')}, {rate('false_negatives', 'transactions_evaluated', 'false_negative_rate_pct')}, {rate('manual_detected_fraud', 'confirmed_cases', 'manual_detection_rate_pct')},
      {rate('confirmed_cases', 'transactions_evaluated', 'fraud_rate_pct')}, round(CASE WHEN confirmed_cases = 0 THEN 0 ELSE v / confirmed_cases END, 6) AS avg_fraud_value FROM f LEFT JOIN a USING (d) LEFT JOIN seen USING (d)"""
)
def met_27_fraud(spark, d):
    p = payments(spark, d)
    out = executive.daily_fraud(cases(spark, d), alerts(spark, d), p, p.where("evaluated"))
    return shown(out, {"confirmed_fraud_value": 2, "prevented_fraud_value": 2, "avg_fraud_value": 6})


@query(
    f"""{STAR}{BRIDGE}, pairs AS (SELECT CAST(case_created_ts AS DATE) AS d, alert_type_norm, c.case_id, e2e, max(status) AS status, max(coalesce(amount, 0)) AS amount FROM cases c JOIN paid p ON c.case_id = p.case_id GROUP BY 1, 2, 3, 4),
    one AS (SELECT d, alert_type_norm, case_id, max(status) AS status, sum(amount) AS amount FROM pairs GROUP BY 1, 2, 3),
    f AS (SELECT d, alert_type_norm, count(*) FILTER (status = 'STATUS_82_CLOSED_CONFIRMED') AS confirmed_by_typology, coalesce(sum(amount) FILTER (status = 'STATUS_82_CLOSED_CONFIRMED'), 0) AS v, count(*) FILTER (status = 'STATUS_81_CLOSED_REFUTED') AS refuted_by_typology FROM one GROUP BY 1, 2),
    a AS (SELECT CAST(created_at_ts AS DATE) AS d, alert_type_norm, count(DISTINCT alert_id) AS n FROM alerts GROUP BY 1, 2)
    SELECT {DAY}, alert_type_norm, confirmed_by_typology, round(v, 2) AS fraud_value_by_typology, refuted_by_typology, coalesce(n, 0) AS total_alerts_by_typology, {rate('refuted_by_typology', 'n', 'refuted_rate_pct')} FROM f LEFT JOIN a USING (d, alert_type_norm)"""
)
def met_27_by_type(spark, d):
    return shown(executive.daily_fraud_by_type(cases(spark, d), alerts(spark, d), payments(spark, d)), {"fraud_value_by_typology": 2})


START, END = date(1997, 1, 1), date(1997, 12, 31)
NOW, BEFORE = (START, END), (date(1996, 1, 1), date(1996, 12, 31))
PERIOD = "CASE WHEN CAST({0} AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' THEN 'current' WHEN CAST({0} AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' THEN 'previous' END"


@query(f"{STAR} SELECT status, count(DISTINCT task_id) AS investigation_tasks, count(DISTINCT task_id) FILTER (upper(task_name) LIKE '%SAR%' OR upper(task_name) LIKE '%STR%') AS sar_str_filings FROM tasks WHERE candidate_group = 'INVESTIGATIONS' AND year(task_created_ts) = 1997 GROUP BY 1")
def met_08_investigation(spark, d):
    return executive.investigation_tasks(tasks(spark, d), START, END)


@query(f"{STAR} SELECT count(*) FILTER (year(case_created_ts) = 1997) AS investigations_created, count(*) FILTER (status LIKE '%CLOSED%' AND year(case_updated_ts) = 1997) AS investigations_closed FROM cases")
def met_11_supervisor_flow(spark, d):
    return executive.supervisor(cases(spark, d), tasks(spark, d), F.lit("2002-01-01").cast("timestamp"), START, END)["investigation_flow"]


@query(
    f"""{STAR}, a AS (SELECT *, {PERIOD.format('created_at_ts')} AS period FROM alerts), c AS (SELECT DISTINCT case_id, {PERIOD.format('case_created_ts')} AS period FROM cases), p AS (SELECT {PERIOD.format('ingested_at_ts')} AS period, count(*) AS tx_evaluated FROM payments GROUP BY 1),
    t AS (SELECT a.period, count(*) AS total_alerts, count(DISTINCT tx_msg_id) AS tx_with_alerts, count(DISTINCT alert_id) FILTER (c.case_id IS NOT NULL AND (prediction_outcome_norm = 'FALSE_POSITIVE' OR (alert_type_norm = 'FRAUD' AND prediction_outcome_norm = 'TRUE_POSITIVE'))) AS auto_closed
      FROM a LEFT JOIN c ON a.case_id = c.case_id AND a.period = c.period WHERE a.period IS NOT NULL GROUP BY 1)
    SELECT t.*, coalesce(tx_evaluated, 0) AS tx_evaluated, {rate('tx_with_alerts', 'tx_evaluated', 'evaluated_alert_rate_pct')}, {rate('auto_closed', 'total_alerts', 'auto_closure_rate_pct')} FROM t LEFT JOIN p ON t.period = p.period"""
)
def met_16_alert_periods(spark, d):
    return shown(executive.alert_periods(alerts(spark, d), cases(spark, d), payments(spark, d), NOW, BEFORE))


@query(
    f"""{STAR}, t AS (SELECT {PERIOD.format('task_created_ts')} AS period, count(*) FILTER (is_completed = 0) AS open_tasks, count(DISTINCT case_id) FILTER (candidate_group LIKE '%INVEST%') AS investigations_created, count(DISTINCT case_id) FILTER (candidate_group LIKE '%INVEST%' AND is_completed = 0) AS open_investigations FROM tasks GROUP BY 1),
    c AS (SELECT {PERIOD.format('case_created_ts')} AS period, count(*) FILTER (case_creation_type = 'AUTOMATIC_SYSTEM') AS cases_from_alerts, count(*) FILTER (status = 'STATUS_82_CLOSED_CONFIRMED') AS confirmed_cases, count(*) FILTER (status LIKE '%CLOSED%' OR status LIKE '%COMPLETE%' OR status LIKE '%DISPOSED%') AS closed_cases FROM cases GROUP BY 1)
    SELECT period, c.* EXCLUDE (period), t.* EXCLUDE (period), {rate('open_investigations', 'cases_from_alerts', 'investigation_conversion_rate_pct')}, {rate('confirmed_cases', 'closed_cases', 'confirmation_rate_pct')} FROM c JOIN t USING (period) WHERE period IS NOT NULL"""
)
def met_19_investigation_periods(spark, d):
    return shown(executive.investigation_periods(cases(spark, d), tasks(spark, d), NOW, BEFORE))


@query(
    f"""{STAR}, k AS (SELECT DISTINCT alert_type_norm, case_id FROM alerts), a AS (SELECT alert_type_norm, count(DISTINCT alert_id) AS alert_count, count(DISTINCT alert_id) FILTER (prediction_outcome_norm = 'FALSE_POSITIVE') AS false_positives FROM alerts GROUP BY 1),
    c AS (SELECT alert_type_norm, count(*) AS total_cases, count(*) FILTER (NOT (status LIKE '%CLOSED%' OR status LIKE '%COMPLETE%')) AS open_cases, count(*) FILTER (status LIKE '%CLOSED%' OR status LIKE '%COMPLETE%') AS closed_cases, count(*) FILTER (status = 'STATUS_82_CLOSED_CONFIRMED') AS confirmed_cases,
      round(avg(created_to_updated_ms) FILTER ((status LIKE '%CLOSED%' OR status LIKE '%COMPLETE%') AND created_to_updated_ms > 0) / 3600000, 8) AS mttd_hours FROM cases JOIN k USING (case_id) GROUP BY 1)
    SELECT a.*, c.* EXCLUDE (alert_type_norm), {rate('confirmed_cases', 'closed_cases', 'confirmation_rate_pct')}, {rate('false_positives', 'alert_count', 'false_positive_rate_pct')} FROM a JOIN c USING (alert_type_norm)"""
)
def met_22_typologies(spark, d):
    return shown(executive.typology_metrics(alerts(spark, d), cases(spark, d)))


@query(
    """WITH e AS (SELECT CAST(ts AS DATE) AS d, hour(ts) AS metric_hour, month(ts) AS metric_month, quarter(ts) AS metric_quarter, year(ts) AS metric_year, event_type AS alert_type_norm, count(*) AS alerts FROM events GROUP BY ALL)
    SELECT strftime(d, '%Y-%m-%d') AS metric_date, metric_hour, metric_month, metric_quarter, metric_year, alert_type_norm, alerts, CAST(sum(alerts) OVER w AS BIGINT) AS total_alerts, round(alerts / sum(alerts) OVER w * 100, 8) AS type_pct FROM e WINDOW w AS (PARTITION BY d, metric_hour)"""
)
def join_14_time_columns(spark, d):
    return shown(executive.hourly_share(table(spark, d, "events").select(F.col("event_type").alias("alert_type_norm"), F.col("ts").alias("created_at_ts"))))


@query("SELECT strftime(o_orderdate, '%Y-%m-%d') AS metric_date, count(*) AS orders, coalesce(max(n), 0) AS shipped FROM orders LEFT JOIN (SELECT strftime(l_shipdate, '%Y-%m-%d') AS k, count(*) AS n FROM lineitem GROUP BY 1) ON strftime(o_orderdate, '%Y-%m-%d') = k GROUP BY 1")
def join_15_date_key(spark, d):
    """Dates of one side against text of the other, cast where it is said."""
    days = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("metric_date")).agg(F.count("*").alias("orders"))
    keys = table(spark, d, "lineitem").groupBy(F.date_format("l_shipdate", "yyyy-MM-dd").alias("k")).agg(F.count("*").alias("shipped"))
    return shown(days.join(keys, F.col("metric_date") == F.to_date("k"), "left").drop("k").fillna(0, ["shipped"]))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderstatus, c_mktsegment, n_name, p_brand, count(*) AS copies FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN part ON l_partkey = p_partkey
    GROUP BY ALL"""
)
def join_16_star(spark, d):
    line, order, customer, nation, part = (table(spark, d, n).alias(a) for n, a in (("lineitem", "l"), ("orders", "o"), ("customer", "c"), ("nation", "n"), ("part", "p")))
    n = line.count()  # Parquet footers tell it; tasks grow in number with the table, not in size
    deal = lambda df, key: joins.spread(df, n, key)
    rows = deal(line, "l.l_orderkey").join(deal(order, "o.o_orderkey"), F.col("l.l_orderkey") == F.col("o.o_orderkey"), "left")
    rows = deal(rows, "o.o_custkey").join(deal(customer, "c.c_custkey"), F.col("o.o_custkey") == F.col("c.c_custkey"), "left")
    rows = rows.join(nation, F.col("c.c_nationkey") == F.col("n.n_nationkey"), "left")
    rows = deal(rows, "l.l_partkey").join(deal(part, "p.p_partkey"), F.col("l.l_partkey") == F.col("p.p_partkey"), "left")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderstatus", "c_mktsegment", "n_name", "p_brand"]
    return rows.groupBy(*keys).agg(F.count("*").alias("copies"))


@query("SELECT o_orderkey, o_custkey, n AS customer_orders FROM orders JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 12) USING (o_custkey)")
def join_18_details(spark, d):
    """Customers with many orders, joined back for each of their orders."""
    orders = table(spark, d, "orders")
    busy = orders.groupBy("o_custkey").agg(F.count("*").alias("customer_orders")).where("customer_orders >= 12")
    return orders.select("o_orderkey", "o_custkey").join(busy, "o_custkey")


@query("SELECT event_type, true AS within_one_percent FROM events GROUP BY 1")
def agg_12_approx_quantile(spark, d):
    """An approximate 95th percentile's true rank is within one per cent of what was asked for."""
    events = table(spark, d, "events")
    rough = events.groupBy("event_type").agg(F.percentile_approx("value", 0.95, 100).alias("p"))
    at = F.col("value") <= F.col("p")
    ranks = events.join(rough, "event_type").groupBy("event_type").agg((F.count_if(at) / F.count("value")).alias("upto"), (F.count_if(F.col("value") < F.col("p")) / F.count("value")).alias("below"))
    return ranks.select("event_type", ((F.col("upto") >= 0.94) & (F.col("below") <= 0.96)).alias("within_one_percent"))


@query("SELECT user_id, event_type AS first_type, event_id AS first_event FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def agg_14_first(spark, d):
    """The first value of a group by a stated order, not by luck."""
    order = F.struct("ts", "event_id")
    return table(spark, d, "events").groupBy("user_id").agg(F.min_by("event_type", order).alias("first_type"), F.min_by("event_id", order).alias("first_event"))


@query("SELECT l_orderkey, CASE WHEN l_linenumber <= 4 THEN o_orderpriority END AS purp_cd, count(*) AS alerts FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL")
def rule_078_purpose(spark, d):
    """Lines of an order from the fifth on belong to another tenant, so they find no payment."""
    alerts_ = table(spark, d, "lineitem").select("l_orderkey", F.col("l_orderkey").alias("end_to_end_id"), F.when(F.col("l_linenumber") <= 4, "a").otherwise("b").alias("tenant_id"))
    paid = table(spark, d, "orders").select(F.col("o_orderkey").alias("end_to_end_id"), F.lit("a").alias("tenant_id"), F.col("o_orderdate").alias("event_ts"), F.col("o_orderpriority").alias("purp_cd"))
    return executive.purpose_codes(alerts_, paid).groupBy("l_orderkey", "purp_cd").agg(F.count("*").alias("alerts"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events ORDER BY ts DESC, event_id LIMIT 10")
def srt_07_most_recent(spark, d):
    rows = windows.most_recent(table(spark, d, "events"), ["updated_at", "ts", "event_ts"], 10, ["event_id"])
    return rows.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("SELECT event_type, count(*) AS events FROM events GROUP BY 1")
def snk_03_metric_table(spark, d):
    """Written twice in place: the second replaces the first."""
    counts = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("events"))
    folder = scratch(spark, "snk_03")
    for _ in range(2):
        sinks.write_metric(counts, folder, "events_by_type")
    return spark.read.parquet(f"{folder}/events_by_type")


@query("SELECT event_type, count(*) AS events, run FROM events, (VALUES (1), (2)) AS r(run) GROUP BY ALL")
def snk_04_json_append(spark, d):
    """Two reports appended to one folder."""
    counts = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("events"))
    folder = scratch(spark, "snk_04")
    for run in (1, 2):
        sinks.append_json(counts.withColumn("run", F.lit(run)), folder)
    return spark.read.schema("event_type STRING, events LONG, run INT").json(folder)
