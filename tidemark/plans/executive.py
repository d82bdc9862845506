"""Executive metrics: alerts, cases and confirmed fraud per day, and comparisons of two periods.

Every table is first reduced along its keys (payment, alert, case) by plain
aggregates with a map-side part, then to a row per day; only those few rows are
joined by date. Distinct counts are two groupings instead of an expansion per
distinct column, and no day is one task's set.

Rates are in per cent and 0 where their denominator is 0 or missing; velocities
are null where there is no period before, or its rate is 0.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import in_date_range
from tidemark.operators.aggregates import share
from tidemark.operators.joins import left_join_known
from tidemark.plans.metrics import case_ages, case_inventory, closed, task_workload

# States of cases and payments, and message types, as the source systems write them.
CONFIRMED = "STATUS_82_CLOSED_CONFIRMED"
REFUTED = "STATUS_81_CLOSED_REFUTED"
INCONCLUSIVE = "STATUS_83_CLOSED_INCONCLUSIVE"
IN_PROGRESS = "STATUS_20_IN_PROGRESS"
AUTOMATIC = "AUTOMATIC_SYSTEM"
INTERDICTED = ("BLOCKED", "RJCT")
PREVENTED = ("BLOCKED", "REJECTED", "RJCT")
OVERRIDDEN = "ACCC"
PAYMENT_TYPES = ("pacs.008.001.10", "pain.001.001.11")

AML_TYPES = ("AML", "FRAUD_AND_AML")
FRAUD_TYPES = ("FRAUD", "FRAUD_AND_AML")


def auto_closed() -> Column:
    """Alerts that close without a person: false positives, and confirmed fraud."""
    outcome = F.col("prediction_outcome_norm")
    return (outcome == "FALSE_POSITIVE") | ((F.col("alert_type_norm") == "FRAUD") & (outcome == "TRUE_POSITIVE"))


def pct(part: str, whole: str) -> Column:
    return share(F.col(part), F.col(whole)) * 100


def time_dimensions(ts: Column) -> list[Column]:
    return [F.to_date(ts).alias("metric_date"), F.hour(ts).alias("metric_hour"), F.month(ts).alias("metric_month"), F.quarter(ts).alias("metric_quarter"), F.year(ts).alias("metric_year")]


def velocity(df: DataFrame, period: str, rates: dict[str, str]) -> DataFrame:
    """Change of rates against the period before, in per cent. For rows of periods, few by then."""
    w = Window.orderBy(period)
    before = {r: F.lag(r).over(w) for r in rates}
    return df.withColumns({name: F.when(before[r].isNotNull() & (before[r] != 0), (F.col(r) - before[r]) / before[r] * 100) for r, name in rates.items()})


def distinct_per_day(df: DataFrame, ts: str, key: str, name: str) -> DataFrame:
    """Different keys per day; null keys don't count."""
    return df.where(F.col(key).isNotNull()).select(F.to_date(ts).alias("metric_date"), key).distinct().groupBy("metric_date").agg(F.count("*").alias(name))


def hourly_share(alerts: DataFrame, ts: str = "created_at_ts") -> DataFrame:
    """Alerts per hour and type beside all alerts of the hour, joined on the five time columns."""
    dims = ["metric_date", "metric_hour", "metric_month", "metric_quarter", "metric_year"]
    rows = alerts.select("alert_type_norm", *time_dimensions(F.col(ts)))
    kinds = rows.groupBy(*dims, "alert_type_norm").agg(F.count("*").alias("alerts"))
    return kinds.join(kinds.groupBy(*dims).agg(F.sum("alerts").alias("total_alerts")), dims, "left").withColumn("type_pct", pct("alerts", "total_alerts"))


def daily_alerts(alerts: DataFrame, transactions: DataFrame, evaluated: DataFrame) -> DataFrame:
    """Alert metrics per day of the alert. An alert belongs to one payment; rows that repeat an alert count once.

    A payment counts as blocked, rejected or overridden if any of its rows has that state.
    """
    state = F.col("tx_status")
    states = transactions.where("tx_msg_id is not null").groupBy("tx_msg_id").agg(F.max(state.isin(*INTERDICTED)).alias("interdicted"), F.max(state == "BLOCKED").alias("blocked"), F.max(state == OVERRIDDEN).alias("overridden"))
    single = alerts.groupBy(F.to_date("created_at_ts").alias("metric_date"), "tx_msg_id", "alert_id").agg(F.max(F.col("alert_type_norm").isin(*AML_TYPES)).alias("aml"), F.max(F.col("alert_type_norm").isin(*FRAUD_TYPES)).alias("fraud"))
    payments = single.groupBy("metric_date", "tx_msg_id").agg(F.count("alert_id").alias("alerts"), F.max("aml").alias("aml"), F.max("fraud").alias("fraud"))
    known = F.col("tx_msg_id").isNotNull()
    alerts_of = lambda flag: F.sum(F.when(F.col(flag), F.col("alerts")).otherwise(0))
    days = payments.join(states, "tx_msg_id", "left").groupBy("metric_date").agg(
        F.count_if(known).alias("transactions_generated_alert"),
        F.sum("alerts").alias("total_alerts"),
        F.count_if(known & F.col("aml")).alias("aml_alert_transactions"),
        F.count_if(known & F.col("fraud")).alias("fraud_alert_transactions"),
        alerts_of("interdicted").alias("interdiction_alerts"),
        alerts_of("blocked").alias("block_condition_alerts"),
        F.count_if(known & F.col("blocked")).alias("blocked_transactions"),
        alerts_of("overridden").alias("override_alerts"),
        F.count_if(known & F.col("overridden")).alias("override_transactions"),
    )
    days = days.join(distinct_per_day(transactions, "ingested_at_ts", "tx_msg_id", "transactions_received"), "metric_date", "left")
    days = days.join(distinct_per_day(evaluated, "ingested_at_ts", "tx_msg_id", "transactions_evaluated"), "metric_date", "left").fillna(0, ["transactions_received", "transactions_evaluated"])
    rates = {
        "received_alert_rate_pct": ("transactions_generated_alert", "transactions_received"),
        "evaluated_alert_rate_pct": ("transactions_generated_alert", "transactions_evaluated"),
        "aml_alert_rate_pct": ("aml_alert_transactions", "transactions_evaluated"),
        "fraud_alert_rate_pct": ("fraud_alert_transactions", "transactions_evaluated"),
        "overall_interdiction_rate_pct": ("interdiction_alerts", "transactions_evaluated"),
        "block_condition_rate_pct": ("blocked_transactions", "transactions_evaluated"),
        "override_condition_rate_pct": ("override_transactions", "transactions_evaluated"),
        "override_rate_pct": ("override_transactions", "transactions_generated_alert"),
        "block_rate_pct": ("blocked_transactions", "transactions_generated_alert"),
    }
    days = days.withColumns({name: pct(*of) for name, of in rates.items()})
    return velocity(days, "metric_date", {"aml_alert_rate_pct": "aml_alert_velocity_pct_change", "fraud_alert_rate_pct": "fraud_alert_velocity_pct_change"})


def daily_case_metrics(cases: DataFrame, alerts: DataFrame, tasks: DataFrame) -> DataFrame:
    """Case metrics per day of creation: one conditional aggregate over cases that carry what their alerts and tasks say."""
    kind, status = F.col("alert_type_norm"), F.col("status")
    kinds = alerts.where("case_id is not null").groupBy("case_id").agg(*[F.max(kind == k).alias(n) for k, n in (("AML", "aml"), ("FRAUD", "fraud"), ("FRAUD_AND_AML", "mixed"))])
    work = tasks.where("case_id is not null").groupBy("case_id").agg(F.max(status == IN_PROGRESS).alias("investigated"))
    ended = status.like("%CLOSED%") | status.like("%COMPLETE%")
    again = F.col("has_parent_case") == 1
    took = F.when(F.col("created_to_updated_ms") > 0, F.col("created_to_updated_ms"))
    counts = {
        "total_cases_created": F.lit(True),
        "cases_from_alerts": F.col("case_creation_type") == AUTOMATIC,
        "manual_cases_created": F.col("case_creation_type") != AUTOMATIC,
        "auto_closed_cases": status.like("%CLOSED%") | status.like("%AUTO%"),
        "auto_closed_reopened": status.like("%CLOSED%") & again,
        "cases_reopened": again,
        "total_cases_closed": ended,
        "aml_cases": F.col("aml"),
        "fraud_cases": F.col("fraud"),
        "fraud_aml_cases": F.col("mixed"),
        "cases_with_open_investigations": F.col("investigated"),
        "confirmed_cases": status == CONFIRMED,
        "refuted_cases": status == REFUTED,
        "inconclusive_cases": status == INCONCLUSIVE,
        "cases_with_duration": took.isNotNull(),
        "cases_with_owner": F.col("case_owner_user_id").isNotNull(),
    }
    days = cases.join(kinds, "case_id", "left").join(work, "case_id", "left").groupBy(F.to_date("case_created_ts").alias("metric_date"))
    days = days.agg(*[F.count_if(test).alias(name) for name, test in counts.items()], (F.avg(took) / 3_600_000).alias("avg_mttd_hours"))
    open_tasks = tasks.groupBy(F.to_date("task_created_ts").alias("metric_date")).agg(F.count_if(F.col("is_completed") == 0).alias("open_tasks"))
    days = days.join(open_tasks, "metric_date", "left").fillna(0, ["open_tasks"])
    rates = {
        "manual_case_rate_pct": ("manual_cases_created", "total_cases_created"),
        "auto_closure_reopen_rate_pct": ("auto_closed_reopened", "auto_closed_cases"),
        "reopened_case_rate_pct": ("cases_reopened", "total_cases_closed"),
        "investigation_conversion_rate_pct": ("cases_with_open_investigations", "cases_from_alerts"),
        "confirmation_rate_pct": ("confirmed_cases", "total_cases_closed"),
    }
    return days.withColumns({name: pct(*of) for name, of in rates.items()} | {"avg_mttd_days": F.col("avg_mttd_hours") / 24})


def alert_payments(alerts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Alerts with the payment behind them: bridged by the status message's end-to-end id, else by their own id.

    Of several rows with one key the earliest with a known time counts, then the smallest id, state and amount.
    """
    age = F.struct(F.col("event_ts").isNull(), "event_ts", "transaction_id", "tx_status", "tx_amount", "end_to_end_id")
    messages = transactions.where("tx_msg_id is not null").groupBy(F.trim("tx_msg_id").alias("tx_msg_id")).agg(F.min_by(F.struct(F.trim("end_to_end_id").alias("e2e"), "tx_status", "event_ts"), age).alias("message"))
    payments = transactions.where(F.col("tx_type").isin(*PAYMENT_TYPES) & F.col("end_to_end_id").isNotNull()).groupBy(F.trim("end_to_end_id").alias("e2e")).agg(F.min_by(F.struct("tx_amount", "tx_status", "event_ts"), age).alias("payment"))
    rows = alerts.where("case_id is not null").select("case_id", "alert_type_norm", "prediction_outcome_norm", F.trim("tx_msg_id").alias("tx_msg_id"), F.trim("tx_original_e2e_id").alias("alert_e2e"), "tx_amount", "tx_status").distinct()
    # any of the keys may be missing in much of the alerts
    rows = left_join_known(rows, messages, "tx_msg_id").withColumn("bridge_e2e", F.col("message.e2e"))
    rows = left_join_known(rows, payments.select(F.col("e2e").alias("bridge_e2e"), F.col("payment").alias("bridged")), "bridge_e2e")
    rows = left_join_known(rows, payments.select(F.col("e2e").alias("alert_e2e"), F.col("payment").alias("direct")), "alert_e2e")
    return rows.select(
        "case_id", "alert_type_norm", "prediction_outcome_norm",
        F.coalesce("bridge_e2e", "alert_e2e").alias("payment_e2e"),
        F.coalesce("tx_amount", "bridged.tx_amount", "direct.tx_amount").alias("payment_amount"),
        F.upper(F.coalesce("tx_status", "bridged.tx_status", "direct.tx_status", "message.tx_status")).alias("payment_status"),
        F.coalesce("bridged.event_ts", "direct.event_ts", "message.event_ts").alias("payment_ts"),
    )


def _amount(test: Column | None = None) -> Column:
    """The payment's amount, 0 if unknown; the largest if alerts of one case disagree on one payment."""
    known = F.coalesce("payment_amount", F.lit(0.0))
    return F.max(known if test is None else F.when(test, known).otherwise(0.0))


def daily_fraud(cases: DataFrame, alerts: DataFrame, transactions: DataFrame, evaluated: DataFrame) -> DataFrame:
    """Confirmed and prevented fraud per day of the case, each payment of a case counted once and each case once.

    Days without confirmed cases are rows too. The lag is the mean over payments of confirmed cases.
    """
    rows = cases.join(alert_payments(alerts, transactions), "case_id", "left").withColumn("metric_date", F.to_date("case_created_ts"))
    outcome = F.col("prediction_outcome_norm")
    seconds = F.abs(F.unix_timestamp("case_created_ts") - F.unix_timestamp("payment_ts"))
    pairs = rows.groupBy("metric_date", "case_id", "payment_e2e").agg(
        F.max("status").alias("status"), F.max("case_creation_type").alias("case_creation_type"),
        *[F.max(outcome == o).alias(n) for o, n in (("TRUE_POSITIVE", "tp"), ("FALSE_POSITIVE", "fp"), ("FALSE_NEGATIVE", "fn"))],
        _amount().alias("amount"), _amount(F.col("payment_status").isin(*PREVENTED)).alias("prevented"), F.min(seconds).alias("lag"),
    )
    single = pairs.groupBy("metric_date", "case_id").agg(
        *[F.max(c).alias(c) for c in ("status", "case_creation_type", "tp", "fp", "fn")], *[F.sum(c).alias(c) for c in ("amount", "prevented", "lag")], F.count("lag").alias("lags")
    )
    confirmed = F.col("status") == CONFIRMED
    of_confirmed = lambda c: F.sum(F.when(confirmed, F.col(c)).otherwise(0))
    days = single.groupBy("metric_date").agg(
        F.count_if(confirmed).alias("confirmed_cases"), of_confirmed("amount").alias("confirmed_fraud_value"), of_confirmed("prevented").alias("prevented_fraud_value"),
        F.count_if(F.col("status") == REFUTED).alias("refuted_cases"), F.count_if(F.col("status") == INCONCLUSIVE).alias("inconclusive_cases"),
        F.count_if("tp").alias("true_positives"), F.count_if("fp").alias("false_positives"), F.count_if("fn").alias("false_negatives"),
        F.count_if(confirmed & (F.col("case_creation_type") != AUTOMATIC)).alias("manual_detected_fraud"),
        (F.sum(F.when(confirmed, F.col("lag"))) / F.nullif(F.sum(F.when(confirmed, F.col("lags")).otherwise(0)), F.lit(0)) / 3600).alias("avg_detection_lag_hours"),
    )
    days = days.join(distinct_per_day(alerts, "created_at_ts", "tx_msg_id", "transactions_with_alerts"), "metric_date", "left")
    days = days.join(distinct_per_day(evaluated, "ingested_at_ts", "tx_msg_id", "transactions_evaluated"), "metric_date", "left").fillna(0, ["transactions_with_alerts", "transactions_evaluated"])
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    return days.withColumns(
        {
            "precision": share(tp, tp + fp), "recall_tpr": share(tp, tp + fn), "f1_score": share(2 * tp, 2 * tp + fp + fn),
            "false_positive_rate_pct": pct("false_positives", "transactions_with_alerts"), "false_negative_rate_pct": pct("false_negatives", "transactions_evaluated"),
            "manual_detection_rate_pct": pct("manual_detected_fraud", "confirmed_cases"), "fraud_rate_pct": pct("confirmed_cases", "transactions_evaluated"),
            "avg_fraud_value": share(F.col("confirmed_fraud_value"), F.col("confirmed_cases")), "avg_detection_lag_days": F.col("avg_detection_lag_hours") / 24,
        }
    )


def daily_fraud_by_type(cases: DataFrame, alerts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Confirmed cases and value, refuted cases and their rate among the day's alerts, per day and type of alert."""
    keys = ["metric_date", "alert_type_norm"]
    rows = cases.join(alert_payments(alerts, transactions), "case_id").withColumn("metric_date", F.to_date("case_created_ts"))
    single = rows.groupBy(*keys, "case_id", "payment_e2e").agg(F.max("status").alias("status"), _amount().alias("amount")).groupBy(*keys, "case_id").agg(F.max("status").alias("status"), F.sum("amount").alias("amount"))
    confirmed = F.col("status") == CONFIRMED
    days = single.groupBy(*keys).agg(F.count_if(confirmed).alias("confirmed_by_typology"), F.sum(F.when(confirmed, F.col("amount")).otherwise(0.0)).alias("fraud_value_by_typology"), F.count_if(F.col("status") == REFUTED).alias("refuted_by_typology"))
    raised = alerts.select(F.to_date("created_at_ts").alias("metric_date"), "alert_type_norm", "alert_id").distinct().groupBy(*keys).agg(F.count("alert_id").alias("total_alerts_by_typology"))
    return days.join(raised, keys, "left").fillna(0, ["total_alerts_by_typology"]).withColumn("refuted_rate_pct", pct("refuted_by_typology", "total_alerts_by_typology"))


def investigation_tasks(tasks: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """Investigation tasks of the period by status, with those that file a suspicious-activity or -transaction report."""
    name = F.upper("task_name")
    rows = in_date_range(tasks.where("candidate_group = 'INVESTIGATIONS'"), "task_created_ts", start, end)
    single = rows.groupBy("status", "task_id").agg(F.max(name.contains("SAR") | name.contains("STR")).alias("report"))
    return single.groupBy("status").agg(F.count("task_id").alias("investigation_tasks"), F.count_if("report").alias("sar_str_filings"))


def investigation_flow(cases: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """One row: cases created in the period, and cases that were closed in it."""
    created = in_date_range(cases, "case_created_ts", start, end).agg(F.count("*").alias("investigations_created"))
    done = in_date_range(cases.where(closed(F.col("status"), "contains")), "case_updated_ts", start, end).agg(F.count("*").alias("investigations_closed"))
    return created.crossJoin(done)  # a row each


def in_periods(df: DataFrame, ts: str, current: tuple[date, date], previous: tuple[date, date]) -> DataFrame:
    """Rows of either period with ``period``; one scan, its filter a range of timestamps."""
    day = F.to_date(ts)
    label = F.when(day.between(*[F.lit(d) for d in current]), "current").when(day.between(*[F.lit(d) for d in previous]), "previous")
    rows = in_date_range(df, ts, min(current[0], previous[0]), max(current[1], previous[1]))
    return rows.withColumn("period", label).where("period is not null")


def alert_periods(alerts: DataFrame, cases: DataFrame, transactions: DataFrame, current: tuple[date, date], previous: tuple[date, date]) -> DataFrame:
    """A row per period: alerts, payments with an alert among all, and alerts that close without a person.

    Of those, alerts count whose case was created in the same period.
    """
    rows = in_periods(alerts, "created_at_ts", current, previous)
    totals = rows.groupBy("period").agg(F.count("*").alias("total_alerts"))
    payments = rows.select("period", "tx_msg_id").distinct().groupBy("period").agg(F.count("tx_msg_id").alias("tx_with_alerts"))
    own = in_periods(cases, "case_created_ts", current, previous).select("period", "case_id").distinct()
    auto = rows.where(auto_closed()).join(own, ["period", "case_id"], "left_semi").select("period", "alert_id").distinct().groupBy("period").agg(F.count("*").alias("auto_closed"))
    received = in_periods(transactions, "ingested_at_ts", current, previous).groupBy("period").agg(F.count("*").alias("tx_evaluated"))
    out = totals.join(payments, "period", "left").join(auto, "period", "left").join(received, "period", "left").fillna(0)
    return out.withColumns({"evaluated_alert_rate_pct": pct("tx_with_alerts", "tx_evaluated"), "auto_closure_rate_pct": pct("auto_closed", "total_alerts")})


def investigation_periods(cases: DataFrame, tasks: DataFrame, current: tuple[date, date], previous: tuple[date, date]) -> DataFrame:
    """A row per period: open tasks, investigations created and open, conversion of automatic cases, confirmation of closed ones."""
    status, investigates, waits = F.col("status"), F.col("candidate_group").like("%INVEST%"), F.col("is_completed") == 0
    single = in_periods(tasks, "task_created_ts", current, previous).groupBy("period", "case_id").agg(F.count_if(waits).alias("tasks"), F.max(investigates).alias("investigates"), F.max(investigates & waits).alias("waits"))
    known = F.col("case_id").isNotNull()
    work = single.groupBy("period").agg(F.sum("tasks").alias("open_tasks"), F.count_if(known & F.col("investigates")).alias("investigations_created"), F.count_if(known & F.col("waits")).alias("open_investigations"))
    made = in_periods(cases, "case_created_ts", current, previous).groupBy("period").agg(
        F.count_if(F.col("case_creation_type") == AUTOMATIC).alias("cases_from_alerts"), F.count_if(status == CONFIRMED).alias("confirmed_cases"), F.count_if(closed(status, "like")).alias("closed_cases")
    )
    out = made.join(work, "period", "full").fillna(0)
    return out.withColumns({"investigation_conversion_rate_pct": pct("open_investigations", "cases_from_alerts"), "confirmation_rate_pct": pct("confirmed_cases", "closed_cases")})


def typology_metrics(alerts: DataFrame, cases: DataFrame) -> DataFrame:
    """A row per type of alert: cases open and closed, alerts, hours to disposition, confirmation and false-positive rates.

    All types at once. A case with alerts of several types counts for each of them.
    """
    done, took = F.coalesce(closed(F.col("status"), "like"), F.lit(False)), F.col("created_to_updated_ms")
    linked = alerts.where("case_id is not null").select("alert_type_norm", "case_id").distinct().join(cases, "case_id")
    per_case = linked.groupBy("alert_type_norm").agg(
        F.count("*").alias("total_cases"), F.count_if(~done).alias("open_cases"), F.count_if(done).alias("closed_cases"), F.count_if(F.col("status") == CONFIRMED).alias("confirmed_cases"),
        (F.avg(F.when(done & (took > 0), took)) / 3_600_000).alias("mttd_hours"),
    )
    single = alerts.groupBy("alert_type_norm", "alert_id").agg(F.max(F.col("prediction_outcome_norm") == "FALSE_POSITIVE").alias("false"))
    per_alert = single.groupBy("alert_type_norm").agg(F.count("alert_id").alias("alert_count"), F.count_if("false").alias("false_positives"))
    out = per_alert.join(per_case, "alert_type_norm", "left").fillna(0, ["total_cases", "open_cases", "closed_cases", "confirmed_cases"])
    return out.withColumns({"confirmation_rate_pct": pct("confirmed_cases", "closed_cases"), "false_positive_rate_pct": pct("false_positives", "alert_count")})


def supervisor(cases: DataFrame, tasks: DataFrame, now: Column, start: date | None = None, end: date | None = None) -> dict[str, DataFrame]:
    """What a supervisor's page shows, by name; nothing runs before a frame is used."""
    return {
        "inventory": case_inventory(cases, "status"),
        "workload": task_workload(tasks, "assigned_user_id"),
        "investigation_tasks": investigation_tasks(tasks, start, end),
        "investigation_flow": investigation_flow(cases, start, end),
        "ages": case_ages(cases, now, "case_created_ts", ~F.coalesce(closed(F.col("status"), "like"), F.lit(False))),
    }


def purpose_codes(alerts: DataFrame, payments: DataFrame) -> DataFrame:
    """The purpose code of the payment behind each alert, by tenant and end-to-end id; null without a payment.

    Of several payments with one id the earliest counts, then the smallest code.
    """
    keys = ["tenant_id", "end_to_end_id"]
    single = payments.groupBy(*keys).agg(F.min_by("purp_cd", F.struct(F.col("event_ts").isNull(), "event_ts", "purp_cd")).alias("purp_cd"))
    return alerts.join(single, keys, "left")
