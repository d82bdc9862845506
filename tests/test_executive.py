"""Executive metrics on a handful of rows, nulls and repeats included."""

from datetime import date

import pytest
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators import windows
from tidemark.plans import executive
from tidemark.sources import sinks

ALERT = "alert_id STRING, case_id LONG, tx_msg_id STRING, tx_original_e2e_id STRING, alert_type_norm STRING, prediction_outcome_norm STRING, tx_amount DOUBLE, tx_status STRING, created STRING"
PAYMENT = "transaction_id LONG, tx_msg_id STRING, end_to_end_id STRING, tx_type STRING, tx_status STRING, tx_amount DOUBLE, at STRING"
CASE = "case_id LONG, status STRING, case_creation_type STRING, made STRING"
PAY, STATE = "pacs.008.001.10", "pacs.002.001.12"


def tables(spark, alerts=(), payments=(), cases=()):
    a = spark.createDataFrame(list(alerts), ALERT).withColumn("created_at_ts", F.col("created").cast("timestamp"))
    p = spark.createDataFrame(list(payments), PAYMENT).withColumns({"event_ts": F.col("at").cast("timestamp"), "ingested_at_ts": F.col("at").cast("timestamp")})
    return a, p, spark.createDataFrame(list(cases), CASE).withColumn("case_created_ts", F.col("made").cast("timestamp"))


def test_alert_day_counts_repeats_and_nulls(spark):
    alerts, payments, _ = tables(
        spark,
        [("a", 1, "m", None, "AML", None, None, None, "2024-01-01"), ("a", 1, "m", None, "AML", None, None, None, "2024-01-01"), ("b", 1, None, None, None, None, None, None, "2024-01-01"), ("c", 2, "n", None, "FRAUD", None, None, None, "2024-01-02")],
        [(1, "m", "e", PAY, "BLOCKED", 5.0, "2024-01-01"), (2, "m", "e", STATE, "ACCC", None, "2024-01-01"), (3, None, None, None, None, None, "2024-01-01")],
    )
    first, second = executive.daily_alerts(alerts, payments, payments).orderBy("metric_date").collect()
    assert (first.total_alerts, first.transactions_generated_alert, first.blocked_transactions, first.override_transactions) == (2, 1, 1, 1)
    assert first.aml_alert_rate_pct == 100 and first.aml_alert_velocity_pct_change is None
    assert second.transactions_evaluated == 0 and second.fraud_alert_rate_pct == 0 and second.aml_alert_velocity_pct_change == -100


def test_fraud_bridge(spark):
    alerts, payments, cases = tables(
        spark,
        [("a", 1, "s", None, "FRAUD", "TRUE_POSITIVE", None, None, "2024-01-01"), ("b", 1, "s", None, "FRAUD", "TRUE_POSITIVE", None, None, "2024-01-01"), ("c", 2, None, "e2", "FRAUD", "FALSE_POSITIVE", 7.0, None, "2024-01-01")],
        [(1, " s ", "e1", STATE, "RJCT", None, "2024-01-01"), (2, "p", "e1", PAY, None, 10.0, "2024-01-01 06:00:00"), (3, "q", "e1", PAY, None, 99.0, "2024-01-01 07:00:00"), (4, "r", "e2", PAY, "ACCC", 3.0, None)],
        [(1, executive.CONFIRMED, "MANUAL", "2024-01-02 06:00:00"), (2, executive.CONFIRMED, "AUTOMATIC_SYSTEM", "2024-01-02"), (3, executive.REFUTED, None, "2024-01-02")],
    )
    (day,) = executive.daily_fraud(cases, alerts, payments, payments).collect()
    assert (day.confirmed_cases, day.confirmed_fraud_value, day.prevented_fraud_value, day.refuted_cases) == (2, 17.0, 10.0, 1)
    assert (day.true_positives, day.false_positives, day.precision, day.manual_detection_rate_pct, day.avg_detection_lag_hours) == (1, 1, 0.5, 50.0, 24.0)
    (kind,) = executive.daily_fraud_by_type(cases, alerts, payments).collect()
    assert (kind.confirmed_by_typology, kind.fraud_value_by_typology, kind.refuted_by_typology) == (2, 17.0, 0)


def test_empty_tables(spark):
    alerts, payments, cases = tables(spark)
    periods = (date(2024, 1, 1), date(2024, 1, 31)), (date(2023, 12, 1), date(2023, 12, 31))
    for df in (executive.daily_alerts(alerts, payments, payments), executive.daily_fraud(cases, alerts, payments, payments), executive.daily_fraud_by_type(cases, alerts, payments), executive.alert_periods(alerts, cases, payments, *periods)):
        assert df.collect() == []


def test_most_recent(spark):
    df = spark.createDataFrame([(1, "b"), (2, "c"), (3, None), (4, "c")], "id INT, made STRING")
    assert [r.id for r in windows.most_recent(df, ["updated", "made"], 3, ["id"]).collect()] == [2, 4, 1]
    assert [r.id for r in windows.most_recent(df, ["updated"], 2, ["id"]).collect()] == [1, 2]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "n INT, k STRING")
    with pytest.raises(ValueError, match="mode"):
        sinks.write_metric(df, str(tmp_path), "m", "ignore")
    for _ in range(2):
        sinks.write_metric(df, str(tmp_path), "m", "append", ["k"])
    assert spark.read.parquet(f"{tmp_path}/m").count() == 2
    rows = spark.createDataFrame([(Vectors.dense(float(i)), float(i > 2)) for i in range(6)], ["features", "label"])
    model = LogisticRegression(maxIter=5).fit(rows)
    for _ in range(2):
        sinks.save_model(model, f"{tmp_path}/model")
    assert LogisticRegressionModel.load(f"{tmp_path}/model").coefficients == model.coefficients
