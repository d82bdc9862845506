"""Rows without a key match nothing and do not meet in one task."""

from pyspark.sql import functions as F

from tidemark.operators import joins
from tidemark.plans import executive, typologies


def conf(spark, monkeypatch, **settings):
    for k, v in settings.items():
        k = k.replace("__", ".")
        before = spark.conf.get(k)
        spark.conf.set(k, v)
        monkeypatch.setattr(spark, "_restore", [*getattr(spark, "_restore", []), (k, before)], raising=False)


def restored(spark):
    for k, v in spark._restore:
        spark.conf.set(k, v)


def shares(df):
    """Rows of the largest task, and all rows."""
    n = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(n), sum(n)


def test_rows_without_a_key(spark, monkeypatch):
    df = spark.range(4000).select(F.when(F.col("id") % 4 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.createDataFrame([(0, "a"), (8, "b"), (8, "c"), (None, "d"), (5, "e")], "k long, w string")
    conf(spark, monkeypatch, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="4")
    try:
        out = joins.left_join_known(df, right, "k")
        assert sorted(out.columns) == ["k", "v", "w"]
        got = {tuple(r) for r in out.select("k", "v", "w").collect()}
        assert got == {tuple(r) for r in df.join(right, "k", "left").select("k", "v", "w").collect()} and len(got) == 4001
        most, rows = shares(out)
        assert rows == 4001 and most < 1500
    finally:
        restored(spark)


def test_alerts_without_a_message(spark, monkeypatch):
    none = F.when(F.col("id") < 0, F.lit("x"))
    alerts = spark.range(4000).select(
        F.col("id").alias("case_id"), none.alias("tx_msg_id"), none.alias("tx_original_e2e_id"), F.lit("AML").alias("alert_type_norm"), F.lit("TRUE_POSITIVE").alias("prediction_outcome_norm"), F.lit(1.0).alias("tx_amount"), F.lit("RJCT").alias("tx_status")
    )
    payments = spark.createDataFrame([("1", "m", "x", "pacs.008.001.10", "ACCC", 5.0, None)], "transaction_id string, tx_msg_id string, end_to_end_id string, tx_type string, tx_status string, tx_amount double, event_ts timestamp")
    conf(spark, monkeypatch, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="4")
    try:
        most, rows = shares(executive.alert_payments(alerts, payments))
        assert rows == 4000 and most < 1500
        assert "_apart" in typologies.per_case(alerts, payments)._jdf.queryExecution().executedPlan().toString()
    finally:
        restored(spark)


def test_tasks_grow_with_the_table(spark, monkeypatch):
    """F16: rows are dealt among as many tasks as they need, and left alone where the session's partitions do."""
    monkeypatch.setattr(joins, "TASK_ROWS", 100)
    df = spark.range(1000).select(F.col("id").alias("k"))
    assert joins.spread(df, 400, "k") is df
    dealt = joins.spread(df, 1000, "k")
    assert dealt.rdd.getNumPartitions() == 10 and {r["k"] for r in dealt.collect()} == set(range(1000))
