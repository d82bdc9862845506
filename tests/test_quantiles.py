"""Discrete quantiles are exact in groups larger than the summaries of approximate ones."""

import math

from pyspark.sql import functions as F

from tidemark.operators import quantiles
from tidemark.plans import calibration, calibration_queries, metrics


def exact(values, p100):
    """The least value with ``p100`` per cent of the values up to it, in whole numbers."""
    values = sorted(values)
    return values[max(1, -(-len(values) * p100 // 100)) - 1]


def numbers(spark, n, *columns):
    """``v`` runs through 0 to n - 1 in a mixed order (7919 and n share no factor)."""
    return spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("v"), *columns)


def test_quantiles_of_groups_and_slices(spark):
    rows = numbers(spark, 30_000, (F.col("id") % 3).alias("k"))
    rows = rows.unionByName(rows.limit(5).withColumn("v", F.lit(None).cast("double"))).withColumn("k", F.nullif("k", F.lit(2)))
    found = {}
    for r in rows.collect():
        if r["v"] is not None:
            found.setdefault(r["k"], []).append(r["v"])
    want = {(k, exact(v, 50), exact(v, 99)) for k, v in found.items()}
    for slice_ in (None, lambda v: F.floor(v / 1000)):
        got = quantiles.discrete_quantiles(rows, ["k"], "v", {"median": 0.5, "p99": 0.99}, slice_)
        assert {tuple(r) for r in got.collect()} == want


def test_places_are_whole_numbers(spark):
    n = [1, 2, 3, 7, 99, 100, 101, 700, 12_300, 3_600_000_000]
    frame = spark.createDataFrame([(x,) for x in n], "n long")
    for p in (0.07, 0.29, 0.5, 0.95, 0.99):
        hundredths = round(p * 100)
        assert [r[0] for r in frame.select(quantiles.place(p, F.col("n"))).collect()] == [max(1, -(-x * hundredths // 100)) for x in n]


def test_latency_rollup_of_a_large_day(spark, tmp_path):
    """60,000 different values and users of one day."""
    n = 60_000
    rows = numbers(spark, n, F.lit("view").alias("event_type"), F.lit("2024-01-01 10:00:00").cast("timestamp").alias("ts")).withColumnRenamed("v", "value").withColumn("user_id", F.col("value").cast("long"))
    rows.write.parquet(str(tmp_path / "events.parquet"))
    r = calibration_queries.met_13_latency_rollup(spark, str(tmp_path)).collect()
    assert [(x["n"], x["p95"], x["p99"], x["users"]) for x in r] == [(n, exact(range(n), 95), exact(range(n), 99), n)]


def test_p99_of_a_large_hour(spark):
    """more rows in an hour than an approximate percentile keeps apart."""
    n = 200_000
    rows = numbers(spark, n, F.lit("2024-01-01 10:00:00").cast("timestamp").alias("ts"))
    r = metrics.throughput(rows, "ts", rows, "ts", "hour", "v").first()
    assert (r["p99_latency"], r["p95_latency"]) == (exact(range(n), 99), 0.95 * (n - 1))


def test_scores_of_a_large_typology(spark):
    """scores of one typology and tenant, with more values than an approximate percentile keeps apart."""
    n = 100_000
    text = lambda v: F.lit(v).alias
    results = numbers(spark, n).select(
        F.col("v").cast("long").alias("alert_id"), text("t")("tenant_id"), text("typ")("typology_id"), text("1")("typology_cfg"), F.col("v").cast("long").alias("typology_score"), text("r")("rule_id"), text("1")("rule_cfg"), F.lit(1).alias("current_rule_weight"),
        text("TRUE_POSITIVE")("prediction_outcome"), F.lit("2024-01-01").cast("timestamp").alias("created_at_ts"), text("m")("alert_tx_msg_id"), text("e")("tx_original_end_to_end_id"), text("b")("tx_instg_agent"), text("b")("tx_instd_agent"),
    )
    transactions = spark.range(1).select(text("m")("tx_msg_id"), text("e")("end_to_end_id"), text("pacs.008")("tx_type"), F.lit(5.0).alias("tx_amount"), text("b")("instg_mmb_id"), text("b")("instd_mmb_id"), F.lit(0).alias("charge_count"), F.lit("2024-01-01").cast("timestamp").alias("event_ts"))
    typologies = spark.range(1).select(text("typ")("typology_id"), text("1")("typology_cfg"), F.lit(1).alias("config_alert_threshold"), F.lit(2).alias("config_interdiction_threshold"), F.lit(1).alias("rule_count"))
    rules = spark.range(1).select(text("r")("rule_id"), text("1")("rule_cfg"), F.lit(1).alias("band_count"), F.lit(1).alias("exit_condition_count"))
    names = [f"typology_{q}_score" for q in ("p25", "median", "p75", "p90")]
    got = calibration.calibration_set(results, transactions, typologies, rules).select(*names).distinct().collect()
    assert [tuple(r) for r in got] == [tuple(exact(range(n), p) for p in (25, 50, 75, 90))]


def test_cuts_of_a_large_feature(spark):
    """thresholds over more rows than the summary of a million had room for."""
    n = 3_000_000
    cuts = calibration._cuts(numbers(spark, n, F.lit(1.0).alias("flat")), ["v", "flat"], (0.5, 0.9, 0.98))
    assert cuts == {"v": [float(math.ceil(n * p / 100) - 1) for p in (50, 90, 98)], "flat": []}
