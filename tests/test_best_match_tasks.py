"""rows of a few keys are matched in as many tasks as they need, and so are orders with their items."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins
from tidemark.plans import table_queries


@pytest.fixture
def plain_tasks(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 400)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "4"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rows_of_a_few_keys(spark, plain_tasks):
    n = 8000
    rule = F.when(F.col("id") % 4 < 3, F.lit("a")).when(F.col("id") % 4 == 3, F.when(F.col("id") % 8 == 3, F.lit("b")))
    df = spark.range(n).select(F.col("id").alias("row"), rule.alias("rule"), F.lit("1").alias("cfg"), F.when(F.col("id") % 3 == 0, F.lit("T")).otherwise("U").alias("tenant"))
    config = spark.createDataFrame([("DEFAULT", "a", "1", "dflt"), ("T", "a", "1", "own2"), ("T", "a", "1", "own1"), ("T", "b", "1", "b of T"), ("T", "b", "2", "other"), ("T", None, "1", "none")], "tenant string, rule string, cfg string, name string")
    want = {}
    for i in range(n):
        key, own = "a" if i % 4 < 3 else "b" if i % 8 == 3 else None, i % 3 == 0
        want[i] = (0, "own1") if key == "a" and own else (1, "dflt") if key == "a" else (0, "b of T") if key == "b" and own else (2, None)
    for row_key in (["row", "rule", "cfg"], ["row"]):
        out = joins.best_match(df, config, ["rule", "cfg"], "tenant", row_key, [F.col("_c_name")])
        assert out.columns == ["row", "rule", "cfg", "tenant", "match_rank", "name"]
        got = out.select("*", F.spark_partition_id().alias("p")).collect()
        assert len(got) == n and {r["row"]: (r["match_rank"], r["name"]) for r in got} == want
        tasks = [sum(r["p"] == p for r in got) for p in {r["p"] for r in got}]
        assert max(tasks) < 1200


def test_orders_with_items(spark, sf, plain_tasks):
    out = table_queries._with_items(spark, sf)
    assert out.rdd.getNumPartitions() == 15
    items = out.select(F.explode("items").alias("i"), "o_orderkey").select("o_orderkey", "i.l_linenumber")
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").join(spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", "l_linenumber")
    assert items.exceptAll(lines).count() == 0 and lines.exceptAll(items).count() == 0 and lines.count() > 0
