"""pairs of intervals and points are found in as many tasks as there are pairs for, each once."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators import joins
from tidemark.plans import views

DAY = datetime(2024, 1, 31)


def test_blocks_of_pairs(spark, monkeypatch):
    monkeypatch.setattr(joins, "BLOCK_ROWS", 7)
    monkeypatch.setattr(joins, "TASK_PAIRS", 200)
    conds = [(f"c{i}", "T" if i % 3 else "U", DAY + timedelta(hours=i * 11), None if i % 4 == 0 else DAY + timedelta(hours=i * 11 + (i % 5) * 30), "a,b" if i % 2 else None) for i in range(60)] + [("late", "T", DAY + timedelta(days=900), None, None), ("none", "V", DAY, None, None), ("back", "T", DAY, DAY - timedelta(days=1), None)]
    tx = [("T" if i % 2 else "U", f"t{i}", "abx"[i % 3], DAY + timedelta(hours=i * 7 - 100), 1.0) for i in range(120)]
    c = spark.createDataFrame(conds, "pk string, tenant_id string, condition_inception_ts timestamp, condition_expiry_ts timestamp, event_types_csv string").withColumn("name", F.col("pk"))
    t = spark.createDataFrame(tx, "tenant_id string, transaction_id string, tx_type string, tx_event_ts timestamp, instructed_amount double")
    out = views.conditions_timeline(c, t)
    got = [tuple(r) for r in out.select("name", "bucket_granularity", "transaction_id").collect()]
    kept = {"day": lambda x: x.date(), "week": lambda x: x.isocalendar()[:2], "month": lambda x: (x.year, x.month), "year": lambda x: x.year, "all": lambda x: 0}
    want = []
    for name, tenant, start, end, kinds in conds:
        for grain, of in kept.items():
            found = [i for u, i, kind, at, _ in tx if u == tenant and start <= at and (end is None or at <= end) and of(at) == of(start) and (kinds is None or kind in kinds)]
            want += [(name, grain, i) for i in found or [None]]
    assert sorted(got, key=str) == sorted(want, key=str)
    tasks = {r[0] for r in out.where("transaction_id is not null").select(F.spark_partition_id()).collect()}
    assert len(tasks) > int(spark.conf.get("spark.sql.shuffle.partitions"))
