"""edges are summed before they are spread over granularities, and buckets of one sum are not summed again."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates

START = {
    "hour": lambda t: t.replace(minute=0, second=0), "day": lambda t: t.replace(hour=0, minute=0, second=0), "week": lambda t: (t - timedelta(days=t.weekday())).replace(hour=0, minute=0, second=0),
    "month": lambda t: t.replace(day=1, hour=0, minute=0, second=0), "year": lambda t: t.replace(month=1, day=1, hour=0, minute=0, second=0), "all": lambda t: datetime(1970, 1, 1),
}


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    out = [(rnd.choice(["t", None]), rnd.randint(0, 9), rnd.randint(0, 9), datetime(2020, 12, 20) + timedelta(hours=rnd.randint(0, 1500)), float(rnd.randint(1, 99)), rnd.choice(["EUR", "CHF", None]), rnd.randint(0, 1)) for _ in range(700)]
    out += [("t", 1, 2, datetime(2021, 1, 1) + timedelta(hours=i), 1.0, "EUR", 0) for i in range(300)]
    return out + [("t", 1, 2, None, 5.0, "USD", 1), ("t", 50, 51, None, None, None, 0), ("t", None, 2, datetime(2021, 1, 1), 1.0, "EUR", 0)]


KIND = "k string, a int, b int, ts timestamp, x double, cur string, hit int"


@pytest.mark.parametrize("grains", [("day", "week", "month", "year"), ("hour", "day", "all"), ("month", "week")])
def test_edges_equal_their_definition(spark, rows, grains):
    want = defaultdict(list)
    for r in rows:
        for g in grains:
            want[(r[0], g, datetime(1970, 1, 1) if g == "all" else r[3] and START[g](r[3]), r[1], r[2])].append(r)
    out = aggregates.edges(spark.createDataFrame(rows, KIND), "a", "b", "ts", "x", grains, ["k"], ["hit"], "cur").collect()
    assert len(out) == len(want) and out[0].__fields__[:6] == ["k", "bucket_granularity", "bucket_start", "from_a", "to_b", "tx_count"]
    for r in out:
        of = want[(r["k"], r["bucket_granularity"], r["bucket_start"], r["from_a"], r["to_b"])]
        times, names = [x[3] for x in of if x[3]], [x[5] for x in of if x[5]]
        assert r["tx_count"] == len(of) and r["total_amount"] == sum(x[4] or 0 for x in of) and r["hit_edge"] == max(x[6] for x in of)
        assert r["currency_hint"] == max(names, default=None) and (r["first_event_ts"], r["last_event_ts"]) == (min(times, default=None), max(times, default=None))


def test_rows_are_summed_before_they_are_spread(spark, rows):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = aggregates.edges(spark.createDataFrame(rows, KIND), "a", "b", "ts", "x", currency="cur")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.rindex("Generate") < plan.rindex("Exchange hashpartitioning")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
