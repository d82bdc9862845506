"""Date ranges, changes and the small readers that no query needs."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators import aggregates
from tidemark.sources import readers, sinks

TODAY = date(2024, 3, 15)


def test_ranges():
    start, end = times.resolve_date_range("LAST_30_DAYS", TODAY)
    assert end == TODAY and (end - start).days in (29, 30)
    assert times.resolve_date_range("CUSTOM", TODAY, date(2024, 1, 1), date(2024, 1, 31)) == (date(2024, 1, 1), date(2024, 1, 31))
    before = times.previous_range(date(2024, 1, 11), date(2024, 1, 20))
    assert before[1] < date(2024, 1, 11) and (before[1] - before[0]).days == 9
    with pytest.raises(ValueError):
        times.resolve_date_range("NO_SUCH_PERIOD", TODAY)


def test_changes(spark):
    rows = spark.createDataFrame([(10, 5), (5, 10), (1, 0), (1, None), (100, 99)], "now int, before int")
    out = rows.select(times.pct_change(F.col("now"), F.col("before")).alias("c"), times.trend(F.col("now"), F.col("before"), 5.0).alias("t")).collect()
    assert [(r["c"], r["t"]) for r in out][:4] == [(100.0, "up"), (-50.0, "down"), (0.0, "flat"), (0.0, "flat")] and out[4]["t"] == "flat"


def test_histogram_and_models(spark, tmp_path):
    rows = spark.createDataFrame([(i,) for i in range(10)], "x int")
    assert {r["bucket"]: r[1] for r in aggregates.histogram(rows, F.col("x") % 3).collect()} == {0: 4, 1: 3, 2: 3}
    from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler

    data = VectorAssembler(inputCols=["x"], outputCol="v").transform(rows)
    model = StandardScaler(inputCol="v", outputCol="s", withMean=True).fit(data)
    for _ in range(2):  # in place of an earlier one
        sinks.save_model(model, str(tmp_path / "m"))
    assert StandardScalerModel.load(str(tmp_path / "m")).mean[0] == 4.5


def test_settings_and_pending_documents(spark):
    assert readers.s3a_settings("http://store:9000")["spark.hadoop.fs.s3a.path.style.access"] == "true"
    schema = "_id string, processingStatus string, archive boolean, _attachments map<string,string>, metadata array<string>, uploadedAt int"
    rows = [("a", None, None, {"f": "x"}, ["m"], 3), ("b", "COMPLETED", False, {"f": "x"}, ["m"], 1), ("c", "ERROR", False, {"f": "x"}, ["m"], 2), ("d", "PENDING", True, {"f": "x"}, ["m"], 1), ("e", "PENDING", False, {}, ["m"], 1), ("f", "PENDING", False, {"f": "x"}, [], 1)]
    assert [r["_id"] for r in readers.pending_documents(spark.createDataFrame(rows, schema)).collect()] == ["c", "a"]
