"""trees are fitted on counts of rows with the same bins; rows with repeated ids come back once each."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidemark.operators import graphs
from tidemark.plans import missed


def rows(spark, n, parts):
    near = F.pmod(F.xxhash64("id"), F.lit(9))
    out = spark.range(0, n, 1, parts).select("id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5 - 2.0).alias("b"), near.cast("double").alias("c"))
    return out.withColumn("y", ((F.col("a") + F.col("b") * F.col("c") > 8) | (F.xxhash64("c", "id") % 11 == 0)).cast("int"))


def margins(model, df):
    return {r["id"]: r["rawPrediction"][1] for r in model.transform(VectorAssembler(inputCols=["a", "b", "c"], outputCol="_x").transform(df)).select("id", "rawPrediction").collect()}


def test_counts_fit_as_rows_do(spark, monkeypatch):
    df, seen, fit = rows(spark, 5000, 3), [], GBTClassifier.fit
    plain = GBTClassifier(featuresCol="_x", labelCol="_l", maxIter=4, maxDepth=3, seed=42).fit(VectorAssembler(inputCols=["a", "b", "c"], outputCol="_x").transform(df.withColumn("_l", F.col("y").cast("double"))))
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, data: seen.append(data.count()) or fit(self, data))
    model = missed.fit_boosted(df, ["a", "b", "c"], "y", trees=4, depth=3)
    assert seen == [df.select("a", "b", "c", "y").distinct().count()] and seen[0] < 5000
    assert margins(model, df) == pytest.approx(margins(plain, df), abs=1e-9)
    trees = missed.structure(model)
    assert {(t.feature[i], t.threshold[i]) for t in trees for i in range(len(t.left)) if t.left[i] >= 0} <= {(f, float(v)) for f, values in enumerate((range(16), range(-2, 2), range(8))) for v in values}


def test_all_rows_tell_the_bins(spark):
    # a sample of these rows depends on how they are dealt
    found = []
    for parts in (2, 7):
        df = rows(spark, 30_000, parts).withColumn("a", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_003)).cast("double"))
        model = missed.fit_boosted(df, ["a", "b", "c"], "y", trees=1, depth=2)
        found.append((model.cuts, [(t.feature, t.threshold, t.left) for t in missed.structure(model)]))
    assert found[0] == found[1]
    a = np.sort([r[0] for r in df.select("a").collect()])
    assert found[0][0] == [sorted({float(a[-(-k * len(a) // 32) - 1]) for k in range(1, 32)}), [-2.0, -1.0, 0.0, 1.0], [float(v) for v in range(8)]]


def test_a_row_for_each_point(spark):
    # ids are repeated in both clusters and outside
    points = [(k % 3, [x + k * 0.01, 0.0], k) for x in (0.0, 10.0) for k in range(6)] + [(0, [50.0, 0.0], 99), (1, [50.0, 9.0], 98)]
    out = graphs.density_clusters(spark.createDataFrame(points, "id long, v array<double>, place int"), "id", "v", 0.5, keep=("place",)).collect()
    assert sorted((r["id"], r["place"]) for r in out) == sorted((i, p) for i, _, p in points)
    assert sorted((r["cluster"], r["id"]) for r in out) == sorted([(0, k % 3) for k in range(6)] + [(3, k % 3) for k in range(6)] + [(-1, 0), (-1, 1)])


def test_missed_rows_are_not_repeated(spark):
    df = rows(spark, 600, 2).withColumn("id", F.col("id") % 50)
    out = missed.hidden_typologies(df, "id", ["a", "b", "c"], "y", F.col("y") == 1, trees=2, depth=2)
    assert out.columns == ["id", "margin", "top_driver", "cluster", "confidence", "typology"] and out.count() == df.where("y = 1").count()
