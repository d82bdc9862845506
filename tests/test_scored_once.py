"""rows are scored once, not again by each job that reads the scores."""

from pyspark.sql import functions as F

from tidemark.plans import missed


def test_scores_are_read(spark):
    df = spark.range(300).select("id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"), (F.col("id") % 17 > 9).cast("int").alias("y"))
    out = missed.hidden_typologies(df, "id", ["a", "b"], "y", F.col("y") == 1, trees=2, depth=2)
    assert "MapInArrow" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r["id"] for r in out.collect()} == {i for i in range(300) if i % 17 > 9}
