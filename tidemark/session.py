"""Session settings that the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "tidemark", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ANSI mode stays on, so expressions handle nulls and bad casts themselves."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app).config(map=settings)
    return (builder.master(master) if master else builder).getOrCreate()
