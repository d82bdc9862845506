"""Scans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import with_timestamps
from tidemark.operators.columns import for_tenant
from tidemark.operators.windows import latest_per_key

#: Path parts that never name a table.
_LAYERS = ("bronze", "silver", "gold", "views", "raw")


def parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with zone-less timestamps normalised."""
    return with_timestamps(spark.read.parquet(path))


def json_objects(spark: SparkSession, path: str, schema=None, lineage: bool = True) -> DataFrame:
    """JSON lines with a declared schema (inferred only if none is given), with load time and file."""
    df = (spark.read.schema(schema) if schema is not None else spark.read).json(path)
    return df.withColumns({"ingested_at_ts": F.current_timestamp(), "source_file_path": F.col("_metadata.file_path")}) if lineage else df


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, through the Hadoop file system that serves it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None if there is none. Other errors stay errors."""
    return parquet(spark, path) if exists(spark, path) else None


def tenant_scan(spark: SparkSession, path: str, tenant: str) -> DataFrame:
    return for_tenant(parquet(spark, path), tenant)


def latest_version(df: DataFrame, key: str, order: list[Column] | None = None) -> DataFrame:
    """The newest row per key by commit time and sequence."""
    return latest_per_key(df, [key], order or [F.desc("_commit_time"), F.desc("_commit_seqno")])


def jdbc_increment(spark: SparkSession, url: str, table: str, watermark: str, since, options: dict[str, str] | None = None) -> DataFrame:
    """Rows of a database table behind a high-water mark; the filter is pushed to the database."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **(options or {})).load().where(F.col(watermark) > F.lit(since))


def stored_offset(spark: SparkSession, log: str, kind: str):
    """The last committed high-water mark of a log of offsets, as a value of a SQL type; None before the first."""
    if not exists(spark, log):
        return None
    rows = spark.read.schema("number long, upto string").json(log)
    last = rows.agg(F.max_by("upto", "number").alias("upto")).first()["upto"]  # one row a batch
    return spark.range(1).select(F.lit(last).cast(kind)).first()[0]


def jdbc_batch(spark: SparkSession, url: str, table: str, watermark: str, log: str, merge: Callable[[DataFrame], None], options: dict[str, str] | None = None, parts: int = 8, by: str | None = None) -> bool:
    """Merges the rows of a database table between the stored high-water mark and the present one; whether there were any.

    The upper bound is read first, so rows that come meanwhile are the next
    batch's. Both bounds are pushed to the database, and the read is split into
    ``parts`` by ranges of ``by`` (a number, date or timestamp; the watermark itself by default).
    The bound is committed when ``merge`` has returned: a failure in between
    reads the batch again, so ``merge`` should be keyed. Rows without a watermark are never read.
    """
    by, options = by or watermark, options or {}
    source = lambda query: spark.read.format("jdbc").options(url=url, dbtable=f"({query}) batch", **options)
    schema = source(f"select {watermark} from {table}").load().schema
    kind, lower = schema.fields[0].dataType, None
    lower = stored_offset(spark, log, kind.simpleString())
    quote = lambda v: f"'{v}'" if not isinstance(v, (int, float)) else str(v)
    behind = f"where {watermark} is not null" + (f" and {watermark} > {quote(lower)}" if lower is not None else "")
    edge = source(f"select max({watermark}) as upper_mark, min({by}) as first_part, max({by}) as last_part, count(*) as rows_behind from {table} {behind}").load().first()
    if not edge[3]:
        return False
    rows = source(f"select * from {table} {behind} and {watermark} <= {quote(edge[0])}")
    if edge[1] is not None and edge[1] != edge[2]:
        rows = rows.options(partitionColumn=by, lowerBound=str(edge[1]), upperBound=str(edge[2]), numPartitions=str(parts))
    merge(rows.load())
    number = spark.read.schema("number long").json(log).agg(F.max("number")).first()[0] if lower is not None else 0
    spark.createDataFrame([((number or 0) + 1, str(edge[0]))], "number long, upto string").coalesce(1).write.mode("append").json(log)
    return True


def normalize_table_name(name: str) -> str:
    """The last path part, lower-case, dashes as underscores, without a file suffix."""
    last = [p for p in name.strip("/").split("/") if p][-1]
    return last.split(".")[0].lower().replace("-", "_")


def resolve_table(registry: dict[str, str], table: str | None, path: str) -> str | None:
    """Canonical table of an object: an explicit name first, then the path's parts from its end; None if nothing is registered."""
    candidates = [table] if table else []
    candidates += [p for p in reversed(path.split("://")[-1].split("/")) if p and p not in _LAYERS]
    for c in candidates:
        if (name := normalize_table_name(c)) in registry:
            return registry[name]
    return None


def s3a_settings(endpoint: str, path_style: bool = True, ssl: bool = False) -> dict[str, str]:
    """Session settings for an S3-compatible store; credentials come from the cluster's provider chain."""
    return {"spark.hadoop.fs.s3a.endpoint": endpoint, "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(), "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower()}


def pending_documents(df: DataFrame, limit: int = 1000) -> DataFrame:
    """Documents to process: not archived, not completed, with an attachment and metadata; oldest first."""
    open_status = F.coalesce(F.col("processingStatus"), F.lit("PENDING")) != "COMPLETED"
    ready = open_status & ~F.coalesce(F.col("archive"), F.lit(False)) & (F.size(F.map_keys("_attachments")) > 0) & (F.size("metadata") > 0)
    return df.where(ready).orderBy("uploadedAt", "_id").limit(limit)
