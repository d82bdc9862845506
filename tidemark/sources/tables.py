"""Keyed tables as versioned Parquet snapshots.

A table is dealt into buckets by a hash of its key. ``v=<instant>/`` holds the
buckets that a batch touched, written anew; ``_commits/<instant>.json`` is
written when they are complete and tells for every bucket which instant has it.
Readers take the newest commit, or the newest at or before an instant, so a
failed write is never seen and an old state can be read again until
:meth:`SnapshotTable.vacuum` removes it. All files go through Spark's file
systems; one writer at a time is assumed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.columns import key_hash
from tidemark.operators.windows import latest_per_key
from tidemark.sources.written import Written

#: Files that the rows of a bucket are dealt over.
BUCKET_FILES = 4


@dataclass(frozen=True)
class TableSpec:
    """Name, record key, ordering column (largest wins) and an optional partition column."""

    name: str
    keys: tuple[str, ...]
    ordering: str
    partition: str | None = None
    #: Buckets of a new table, and rows of a bucket above which their number doubles.
    buckets: int = 16
    bucket_rows: int = 500_000


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, spec: TableSpec):
        self.spark, self.spec, self.path = spark, spec, f"{root.rstrip('/')}/{spec.name}"

    # -- file system

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def commits(self) -> list[str]:
        """Instants of all complete snapshots, oldest first."""
        fs, p = self._fs(f"{self.path}/_commits")
        if not fs.exists(p):
            return []
        return sorted(f.getPath().getName().removesuffix(".json") for f in fs.listStatus(p) if f.getPath().getName().endswith(".json"))

    def ready(self) -> bool:
        return bool(self.commits())

    def history(self) -> DataFrame:
        """``instant, rows, incoming, columns`` of each commit."""
        schema = "instant string, rows long, incoming long, columns array<string>"
        return self.spark.read.schema(schema).json(f"{self.path}/_commits") if self.ready() else self.spark.createDataFrame([], schema)

    def _note(self, instant: str) -> dict:
        """What a commit wrote down."""
        fs, p = self._fs(f"{self.path}/_commits/{instant}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    # -- reading

    def _read(self, note: dict, buckets=None) -> DataFrame:
        """The snapshot of a commit, or some of its buckets."""
        kept = {b: v for b, v in note["where"].items() if buckets is None or int(b) in buckets}
        schema = T.StructType.fromJson(json.loads(note["schema"]))
        if not kept:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/v={v}/_bucket={b}" for b, v in sorted(kept.items())])

    def read(self, as_of: str | None = None) -> DataFrame:
        """The newest snapshot, or the newest whose instant is at or before ``as_of`` (a prefix of an instant will do)."""
        found = [c for c in self.commits() if as_of is None or c[: len(as_of)] <= as_of]
        if not found:
            raise LookupError(f"{self.spec.name}: no snapshot" + (f" at {as_of}" if as_of else ""))
        return self._read(self._note(found[-1]))

    # -- writing

    def upsert(self, rows: DataFrame, instant: str | None = None) -> str:
        """Incoming rows replace stored rows of the same key; within a batch the largest ordering value wins.

        Keys hold over all partitions. Applying a batch twice equals applying
        it once. Columns may come and go: missing ones are null. Only the
        buckets of the batch's keys are read and written, unless a column
        changed its type or the number of buckets doubles. A batch whose keys lie
        anywhere in the table touches most buckets, however many there are.
        """
        before = self.commits()
        note = self._note(before[-1]) if before else {"buckets": self.spec.buckets, "where": {}, "counts": {}, "schema": None}
        instant = instant or datetime.now(UTC).strftime("%Y%m%d%H%M%S%f")
        if before and instant <= before[-1]:
            raise ValueError(f"{self.spec.name}: {instant} is not after the last commit {before[-1]}")
        key = key_hash(list(self.spec.keys))
        data = [c for c in rows.columns if not c.startswith("_commit") and c != "_record_key"]
        order = [F.desc_nulls_last(self.spec.ordering), F.desc(F.xxhash64(*data))]
        batch = latest_per_key(rows.select(*data), list(self.spec.keys), order)
        batch = batch.withColumns({"_commit_time": F.lit(instant), "_record_key": key, "_commit_seqno": F.concat(F.lit(f"{instant}_"), key)})
        scratch = Written(self.spark, "upsert")
        batch = scratch.cut(batch)  # evaluated once; what follows reads it from there
        wanted = note["buckets"]
        held = sum(note["counts"].values()) + batch.count()  # at most, as the batch may replace what is there
        while held > wanted * self.spec.bucket_rows:  # buckets keep their size as the table grows; doubled, they are all dealt anew
            wanted *= 2
        bucket = F.pmod(F.xxhash64("_record_key"), F.lit(wanted)).cast("int")
        merged = batch
        if note["where"]:
            touched = None
            stored = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(note["schema"])).fields}
            if wanted == note["buckets"] and not any(f.name in stored and stored[f.name] != f.dataType for f in batch.schema.fields):
                touched = {r[0] for r in batch.select(bucket).distinct().collect()}  # at most one for each bucket
            old = self._read(note, touched)
            merged = old.join(batch.select("_record_key"), "_record_key", "left_anti").unionByName(batch, allowMissingColumns=True)
            if wanted != note["buckets"]:
                note = note | {"where": {}, "counts": {}}
        # a bucket is a few files: rows are dealt by bucket and a part of the key
        part = F.pmod(F.xxhash64("_record_key", F.lit(1)), F.lit(BUCKET_FILES))
        writer = merged.withColumn("_bucket", bucket).repartition("_bucket", part).write.mode("overwrite").partitionBy("_bucket", *([self.spec.partition] if self.spec.partition else []))
        writer.parquet(f"{self.path}/v={instant}")
        scratch.drop(batch)
        written = self.spark.read.schema("_commit_time string, _bucket int").parquet(f"{self.path}/v={instant}")
        counts = written.groupBy("_bucket").agg(F.count("*").alias("rows"), F.count_if(F.col("_commit_time") == instant).alias("incoming")).collect() if merged.columns else []
        where = note["where"] | {str(r["_bucket"]): instant for r in counts}
        sizes = note["counts"] | {str(r["_bucket"]): r["rows"] for r in counts}
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in merged.schema.fields])
        note = {"instant": instant, "rows": sum(sizes.values()), "incoming": sum(r["incoming"] for r in counts), "columns": merged.columns, "buckets": wanted, "where": where, "counts": sizes, "schema": schema.json()}
        fs, p = self._fs(f"{self.path}/_commits/{instant}.json")
        out = fs.create(p, True)
        out.write(bytearray(json.dumps(note).encode()))
        out.close()
        return instant

    def vacuum(self, keep: int = 1) -> list[str]:
        """Removes all commits but the last ``keep`` and the folders that none of those reads; returns the removed instants."""
        commits = self.commits()
        gone, left = commits[: max(0, len(commits) - keep)], commits[max(0, len(commits) - keep) :]
        used = {v for c in left for v in self._note(c)["where"].values()}
        for c in gone:
            fs, p = self._fs(f"{self.path}/_commits/{c}.json")
            fs.delete(p, False)
        for c in commits:
            if c not in used:
                fs, p = self._fs(f"{self.path}/v={c}")
                fs.delete(p, True)
        return gone


def catalog(spark: SparkSession, root: str, layers=("bronze", "silver", "gold", "views")) -> DataFrame:
    """``layer, name, path, commits, last_commit`` of every table below a warehouse folder."""
    rows = []
    for layer in layers:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{layer}")
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for f in fs.listStatus(p) if fs.exists(p) else []:
            table = SnapshotTable(spark, str(p), TableSpec(f.getPath().getName(), (), ""))
            if instants := table.commits():
                rows.append((layer, table.spec.name, table.path, len(instants), instants[-1]))
    return spark.createDataFrame(rows, "layer string, name string, path string, commits int, last_commit string")


def commit_histogram(df: DataFrame) -> DataFrame:
    """Rows by minute of their commit."""
    return df.groupBy(F.substring("_commit_time", 1, 12).alias("minute")).agg(F.count("*").alias("n"))
