"""Incremental ingest with Structured Streaming.

Landed files are read as a stream and merged into a keyed table batch by
batch. A batch that is delivered again changes nothing, as the merge is keyed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.tables import SnapshotTable


def json_stream(spark: SparkSession, folder: str, schema, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def ingest(stream: DataFrame, table: SnapshotTable, checkpoint: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df, after: Callable[[], None] | None = None, every: str | None = None) -> StreamingQuery:
    """Merges everything that has landed, then stops; ``after`` runs once the batch is merged (rebuild of views).

    With ``every``, such as ``1 minute``, it looks again at that interval until it is stopped. Batches of one query never overlap: a late one
    delays the next.
    """

    def merge(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        table.upsert(shape(batch))
        if after is not None:
            after()

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**({"processingTime": every} if every else {"availableNow": True})).start()


def tumbling(df: DataFrame, ts: str, size: str, keys: list[str], aggregates: list, late: str | None = None) -> DataFrame:
    """Tumbling windows with ``window_start`` and ``window_end``; the same on a table and on a stream (then with a watermark)."""
    if late:
        df = df.withWatermark(ts, late)
    out = df.groupBy(F.window(ts, size).alias("w"), *keys).agg(*aggregates)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[c for c in out.columns if c != "w"])


def once(stream: DataFrame, keys: list[str], ts: str, late: str) -> DataFrame:
    """The first row of each key; a repeat within ``late`` of it is dropped, and the key is forgotten behind the watermark, so state stays bounded."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def dropped_late(query: StreamingQuery) -> int:
    """Rows that stateful operators of a query dropped for lying behind the watermark, over the progress that it still holds."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
