"""Evidence documents in states: PENDING, PROCESSING, then COMPLETED or ERROR with its reason.

States are rows of a keyed table with a revision. A change names the revision
it has seen; one whose document has moved on meanwhile is a conflict, is read
again and retried a few times, later each time. All documents of a run go
through each step together: checks, decryption, text, index, forwarding are
columns or writes of one table, and a failure in one document is that row's error.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.documents import INDEX_CHARS, MOST_BYTES
from tidemark.sources.tables import SnapshotTable, TableSpec
from tidemark.sources.written import Written

#: Tries of a change of state, and seconds of delay, times the number of the try.
RETRIES, DELAY = 3, 1.0
STATES = "doc_id string, revision long, status string, error string, processed_at timestamp"
#: What a sink returns: documents that it could not take. ``doc_id, error``.
Failures = DataFrame | None


def state_table(spark: SparkSession, root: str) -> SnapshotTable:
    return SnapshotTable(spark, root, TableSpec("document_states", ("doc_id",), "revision"))


def states_of(table: SnapshotTable) -> DataFrame:
    """``doc_id, revision, status, error, processed_at`` of every known document."""
    if not table.ready():
        return table.spark.createDataFrame([], STATES)
    return table.read().select("doc_id", "revision", "status", "error", "processed_at")


class Conflict(RuntimeError):
    """Changes that others got in the way of, at every try."""


def change(table: SnapshotTable, changes: DataFrame, retries: int = RETRIES, delay: float = DELAY, sleep: Callable[[float], None] = time.sleep) -> None:
    """Sets states: ``doc_id, seen, status, error``, where ``seen`` is the revision that the change is based on (0: none yet).

    Changes of documents that still have that revision are made in one merge.
    The others are based on the present revision and tried again; those left after the last try are an error, the rest being set.
    """
    written = Written(table.spark, "states")
    left = written.cut(changes.select("doc_id", F.col("seen").cast("long").alias("seen"), "status", F.col("error").cast("string").alias("error")))
    for attempt in range(1, retries + 1):
        now = states_of(table).select("doc_id", "revision")
        met = written.cut(left.join(now, "doc_id", "left").withColumn("revision", F.coalesce("revision", F.lit(0))))
        fit = met.where("revision = seen")
        if fit.limit(1).count():
            table.upsert(fit.select("doc_id", (F.col("revision") + 1).alias("revision"), "status", "error", F.current_timestamp().alias("processed_at")))
        left = written.cut(met.where("revision != seen").select("doc_id", F.col("revision").alias("seen"), "status", "error"))
        if not left.limit(1).count():
            return
        if attempt < retries:
            sleep(delay * attempt)
    raise Conflict(f"{left.count()} documents changed meanwhile, at each of {retries} tries")


def checked(docs: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``docs`` with ``attachment``, the first one, its metadata as ``file`` and what speaks against it as ``error``."""
    name = F.element_at(F.array_sort(F.map_keys("_attachments")), 1)
    docs = docs.withColumns({"attachment": F.when(F.coalesce(F.size("_attachments"), F.lit(0)) > 0, F.element_at("_attachments", name)), "file": F.get("metadata", F.lit(0))})
    size = F.col("file.fileSize")
    large = F.concat(F.lit("File too large: "), F.round(size / (1 << 20)).cast("long"), F.lit("MB"))
    return docs.withColumn("error", F.when(F.coalesce(F.size("_attachments"), F.lit(0)) <= 0, "No attachments found").when(F.col("file").isNull(), "Document metadata missing").when(size > most_bytes, large))


def decrypted(docs: DataFrame, key: str | None) -> DataFrame:
    """Attachments of encrypted files by AES-GCM: initial vector, data and tag, as Spark's own functions read them; one that does not open is an error."""
    needs = F.coalesce(F.col("file.encryption").isNotNull(), F.lit(False)) & F.col("error").isNull()
    opened = F.try_aes_decrypt("attachment", F.unhex(F.lit(key)), F.lit("GCM")) if key else F.lit(None).cast("binary")
    docs = docs.withColumn("_opened", F.when(needs, opened))
    return docs.withColumns({"error": F.when(needs & F.col("_opened").isNull(), "Decryption failed").otherwise(F.col("error")), "attachment": F.when(needs, F.col("_opened")).otherwise(F.col("attachment"))}).drop("_opened")


def utf8_text(docs: DataFrame) -> DataFrame:
    """The simplest extraction: an attachment that is UTF-8 text."""
    text = F.try_validate_utf8(F.col("attachment").cast("string"))
    return docs.withColumns({"text": F.when(F.col("error").isNull(), text), "error": F.when(F.col("error").isNull() & text.isNull(), "No text could be extracted").otherwise(F.col("error"))})


def run(
    docs: DataFrame, table: SnapshotTable, index: Callable[[DataFrame], Failures], forward: Callable[[DataFrame], Failures], extract: Callable[[DataFrame], DataFrame] = utf8_text, key: str | None = None, index_chars: int = INDEX_CHARS, most_bytes: int = MOST_BYTES, sleep=time.sleep
) -> DataFrame:
    """Takes every document that is not completed through all steps and returns ``doc_id, status, error`` of these.

    ``docs`` has ``_id``, ``_attachments`` (name to bytes), ``metadata`` (array of ``fileName, fileSize, mimeType, encryption``).
    The index gets texts cut to ``index_chars`` with their full length, forwarding gets them whole. What a sink could not take ends
    in ERROR with the sink's reason, and is not forwarded if it was the index.
    """
    spark, written = docs.sparkSession, Written(docs.sparkSession, "documents")
    known = states_of(table).select(F.col("doc_id").alias("_id"), "revision", "status")
    due = docs.join(known, "_id", "left").where(F.coalesce("status", F.lit("PENDING")) != "COMPLETED")
    due = written.cut(due.drop("status").withColumn("revision", F.coalesce("revision", F.lit(0))))
    begun = due.select(F.col("_id").alias("doc_id"), F.col("revision").alias("seen"), F.lit("PROCESSING").alias("status"), F.lit(None).cast("string").alias("error"))
    if not begun.limit(1).count():
        return spark.createDataFrame([], "doc_id string, status string, error string")
    change(table, begun, sleep=sleep)
    rows = written.cut(extract(decrypted(checked(due, most_bytes), key)).select(F.col("_id").alias("doc_id"), F.col("file.fileName").alias("file_name"), F.col("file.mimeType").alias("content_type"), "text", "error"))
    good = rows.where("error is null")
    none = spark.createDataFrame([], "doc_id string, error string")
    unindexed = index(good.select("doc_id", "file_name", "content_type", F.substring("text", 1, index_chars).alias("content"), F.length("text").alias("text_length")))
    unindexed = written.cut((none if unindexed is None else unindexed).select("doc_id", F.col("error").alias("_late")))
    unsent = forward(good.join(unindexed.select("doc_id"), "doc_id", "left_anti").select("doc_id", "file_name", F.col("text").alias("content")))
    failed = written.cut(unindexed.unionByName((none if unsent is None else unsent).select("doc_id", F.col("error").alias("_late"))).groupBy("doc_id").agg(F.min("_late").alias("_late")))
    ended = rows.select("doc_id", "error").join(failed, "doc_id", "left").select("doc_id", F.coalesce("error", "_late").alias("error"))
    now = states_of(table).select("doc_id", F.col("revision").alias("seen"))
    ended = written.cut(ended.join(now, "doc_id").withColumn("status", F.when(F.col("error").isNull(), "COMPLETED").otherwise("ERROR")))
    change(table, ended, sleep=sleep)
    return ended.select("doc_id", "status", "error")
