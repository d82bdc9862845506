"""Evidence documents: gate by size, cut for the index, keep the whole text to forward, and record how it ended."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters that the index takes, and bytes beyond which a document is refused.
INDEX_CHARS, MOST_BYTES = 30_000, 50 * 1024 * 1024


def process(df: DataFrame, text: str = "text", index_chars: int = INDEX_CHARS, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``df`` with size, both texts, status and error. COMPLETED only if every step went well."""
    size = F.octet_length(text)
    error = F.when(F.col(text).isNull(), "NO_TEXT").when(size > most_bytes, "TOO_LARGE").when(F.length(F.trim(text)) == 0, "EMPTY")
    good = error.isNull()
    return df.select(
        "*",
        F.coalesce(size, F.lit(0)).cast("long").alias("size_bytes"),
        F.coalesce(F.length(text), F.lit(0)).cast("long").alias("text_length"),
        F.when(good, F.substring(text, 1, index_chars)).alias("index_text"),
        F.when(good, F.col(text)).alias("forward_text"),
        F.when(good, "COMPLETED").otherwise("ERROR").alias("processing_status"),
        error.alias("processing_error"),
    )
