"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows, and bytes of text, that a Python task handles at once; a batch is cut into slices of that size, a longer text is a slice of its own.
SLICE_ROWS, SLICE_BYTES = 256, 1 << 20


# ------------------------------------------------------------ written tables


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A session on one machine that names none (tests) gets a temporary folder of
    its own; elsewhere that would leave parts of a table on every executor, so
    it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    named = named or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path in its own form."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


class Scratch:
    """Tables that one call of an operator writes below the shared folder.

    ``drop`` removes what no later step reads. What a lazily evaluated result
    still reads stays until the driver's JVM ends, which removes the folder.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.made = spark, f"{shared_dir(spark)}/tidemark-{uuid.uuid4().hex}", {}
        files, path = _file_system(spark, self.folder)
        files.mkdirs(path)
        files.deleteOnExit(path)

    def cut(self, df: DataFrame, few: bool = False) -> DataFrame:
        """``df`` written as a Parquet table and read back.

        Later jobs then start from replicated files instead of recomputing, and
        a lost executor costs nothing that was already written. With ``few``
        the partitions of the last shuffle are put together up to the advised
        size, so that a small table is one file and not one for each core.
        """
        path, name = f"{self.folder}/{len(self.made)}", "spark.sql.adaptive.coalescePartitions.parallelismFirst"
        before = self.spark.conf.get(name)
        try:
            self.spark.conf.set(name, "false" if few else before)
            df.write.parquet(path)
        finally:
            self.spark.conf.set(name, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.made[path] = out
        return out

    def drop(self, *tables: DataFrame) -> None:
        for path in [p for p, df in self.made.items() if any(df is t for t in tables)]:
            files, at = _file_system(self.spark, path)
            files.delete(at, True)
            self.made[path] = None


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to a folder of its own and read back; see :class:`Scratch`."""
    return Scratch(df.sparkSession).cut(df)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ------------------------------------------------------------- Python tasks

_held: dict[object, object] = {}


def hold(key, make):
    """What ``make`` gives, kept in this Python process until another key is asked for.

    Python workers serve one stage after another; caches, tables and models of
    an earlier stage would stay beside those of the present one.
    """
    if key not in _held:
        release()
        _held[key] = make()
    return _held[key]


def release() -> None:
    """Gives the memory of the held value, and what allocators keep in reserve, back to the system."""
    _held.clear()
    gc.collect()
    trim()


def trim() -> None:
    """Gives what allocators keep in reserve back to the system: an idle worker stays beside the next stage."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if give_back is not None:
        give_back(0)


def _text_bytes(column):
    """Bytes of text in each row of a string column or a column of lists of strings; None for other columns."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    kind = column.type
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        inner = _text_bytes(column.flatten())
        if inner is not None:
            upto = np.concatenate([[0], np.cumsum(inner)])
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            return upto[ends] - upto[ends - sizes]
    return None


def slices(batches, rows: int = SLICE_ROWS, size: int = SLICE_BYTES):
    """Arrow record batches, cut into pieces of at most so many rows and bytes of text, lists of texts included (but one row at least)."""
    import numpy as np

    try:
        for batch in batches:
            weight = np.zeros(batch.num_rows, dtype=np.int64)
            for column in batch.columns:
                inside = _text_bytes(column)
                if inside is not None:
                    weight += inside
            upto, at = np.cumsum(weight), 0
            while at < batch.num_rows:
                before = upto[at - 1] if at else 0
                end = min(at + rows, max(at + 1, int(np.searchsorted(upto, before + size, side="right"))), batch.num_rows)
                yield batch.slice(at, end - at)
                at = end
    finally:  # the task ends, the worker stays
        trim()


# ------------------------------------------------------------------ columns


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def free_name(wanted: str, *taken) -> str:
    """``wanted``, behind as many underscores as it takes to be in none of the lists of column names (case aside)."""
    used = {c.lower() for names in taken for c in names}
    while wanted.lower() in used:
        wanted = f"_{wanted}"
    return wanted


def held_out(column: str, modulus: int, remainder: int):
    """True where crc32 of the id, written as text, leaves ``remainder``."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus == remainder, F.lit(False))
