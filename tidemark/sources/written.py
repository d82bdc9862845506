"""Tables that a job writes for the jobs behind it, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the folder set as checkpoint folder; a temporary one only where all runs in one local JVM and none is named."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not named:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="tidemark-")
        context.setCheckpointDir(named)
    return named.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def new_folder(spark: SparkSession, name: str) -> str:
    """A new empty folder below the shared one, removed when the driver's JVM ends."""
    folder = f"{shared_folder(spark)}/tidemark-{name}-{uuid.uuid4().hex}"
    files, path = _file_system(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


class Written:
    """Parquet tables of one run of an operator; ``drop`` removes those that nothing reads any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.paths = spark, new_folder(spark, name), {}

    def cut(self, df: DataFrame) -> DataFrame:
        """``df`` written and read back: a lost executor costs nothing of it, and no later job computes it again."""
        path = f"{self.folder}/{len(self.paths)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[path] = out
        return out

    def drop(self, *tables: DataFrame) -> None:
        for path in [p for p, df in self.paths.items() if any(df is t for t in tables)]:
            files, at = _file_system(self.spark, path)
            files.delete(at, True)
            self.paths[path] = None
