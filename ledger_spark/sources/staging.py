"""Staged Parquet tables in the cluster's shared checkpoint folder.

A workflow of several steps over the same rows writes the frame between steps:
the next step reads a table that outlives any executor, plans from its real file
size, and prunes columns. Nothing is kept on executor-local disks.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HOLDS = "__holds"
CHECKPOINT_DIR_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder named by the session; only a local session without the setting gets its own."""
    folder = spark.conf.get(CHECKPOINT_DIR_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR_SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="ledger-spark-")
    spark.conf.set(CHECKPOINT_DIR_SETTING, folder)
    return folder


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written at ``path`` to the end."""
    files, marker = _file_system(spark, f"{path}/_SUCCESS")
    return files.exists(marker)


class Staging:
    """Writes frames below one run folder and reads them back."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = f"{folder or shared_folder(spark)}/ledger-{uuid.uuid4()}"
        self._step = 0

    def path(self, name: str) -> str:
        self._step += 1
        return f"{self.folder}/{self._step:03d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return a frame over the written table."""
        path = self.path(name)
        self._write(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def split(self, df: DataFrame, name: str, condition: Column) -> tuple[DataFrame, DataFrame]:
        """Write ``df`` once, partitioned by ``condition``; the rows where it holds and the others, each read alone.

        A step that needs one of the two opens only that partition's files.
        """
        path = self.path(name)
        self._write(df.withColumn(_HOLDS, F.coalesce(condition, F.lit(False))), path, [_HOLDS])
        read = self.spark.read.schema(T.StructType([*df.schema.fields, T.StructField(_HOLDS, T.BooleanType())])).parquet(path)
        return read.filter(F.col(_HOLDS)).drop(_HOLDS), read.filter(~F.col(_HOLDS)).drop(_HOLDS)

    def _write(self, df: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
        df.write.mode("errorifexists").partitionBy(*partitions).parquet(path)

    def delete(self) -> None:
        """Remove all tables of this run. Frames over them can no longer be read."""
        files, folder = _file_system(self.spark, self.folder)
        files.delete(folder, True)
