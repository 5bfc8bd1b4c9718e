"""Shared working folder for intermediate tables.

Lineage is cut by writing Parquet into the folder named by ``spark.checkpoint.dir``
(shared by all executors); a later read survives the loss of any executor.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; one of our own only where that is unset and all tasks run on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="cadenza-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


BATCH_ROWS = "1000"


def bounded_batches(spark: SparkSession) -> None:
    """Texts are long: rows of an Arrow batch, which Spark counts without regard to their size, are fewer than by default."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > int(BATCH_ROWS):
        spark.conf.set(name, BATCH_ROWS)


def give_back() -> None:
    """Return memory that a worker process no longer uses (workers live on from task to task)."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


_open: dict[str, SparkSession] = {}


@atexit.register
def release() -> None:
    """Delete the folders of all queries so far, when their results are no longer read; runs by itself when the driver ends."""
    while _open:
        path, spark = _open.popitem()
        with contextlib.suppress(Exception):  # the session may be gone; what is left is in the folder that the cluster names
            if spark.sparkContext._jsc is not None:
                delete(spark, path)


class Workspace:
    """A new folder below the shared one, there until ``release``."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        _open[self.path] = spark

    def keep(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """Write ``df`` once and read it back from the shared folder."""
        clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(clean, "false")
        self.spark.conf.set(clean, "true")  # the shuffle files of this write are of no further use
        try:
            return self._write(df, name, partition_by)
        finally:
            self.spark.conf.set(clean, before)

    def _write(self, df: DataFrame, name: str, partition_by: str | None) -> DataFrame:
        writer = df.write.mode("error")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str = "") -> None:
        """Delete one table, or the whole folder."""
        delete(self.spark, f"{self.path}/{name}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
