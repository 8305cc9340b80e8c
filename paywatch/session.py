"""Session defaults and durable scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession

#: Tables written between steps have files of at most so many rows, and at most so many bytes are read by a task.
ROWS_PER_FILE = 1_000_000
BYTES_PER_TASK = 32 << 20

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "paywatch", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time and adaptive execution; anything in `conf` wins."""
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "static",
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder the cluster names for checkpoints; where none is named, one in the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/paywatch/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Have the file system delete an existing path when the driver ends."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)


def even_files(df: DataFrame) -> DataFrameWriter:
    """Writer of a table that tasks can share out: files are cut by rows, as a part of a file may hold no rows at all."""
    return df.write.option("maxRecordsPerFile", ROWS_PER_FILE)


def read_in_small_parts(spark: SparkSession) -> None:
    """Let tasks read little enough to sort it in memory; a smaller limit of the session stays."""
    limit = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    spark.conf.set("spark.sql.files.maxPartitionBytes", min(limit, BYTES_PER_TASK))


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each job inside when it ends, not when the driver happens to collect garbage.

    For jobs that write a table or take a few rows once; a result that is read again would be made again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


class Scratch:
    """Tables an iterative job writes between rounds.

    Writing a round to the shared folder cuts its lineage, survives the loss of executors and gives
    the next plan true sizes. `keep_last` frees rounds that nothing reads any more; the rest, which
    results may still read, goes when the session ends.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.base = scratch_path(spark, name)
        self._written: dict[str, list[str]] = {}

    def write(self, df: DataFrame, table: str, keep_last: int = 2) -> DataFrame:
        """Write and read back; frees all but the `keep_last` newest versions of `table`."""
        versions = self._written.setdefault(table, [])
        path = f"{self.base}/{table}-{uuid.uuid4().hex}"
        even_files(df).parquet(path)
        if not versions:
            delete_at_end(self.spark, self.base)
        versions.append(path)
        while len(versions) > keep_last:
            delete_path(self.spark, versions.pop(0))
        return self.spark.read.schema(df.schema).parquet(path)

    def discard(self, table: str) -> None:
        """Delete the newest version of `table`, which nothing reads any more."""
        delete_path(self.spark, self._written[table].pop())

    def write_with(self, df: DataFrame, table: str, keep_last: int = 2, **metrics: Column) -> tuple[DataFrame, dict]:
        """Write, and take totals over the rows on the way, which spares a second job."""
        seen = Observation()
        written = self.write(df.observe(seen, *[m.alias(name) for name, m in metrics.items()]), table, keep_last)
        return written, seen.get
