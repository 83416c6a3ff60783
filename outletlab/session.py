"""Spark session and shared-folder helpers."""

from __future__ import annotations

import gc
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (this is
# the size check behind every broadcast that is not provably one row), splits
# skewed join partitions and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


ARROW_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_ROWS = 1_000


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "outletlab", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach; it is
    read, never overridden, and required. Only a local master, whose tasks
    share the driver's disk, gets a private folder when it is unset (tests).
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        path = tempfile.mkdtemp(prefix="outletlab-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


_scratch: dict[str, list[str]] = {}  # by application: the copies its runs have made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete the copies this application has written to the shared folder;
    for the end of a run, when no frame that reads them is used any more."""
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        drop_folder(spark, path)
    return len(paths)


def drop_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def copy_folder(spark: SparkSession, source: str, path: str) -> None:
    """Copy a folder of the shared storage, as bytes."""
    fs, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    here, there = fs.Path(source), fs.Path(path)
    fs.FileUtil.copy(here.getFileSystem(conf), here, there.getFileSystem(conf), there, False, conf)


def cut_lineage(df, name: str = "stage", partition_by: str | None = None):
    """Materialise ``df`` as Parquet in the shared checkpoint folder and
    return a frame that reads it back.

    One job writes the data (an unpersisted ``Dataset.checkpoint`` would run
    the plan twice: once to count, once to write), the copy is columnar with
    statistics, and it lives on storage every executor reaches, so losing an
    executor never sends recomputation further back than this point. Unless
    the session says otherwise, Python workers get ARROW_ROWS rows at a time.
    With ``partition_by`` the copy has a directory for each value of that column.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    with _arrow_rows(spark):
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_driver(spark: SparkSession) -> None:
    """Collect the driver's garbage. Spark keeps the blocks of its broadcasts
    until the collector finds nothing that refers to them, and the JVM gives
    room back only then; of itself it first fills the whole heap."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def _arrow_rows(spark: SparkSession):
    """Spark counts the rows of an Arrow batch, not its bytes: its default of
    10,000 rows holds tens of megabytes of text off the heap in every task."""
    free = spark.conf.get(ARROW_ROWS_KEY, None) is None
    if free:
        spark.conf.set(ARROW_ROWS_KEY, str(ARROW_ROWS))
    try:
        yield
    finally:
        if free:
            spark.conf.unset(ARROW_ROWS_KEY)


__all__ = ["get_spark", "checkpoint_root", "scratch_path", "drop_scratch", "cut_lineage", "drop_folder", "copy_folder", "free_driver"]
