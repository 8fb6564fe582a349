"""Intermediate tables in the folder the cluster shares, so that lost executors cost a re-read, not a rerun."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session; one of our own only where it is unset and everything runs in one JVM."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"{SETTING} must name a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="floortally-")
    spark.conf.set(SETTING, folder)
    return folder


_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(frame: DataFrame, rows_per_batch: int | None = None) -> DataFrame:
    """`frame` written to the shared folder and read back: evaluated once, its lineage cut. Where its rows are
    large, `rows_per_batch` bounds the Arrow batches in which this one evaluation sends them to Python."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    usual = spark.conf.get(BATCH_SETTING)
    if rows_per_batch:
        spark.conf.set(BATCH_SETTING, rows_per_batch)
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(BATCH_SETTING, usual)
    read = spark.read.schema(frame.schema).parquet(path)
    _paths[read] = path
    return read


def discard(*frames: DataFrame) -> None:
    """Deletes the files of `stored` tables that nothing will read again."""
    for frame in frames:
        context = frame.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(_paths.pop(frame))
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
