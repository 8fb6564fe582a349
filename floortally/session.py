"""Spark session settings the reports are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes partitions, turns checked small sides into broadcasts and splits
# skewed join partitions. Nothing is broadcast by hint: sides beyond the threshold shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}


def build(app: str, master: str | None = None, shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    """Session with the settings above; on a cluster leave `master` to spark-submit.

    `shuffle_partitions` is the upper bound adaptive execution coalesces from: about three per
    core of the cluster, and never so few that a partition outgrows an executor's memory.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
