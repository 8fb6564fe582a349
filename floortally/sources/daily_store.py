"""Folded facts kept per day, so that a report of a period reads each fact for its new days only.

A table of the store is a Parquet dataset partitioned by `date`. Writing some days replaces their partitions
and leaves the others alone; a day without rows keeps a partition too, so that it counts as known.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from floortally.operators.asof import as_date, on_days
from floortally.operators.shaping import append

Build = Callable[[Sequence[dt.date]], DataFrame]


class DailyStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def known(self, name: str) -> set[dt.date]:
        """Days of a table, from its directories."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        system = path.getFileSystem(context._jsc.hadoopConfiguration())
        if not system.exists(path):
            return set()
        days = (re.fullmatch(r"date=(\d{4}-\d{2}-\d{2})", status.getPath().getName()) for status in system.listStatus(path))
        return {dt.date.fromisoformat(day[1]) for day in days if day}

    def replace(self, name: str, days: Sequence[dt.date], rows: DataFrame) -> None:
        """Writes the rows of these days in place of what the table has of them."""
        marks = self.spark.range(1, numPartitions=1).select(F.explode(F.array(*[as_date(d) for d in days])).alias("date"))
        both = append(rows.withColumn("_row", F.lit(True)), marks.withColumn("_row", F.lit(False)))
        # Days of any size: a large one is split over tasks, small ones share a task.
        written = both.hint("rebalance", "date").write.partitionBy("date").mode("overwrite")
        written.option("partitionOverwriteMode", "dynamic").parquet(f"{self.root}/{name}")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}").where("_row").drop("_row")

    def bring(self, name: str, first: dt.date, last: dt.date, renewed: dt.date, build: Build) -> DataFrame:
        """The table with every day of `[first, last]`: days it does not know, and those from `renewed` on, are
        built by `build`, all in one go."""
        known = self.known(name)
        wanted = [first + dt.timedelta(n) for n in range((last - first).days + 1)]
        days = [d for d in wanted if d not in known or d >= renewed]
        if days:
            self.replace(name, days, build(days))
        return self.read(name)

    def days_of(self, name: str, days: Sequence[dt.date]) -> DataFrame:
        return self.read(name).where(on_days(F.col("date"), days))
