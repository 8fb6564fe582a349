"""Timing of one-pass plans against the naive forms they replace; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from functools import reduce

from pyspark.sql import DataFrame, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from floortally import session  # noqa: E402
from floortally.bindings import driver as D  # noqa: E402
from floortally.functions.numbers import count_where, half_even, sum_or_zero  # noqa: E402
from floortally.functions.periods import month_start, rolling_week_start  # noqa: E402
from floortally.operators.asof import DAILY, as_date  # noqa: E402
from floortally.operators.totals import mean_of_rounded  # noqa: E402
from floortally.plans import daily_adherence, device_adherence, tenant_reasons  # noqa: E402


def median_seconds(build, runs: int = 3) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def hours_per_period(t) -> DataFrame:
    """Week and month hours from one scan each, joined."""
    end = as_date(D.AS_OF)
    frames = []
    for name, first in (("wtd", rolling_week_start(end)), ("mtd", month_start(end))):
        audio = device_adherence.same_day_audio(t, first, end)
        frames.append(audio.groupBy("sales_person_id").agg(F.sum("seconds").alias(name)))
    return frames[1].join(frames[0], "sales_person_id", "left")


def summary_by_joins(detail: DataFrame) -> DataFrame:
    """One aggregate per measure, merged on the manager."""
    keys, staffed = device_adherence.KEYS, detail.where(F.col("staff_name").isNotNull())
    frames = [
        detail.groupBy(*keys).agg(F.countDistinct("device").alias("devices")),
        detail.groupBy(*keys).agg(count_where(F.col("staff_name").isNull()).alias("inactive")),
        staffed.groupBy(*keys).agg(sum_or_zero(F.col("total_files")).alias("files")),
    ]
    frames += [
        staffed.groupBy(*keys).agg(half_even(mean_of_rounded(F.col(c))).alias(name))
        for name, c in device_adherence.MEANS.items()
    ]
    return reduce(lambda left, right: left.join(right, keys, "left"), frames)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = session.build("compare", f"local[{cpus}]", cpus, **{"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("OFF")
    audio, sales = D.audio_floor(spark, sf_dir), D.sales_floor(spark, sf_dir)

    def detail() -> DataFrame:
        return device_adherence.adherence_detail(audio, D.AS_OF, pattern=D.DEVICE_PATTERN)

    def tenant_loop() -> DataFrame:
        jobs = [tenant_reasons.outcome_totals(sales, [tenant], DAILY) for tenant in D.ORDER_TENANTS]
        for job in jobs[:-1]:
            job.write.format("noop").mode("overwrite").save()
        return jobs[-1]

    result = {
        "staff hours, one scan": median_seconds(lambda: daily_adherence.staff_hours(audio, D.AS_OF)),
        "staff hours, scan per period": median_seconds(lambda: hours_per_period(audio)),
        "manager summary, one aggregate": median_seconds(lambda: device_adherence.adherence_summary(detail())),
        "manager summary, aggregate per measure": median_seconds(lambda: summary_by_joins(detail())),
        "tenants, one job": median_seconds(lambda: tenant_reasons.outcome_totals(sales, D.ORDER_TENANTS, DAILY)),
        "tenants, one job each": median_seconds(tenant_loop),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
