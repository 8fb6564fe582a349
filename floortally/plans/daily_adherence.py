"""One day's device adherence against a fixed shift, with week and month hours."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from floortally import constants as C
from floortally.functions.numbers import count_where, half_even, percent, sum_or_zero, whole
from floortally.functions.periods import days_between, month_start, rolling_week_start
from floortally.operators.asof import as_date
from floortally.operators.joins import left_on
from floortally.operators.totals import mean_of_rounded, with_total
from floortally.plans.device_adherence import device_file_stats, device_roster, same_day_audio
from floortally.sources.tables import Tables


def staff_hours(t: Tables, as_of: dt.date, tenant_like: str | None = None) -> DataFrame:
    """Recorded seconds per staff member, rolling week and month to date, from one scan."""
    end = as_date(as_of)
    audio = same_day_audio(t, month_start(end), end, tenant_like)
    in_week = F.col("date") >= rolling_week_start(end)
    return audio.groupBy(F.col("sales_person_id").alias("sp_id")).agg(
        F.sum(F.when(in_week, F.col("seconds"))).alias("wtd_seconds"), F.sum("seconds").alias("mtd_seconds")
    )


def daily_adherence(
    t: Tables,
    as_of: dt.date,
    brands: Sequence[int] | None = None,
    tenant_like: str | None = None,
    pattern: str = C.DEVICE_PATTERN,
    shift: int = C.EIGHT_HOURS_SECONDS,
    null_safe: bool = True,
) -> DataFrame:
    """Per roster device the day's files and adherence to the shift."""
    end = as_date(as_of)
    stats = device_file_stats(t, as_of, 0, tenant_like, pattern).drop("active_days")
    rows = device_roster(t, as_of, brands=brands, all_stores=True).join(stats, "device", "left")
    hours = staff_hours(t, as_of, tenant_like).withColumnRenamed("sp_id", "hours_sp")
    rows = left_on(rows, hours, "sp_id", "hours_sp", null_safe)
    week_days, month_days = days_between(rolling_week_start(end), end), days_between(month_start(end), end)
    active = F.when(F.col("recorded_seconds").isNull(), "No").otherwise("Yes")
    return rows.withColumns(
        {
            "device_active": active,
            "blank_pct": F.when(active == "Yes", percent(F.col("blank_files"), F.col("total_files"), 1)),
            "adherence_pct": percent(F.col("recorded_seconds"), F.lit(shift), 1),
            "wtd_adherence_pct": percent(F.col("wtd_seconds"), shift * week_days, 1),
            "mtd_adherence_pct": percent(F.col("mtd_seconds"), shift * month_days, 1),
        }
    ).select(
        "manager",
        "store",
        "staff_name",
        "employee_id",
        "device",
        "device_active",
        "total_files",
        "valid_files",
        "blank_files",
        "blank_pct",
        "recorded_seconds",
        "adherence_pct",
        "wtd_seconds",
        "wtd_adherence_pct",
        "mtd_seconds",
        "mtd_adherence_pct",
    )


COUNTS = [
    "total_devices",
    "inactive_devices",
    "active_devices",
    "same_day_not_received",
    "same_day_received",
    "total_files",
]
DAY_MEANS = {"adherence_pct": "adherence_pct", "blank_pct": "blank_pct"}
PERIOD_MEANS = {"wtd_adherence_pct": "wtd_adherence_pct", "mtd_adherence_pct": "mtd_adherence_pct"}


def same_day_summary(detail: DataFrame) -> DataFrame:
    """Devices, same-day receipts and mean percentages per manager, with a grand total."""
    staffed, received = F.col("staff_name").isNotNull(), F.col("total_files").isNotNull()
    active = F.col("device_active")
    means = {name: F.when(received, F.col(c)) for name, c in DAY_MEANS.items()}
    means |= {name: F.col(c) for name, c in PERIOD_MEANS.items()}
    rows = (
        detail.where(F.col("manager").isNotNull())
        .groupBy("manager")
        .agg(
            F.countDistinct("device").alias("total_devices"),
            count_where(~staffed).alias("inactive_devices"),
            count_where(active == "No").alias("same_day_not_received"),
            count_where(received & (active == "Yes")).alias("same_day_received"),
            sum_or_zero(F.col("total_files")).alias("total_files"),
            *[half_even(mean_of_rounded(value)).alias(name) for name, value in means.items()],
            count_where(received).alias("_received"),
        )
        .withColumn("active_devices", F.col("total_devices") - F.col("inactive_devices"))
        .withColumn(
            "active_pct",
            F.when(F.col("_received") > 0, percent(F.col("same_day_received"), F.col("total_devices"))),
        )
    )
    names = ["active_pct", *means]
    rows = with_total(rows, [], "manager", [*COUNTS, "_received"], names)
    idle = ~F.col("is_total") & (F.col("_received") == 0)
    day_names = ["active_pct", *DAY_MEANS]
    shown = {
        c: F.when(F.col(c).isNull() & idle, F.lit(0.0)).otherwise(F.col(c)) for c in day_names
    }
    return rows.withColumns(shown).select(
        "manager", "is_total", *COUNTS, *[whole(F.col(c)).alias(c) for c in names]
    )
