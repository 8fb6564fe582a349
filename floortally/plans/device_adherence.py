"""Device roster, file statistics and adherence against attendance."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from floortally import constants as C
from floortally.functions import rules
from floortally.functions.durations import clock_text, default_shift, interval_seconds, shift_seconds
from floortally.functions.numbers import count_where, half_even, percent, sql_percent, sum_or_zero, whole
from floortally.functions.periods import month_start, parse_date, parse_timestamp
from floortally.functions.text import device_code, not_blank
from floortally.operators.asof import as_date
from floortally.operators.joins import left_on, split_left_join
from floortally.operators.shaping import nulls_last, positioned
from floortally.operators.temporal import valid_on
from floortally.operators.totals import added_parts, mean_of_parts, mean_of_rounded, mean_parts, with_total
from floortally.plans.organisation import in_regions, store_chain
from floortally.sources.tables import Tables

KEYS = ["regional_manager_id", "manager"]
WEEK_BACK = 6


def device_roster(
    t: Tables,
    as_of: dt.date,
    regions: Sequence[int] | None = None,
    brands: Sequence[int] | None = None,
    all_stores: bool = False,
) -> DataFrame:
    """Devices registered or assigned at `as_of`, with staff, store and area manager.

    `all_stores` keeps devices of unknown stores too (no regional restriction).
    """
    day = as_date(as_of)
    chain = store_chain(t)
    assigned = t.devices.where(valid_on(F.col("assigned_on"), F.col("unassigned_on"), day))
    registered = t.device_registrations
    in_use = assigned
    if brands is not None:
        registered = registered.where(F.col("brand_id").isin(list(brands)))
        in_use = assigned.join(chain.where(F.col("brand_id").isin(list(brands))), "store_id", "left_semi")
    base = registered.select("name", "store_id").union(in_use.select("name", "store_id")).distinct()
    comments = F.col("comments")
    holders = assigned.where(comments.isNull() | (comments != C.DELETED_DEVICE_COMMENT)).select(
        "name", F.col("sales_person_id").alias("sp_id")
    )
    staff = t.sales_persons.select(
        F.col("id").alias("sp_id"), F.col("name").alias("staff_name"), F.upper("employee_id").alias("employee_id")
    )
    rows = (
        split_left_join(base, holders, ["name"], seen=holders.select("name").distinct())
        .join(staff.withColumn("_known", F.lit(True)), "sp_id", "left")
        .withColumn("sp_id", F.when(F.col("_known"), F.col("sp_id")))
        .join(chain, "store_id", "left")
    )
    if not all_stores:
        rows = in_regions(rows, regions)
    return rows.select(*KEYS, "store", "staff_name", F.col("name").alias("device"), "employee_id", "sp_id")


def same_day_audio(t: Tables, first: Column, last: Column, tenant_like: str | None = None) -> DataFrame:
    """Recordings of the range uploaded the same day within working hours, with numeric durations."""
    audio = audio_in_range(t, first, last, tenant_like)
    return audio.where(
        rules.same_day_upload(F.col("date"), F.col("createddate")) & rules.recorded_in_hours(F.col("filename"))
    )


def audio_in_range(t: Tables, first: Column, last: Column, tenant_like: str | None = None) -> DataFrame:
    audio = t.audio_files.where(F.col("date").between(first, last))
    if tenant_like is not None:
        audio = audio.where(F.col("path").like(tenant_like))
    return audio.withColumns(
        {
            "seconds": interval_seconds(F.col("duration")),
            "speech_seconds": F.col("speech_duration").try_cast("double"),
        }
    )


def device_file_stats(
    t: Tables,
    as_of: dt.date,
    days_back: int = WEEK_BACK,
    tenant_like: str | None = None,
    pattern: str = C.DEVICE_PATTERN,
) -> DataFrame:
    """Per device the files, valid and blank files, recorded seconds and active days."""
    end = as_date(as_of)
    audio = same_day_audio(t, F.date_sub(end, days_back), end, tenant_like)
    rows = audio.select(
        device_code(F.col("path"), pattern).alias("device"),
        "id",
        "date",
        "seconds",
        rules.blank_file(F.col("seconds"), F.col("speech_seconds"), "a").alias("blank"),
    )
    return (
        rows.groupBy("device")
        .agg(
            F.count("id").alias("total_files"),
            F.sum(1 - F.col("blank")).alias("valid_files"),
            F.sum("seconds").alias("recorded_seconds"),
            F.countDistinct("date").alias("active_days"),
        )
        .withColumn("blank_files", F.col("total_files") - F.col("valid_files"))
    )


def _attendance_drops(t: Tables, as_of: dt.date) -> tuple[DataFrame, dict[str, Column]]:
    """The drops a rollup reads and the first drop of each of its periods. The drop of day D arrives on D+1;
    the month is the one in which the week began."""
    week = F.date_sub(as_date(as_of), WEEK_BACK)
    first = {"wtd": F.date_add(week, 1), "mtd": F.date_add(month_start(week), 1)}
    last = F.date_add(as_date(as_of), 1)
    inside = F.col("day").between(F.least(*first.values()), last)
    return t.attendance.where(inside & F.col("UserID").isNotNull()), first


def attendance_rollup(
    t: Tables, as_of: dt.date, wrap_24h: bool = False, formats: Sequence[str] = C.TIME_FORMATS
) -> DataFrame:
    """Shift days and seconds per user, last seven days and month to date, both from one scan.

    Dates and times are ISO texts or in one of the formats; see `attendance_rejects` for the others.
    """
    rows, first = _attendance_drops(t, as_of)
    rows = rows.select(
        F.col("UserID").alias("user_id"),
        "day",
        parse_date(F.col("Date"), formats).alias("date"),
        shift_seconds(F.col("InDateTime"), F.col("OutDateTime"), wrap_24h, formats).alias("seconds"),
    )
    measures = []
    for label, start in first.items():
        inside = F.col("day") >= start
        measures += [
            F.countDistinct(F.when(inside, F.col("date"))).alias(f"{label}_days"),
            F.sum(F.when(inside, F.col("seconds"))).alias(f"{label}_shift_seconds"),
        ]
    return (
        rows.groupBy("user_id")
        .agg(*measures)
        .withColumns({f"{p}_shift": clock_text(F.col(f"{p}_shift_seconds"), 1) for p in first})
    )


def attendance_rejects(t: Tables, as_of: dt.date, formats: Sequence[str] = C.TIME_FORMATS) -> DataFrame:
    """Texts of the drops a rollup reads that are neither blank nor a date or time, counted per drop and column.

    Such a time makes the shift the default one, such a date no day."""
    rows, _ = _attendance_drops(t, as_of)
    parsed = {
        "InDateTime": parse_timestamp(F.col("InDateTime"), formats),
        "OutDateTime": parse_timestamp(F.col("OutDateTime"), formats),
        "Date": parse_date(F.col("Date"), formats),
    }
    lost = {c: count_where(not_blank(F.col(c)) & found.isNull()).alias(c) for c, found in parsed.items()}
    days = rows.groupBy("day").agg(*lost.values())
    cells = [F.struct(F.lit(c).alias("field"), F.col(c).alias("rejected")) for c in lost]
    return days.select("day", F.inline(F.array(*cells))).where("rejected > 0")


def attendance_days(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First and last attendance drop the rollup of `as_of` reads."""
    week = as_of - dt.timedelta(WEEK_BACK)
    return week.replace(day=1) + dt.timedelta(1), as_of + dt.timedelta(1)


def staff_mtd(t: Tables, as_of: dt.date, tenant_like: str | None = None) -> DataFrame:
    """Month-to-date recorded seconds, days received and blank % per employee.

    Files are folded per (staff, day) before the staff join. Unlike the device statistics this
    covers every upload and hour.
    """
    end = as_date(as_of)
    audio = audio_in_range(t, month_start(end), end, tenant_like)
    daily = audio.groupBy("sales_person_id", "date").agg(
        F.count("id").alias("files"),
        F.sum(rules.blank_file(F.col("seconds"), F.col("speech_seconds"), "b")).alias("blank"),
        F.sum("seconds").alias("seconds"),
    )
    staff = t.sales_persons.select(
        F.col("id").alias("sales_person_id"), F.upper("employee_id").alias("employee_id")
    )
    return (
        daily.join(staff, "sales_person_id", "left")
        .groupBy("employee_id")
        .agg(
            F.sum("seconds").alias("mtd_recorded_seconds"),
            F.countDistinct("date").alias("mtd_days_received"),
            sql_percent(F.sum("blank"), F.sum("files"), 1).alias("mtd_blank_pct"),
        )
    )


def blank_rules(t: Tables, as_of: dt.date, tenant_like: str | None = None) -> DataFrame:
    """Month-to-date files per staff member and how many are blank under each of the rules."""
    end = as_date(as_of)
    audio = audio_in_range(t, month_start(end), end, tenant_like)
    blanks = [
        F.sum(rules.blank_file(F.col("seconds"), F.col("speech_seconds"), rule)).alias(f"blank_{rule}")
        for rule in ("a", "b", "c")
    ]
    return audio.groupBy("sales_person_id").agg(F.count("id").alias("files"), *blanks)


def adherence_detail(
    t: Tables,
    as_of: dt.date,
    regions: Sequence[int] | None = None,
    brands: Sequence[int] | None = None,
    tenant_like: str | None = None,
    pattern: str = C.DEVICE_PATTERN,
    null_safe: bool = True,
    wrap_24h: bool = False,
) -> DataFrame:
    """One row per roster device with week and month adherence and a comment.

    `null_safe` lets devices without an employee id pick up the figures of such audio.
    """
    stats = device_file_stats(t, as_of, WEEK_BACK, tenant_like, pattern)
    shifts = attendance_rollup(t, as_of, wrap_24h).select("user_id", "wtd_shift_seconds", "mtd_shift_seconds")
    month = staff_mtd(t, as_of, tenant_like)
    rows = device_roster(t, as_of, regions, brands).join(stats, "device", "left")
    rows = left_on(rows, shifts, "employee_id", "user_id")
    rows = left_on(rows, month.withColumnRenamed("employee_id", "month_employee"), "employee_id", "month_employee", null_safe)

    recorded, month_recorded = F.col("recorded_seconds"), F.col("mtd_recorded_seconds")
    rows = rows.withColumns(
        {
            "wtd_shift_seconds": _fallback_shift("wtd_shift_seconds", recorded, "active_days", wrap_24h),
            "mtd_shift_seconds": _fallback_shift("mtd_shift_seconds", month_recorded, "mtd_days_received", wrap_24h),
        }
    )
    rows = rows.withColumns(
        {
            "blank_pct": percent(F.col("blank_files"), F.col("total_files"), 1),
            "adherence_pct": F.when(recorded > 0, percent(recorded, F.col("wtd_shift_seconds"), 1)),
            "mtd_adherence_pct": F.when(month_recorded > 0, percent(month_recorded, F.col("mtd_shift_seconds"), 1)),
        }
    )
    return rows.select(
        *KEYS,
        "store",
        "staff_name",
        "device",
        "employee_id",
        "total_files",
        "valid_files",
        "blank_files",
        "recorded_seconds",
        "active_days",
        "wtd_shift_seconds",
        "blank_pct",
        "adherence_pct",
        "mtd_recorded_seconds",
        "mtd_days_received",
        "mtd_blank_pct",
        "mtd_shift_seconds",
        "mtd_adherence_pct",
        rules.comment(F.col("blank_pct"), F.col("adherence_pct")).alias("comments"),
    )


def _fallback_shift(shift: str, recorded: Column, days: str, wrap_24h: bool) -> Column:
    """Default shift x days where something was recorded but no shift is known."""
    missing = F.col(shift).isNull() & recorded.isNotNull()
    return F.when(missing, default_shift(F.col(days), wrap_24h)).otherwise(F.col(shift))


def sorted_detail(detail: DataFrame, ascending: bool = True) -> DataFrame:
    """The detail by manager, store and staff, with each row's position among its manager's; NULL is last either way."""
    order = nulls_last(["store", "staff_name"], ascending) + nulls_last(["device"])
    rows = positioned(detail, ["manager"], order)
    return rows if ascending else rows.orderBy(F.desc_nulls_last("manager"), "position")


MEANS = {
    "time_log_pct": "adherence_pct",
    "blank_pct": "blank_pct",
    "mtd_time_log_pct": "mtd_adherence_pct",
    "mtd_blank_pct": "mtd_blank_pct",
}
COUNTS = ["total_devices", "inactive_devices", "active_devices", "total_files"]


def _manager_rows(detail: DataFrame) -> DataFrame:
    """One conditional aggregate per manager; means cover staffed devices only."""
    staffed = F.col("staff_name").isNotNull()
    return (
        detail.where(F.col("manager").isNotNull())
        .groupBy(*KEYS)
        .agg(
            F.countDistinct("device").alias("total_devices"),
            count_where(~staffed).alias("inactive_devices"),
            sum_or_zero(F.when(staffed, F.col("total_files"))).alias("total_files"),
            *[half_even(mean_of_rounded(F.when(staffed, F.col(c)))).alias(name) for name, c in MEANS.items()],
            count_where(staffed).alias("_staffed"),
        )
        .withColumn("active_devices", F.col("total_devices") - F.col("inactive_devices"))
    )


def _finish(rows: DataFrame, *flags: str) -> DataFrame:
    """Managers with no staffed device show 0; others without data stay NULL."""
    means = [
        whole(F.when(F.col(c).isNull() & (F.col("_staffed") == 0), F.lit(0.0)).otherwise(F.col(c))).alias(c)
        for c in MEANS
    ]
    return rows.select(*KEYS, *flags, *COUNTS, *means)


def adherence_summary(detail: DataFrame) -> DataFrame:
    """Devices, files and mean percentages per area manager."""
    return _finish(_manager_rows(detail))


def _store_states(detail: DataFrame) -> DataFrame:
    """Per region, store and manager the counts and parts of means that add up to the manager's.

    A device counts once per manager, at the first of its rows. A store without staffed devices has no means."""
    staffed = F.col("staff_name").isNotNull()
    rows_of_device = W.partitionBy(*KEYS, "device").orderBy(F.asc_nulls_last("store"), F.asc_nulls_last("staff_name"))
    rows = detail.where(F.col("manager").isNotNull()).withColumn("_nth", F.row_number().over(rows_of_device))
    parts = [part for name, c in MEANS.items() for part in mean_parts(F.when(staffed, F.col(c)), name)]
    return rows.groupBy("regional_manager_id", "store", "manager").agg(
        count_where((F.col("_nth") == 1) & F.col("device").isNotNull()).alias("total_devices"),
        count_where(~staffed).alias("inactive_devices"),
        sum_or_zero(F.when(staffed, F.col("total_files"))).alias("total_files"),
        count_where(staffed).alias("_staffed"),
        *parts,
    )


def _is_store() -> Column:
    return F.col("store").isNotNull() & (F.col("_staffed") > 0)


def store_summary(detail: DataFrame) -> DataFrame:
    """Mean week figures per store with the alert flag; the halves meet on the store name."""
    means = [whole(half_even(mean_of_parts(name))).alias(name) for name in ("time_log_pct", "blank_pct")]
    stores = _store_states(detail).where(_is_store()).select("regional_manager_id", "store", "manager", *means)
    # The managers of one store name: a few rows, one for each of its area managers.
    named = F.collect_list(F.struct(F.col("manager").alias("blank_manager"), "blank_pct")).over(W.partitionBy("regional_manager_id", "store"))
    flagged = rules.blank_alert(F.col("blank_pct")) | rules.adherence_alert(F.col("time_log_pct"))
    return (
        stores.withColumn("_named", named)
        .select("regional_manager_id", "store", "manager", "time_log_pct", F.inline("_named"))
        .withColumn("flagged", flagged)
    )


def flagged_managers(detail: DataFrame) -> DataFrame:
    """The summary of managers having a flagged store, with a grand total per region.

    A store is flagged by a low time log, or where a store of its name has a high blank share. Devices
    are rolled up to stores, managers and regions in one pass over the detail."""
    same_name = W.partitionBy("regional_manager_id", "store")
    blank, log = (whole(half_even(mean_of_parts(name))) for name in ("blank_pct", "time_log_pct"))
    stores = _store_states(detail).withColumn("_worst", F.max(F.when(_is_store(), blank)).over(same_name))
    flagged = _is_store() & (rules.blank_alert(F.col("_worst")) | rules.adherence_alert(log))
    counts = ["total_devices", "inactive_devices", "total_files", "_staffed"]
    managers = stores.withColumn("_flagged", flagged).groupBy(*KEYS).agg(
        *[F.sum(c).alias(c) for c in counts],
        *[part for name in MEANS for part in added_parts(name)],
        F.max("_flagged").alias("_flagged"),
    )
    rows = managers.where("_flagged").withColumns(
        {
            "active_devices": F.col("total_devices") - F.col("inactive_devices"),
            **{name: half_even(mean_of_parts(name)) for name in MEANS},
        }
    )
    rows = with_total(rows, ["regional_manager_id"], "manager", [*COUNTS, "_staffed"], list(MEANS))
    staffed = F.when(F.col("is_total"), F.lit(None)).otherwise(F.col("_staffed"))
    return _finish(rows.withColumn("_staffed", staffed), "is_total")
