"""Adherence and reason matrices by week of month and recent day, for many tenants in one job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from floortally import constants as C
from floortally.functions import nested as N, periods as P, rules
from floortally.functions.durations import clock_text
from floortally.functions.numbers import count_where, finite_or_zero, half_even, percent_or_zero, sum_or_zero, whole
from floortally.functions.text import title
from floortally.operators.asof import MONTH, MONTH_END, AsOf, as_date, attach
from floortally.operators.joins import split_left_join
from floortally.operators.shaping import positioned, share_of_total
from floortally.operators.temporal import inside_clipped, overlaps
from floortally.operators.totals import mean_of_rounded
from floortally.plans.device_adherence import same_day_audio
from floortally.sources.tables import Tables
from floortally.sources.tenants import Tenant, shift_of, tag, tenant_frame

WEEKS = range(1, 7)
DAYS = range(1, 5)
WEEK_COLUMNS = [f"week_{n}" for n in WEEKS]
DAY_COLUMNS = [f"d_{n}" for n in DAYS]
STAFF_KEYS = ["tenant", "store", "name", "device"]
RATES = ["mtd_adherence_pct", "blank_pct", *WEEK_COLUMNS, *DAY_COLUMNS]


def assignments(t: Tables, tenants: Sequence[Tenant], as_of: dt.date) -> DataFrame:
    """Staff-to-store assignments of the tenants' brands that touch the look-back window."""
    end = as_date(as_of)
    start = P.look_back_start(end)
    brands = t.brands.where(F.col("name").isin([tenant.name for tenant in tenants])).select(
        F.col("id").alias("brand_id"), F.col("name").alias("tenant")
    )
    stores = t.stores.select(F.col("id").alias("store_id"), F.col("name").alias("store"), "brand_id").join(brands, "brand_id")
    staff = t.sales_persons.select(F.col("id").alias("sp_id"), "name")
    devices = t.devices.where(overlaps(F.col("assigned_on"), F.col("unassigned_on"), end, end)).select(
        F.col("sales_person_id").alias("sp_id"), "store_id", F.col("name").alias("device")
    )
    return (
        t.salesperson_stores.where(overlaps(F.col("start_date"), F.col("end_date"), start, end))
        .join(stores, "store_id")
        .join(staff, "sp_id", "left")
        .join(devices, ["sp_id", "store_id"], "left")
        .select("tenant", "sp_id", "store", "name", "device", "start_date", "end_date")
    )


def _tenant_audio(t: Tables, tenants: Sequence[Tenant], as_of: dt.date) -> DataFrame:
    end = as_date(as_of)
    audio = same_day_audio(t, P.look_back_start(end), end).where(F.col("sales_person_id").isNotNull())
    blank = rules.blank_file(F.col("seconds"), F.col("speech_seconds"), "c").alias("blank")
    return tag(audio, tenants, ignore_case=True).select(
        "tenant", F.col("sales_person_id").alias("sp_id"), "id", "date", "seconds", blank
    )


def _inside(as_of: dt.date) -> Column:
    """The recording's date lies in the assignment cut to the look-back window."""
    end = as_date(as_of)
    return inside_clipped(
        F.col("r.date"), F.col("l.start_date"), F.col("l.end_date"), P.look_back_start(end), end
    )


def assignment_audio(t: Tables, tenants: Sequence[Tenant], as_of: dt.date) -> DataFrame:
    """Every recording within its staff member's assignment; idle staff keep one empty row.

    Temporal left join on tenant and staff with a date range, safe for a staff member holding a
    large share of all recordings.
    """
    audio = _tenant_audio(t, tenants, as_of)
    heard = audio.select("tenant", "sp_id", "date").distinct()
    spans = assignments(t, tenants, as_of)
    rows = split_left_join(spans, audio, ["tenant", "sp_id"], _inside(as_of), heard)
    return rows.select(
        *STAFF_KEYS,
        "id",
        "date",
        F.col("seconds").alias("recorded_seconds"),
        F.coalesce("blank", F.lit(0)).alias("blank_file"),
        F.when(F.col("date") >= P.month_start(as_date(as_of)), P.week_label(F.col("date"))).alias("week"),
        P.day_label(F.col("date"), as_date(as_of)).alias("day_label"),
    )


def staff_matrix(t: Tables, tenants: Sequence[Tenant], as_of: dt.date) -> DataFrame:
    """Files and seconds per assigned staff device, month, week and day, in one aggregation.

    Recordings are folded per (tenant, staff, day) before the temporal join, so it handles at
    most a month of rows per staff member whatever the number of files.
    """
    audio = (
        _tenant_audio(t, tenants, as_of)
        .groupBy("tenant", "sp_id", "date")
        .agg(F.count("id").alias("files"), F.sum("blank").alias("blank"), F.sum("seconds").alias("seconds"))
    )
    spans, daily = assignments(t, tenants, as_of).alias("l"), audio.alias("r")
    same = [F.col("l.tenant") == F.col("r.tenant"), F.col("l.sp_id") == F.col("r.sp_id"), _inside(as_of)]
    rows = spans.join(daily, same, "left").select("l.*", "r.date", "r.files", "r.blank", "r.seconds")
    for key in STAFF_KEYS:
        rows = rows.where(F.col(key).isNotNull())
    end, day = as_date(as_of), F.col("date")
    in_month = day >= P.month_start(end)
    seconds = F.col("seconds")
    return rows.groupBy(*STAFF_KEYS).agg(
        sum_or_zero(F.col("files")).alias("total_files"),
        sum_or_zero(F.col("blank")).alias("blank_files"),
        F.coalesce(F.sum(F.when(in_month, seconds)), F.lit(0.0)).alias("mtd_seconds"),
        *[
            F.coalesce(F.sum(F.when(in_month & (P.week_of_month(day) == n), seconds)), F.lit(0.0)).alias(f"week_{n}")
            for n in WEEKS
        ],
        *[F.coalesce(F.sum(F.when(P.days_ago(day, end) == n, seconds)), F.lit(0.0)).alias(f"d_{n}") for n in DAYS],
    )


def _working_days(as_of: dt.date, number: int) -> Column:
    """Days of the month's week `number` elapsed at `as_of`, a constant after folding."""
    end, first, n = as_date(as_of), P.month_start(as_date(as_of)), F.lit(number)
    return P.days_elapsed(P.week_start(first, n), P.week_end(first, n), end)


def adherence_matrix(t: Tables, tenants: Sequence[Tenant], as_of: dt.date) -> DataFrame:
    """Blank %, month hours and adherence by month, week and day, with bands."""
    shift = shift_of(F.col("tenant"), tenants)
    end = as_date(as_of)
    month_days = P.days_between(P.month_start(end), end)
    rows = staff_matrix(t, tenants, as_of)
    share = F.try_divide(F.col("blank_files"), F.col("total_files")) * 100
    rates = {"mtd_adherence_pct": percent_or_zero(F.col("mtd_seconds"), month_days * shift, 1)}
    rates |= {f"week_{n}": percent_or_zero(F.col(f"week_{n}"), _working_days(as_of, n) * shift, 1) for n in WEEKS}
    rates |= {f"d_{n}": percent_or_zero(F.col(f"d_{n}"), shift, 1) for n in DAYS}
    table = rows.select(
        *STAFF_KEYS,
        "mtd_seconds",
        clock_text(F.col("mtd_seconds"), 1).alias("mtd_hours"),
        "blank_files",
        "total_files",
        half_even(finite_or_zero(share), 1).alias("blank_pct"),
        *[value.alias(name) for name, value in rates.items()],
    )
    return table.withColumns({f"{name}_band": rules.band(F.col(name)) for name in rates})


def blank_percentages(t: Tables, tenants: Sequence[Tenant], as_of: dt.date) -> DataFrame:
    """Blank-file share per store, staff member and device."""
    return adherence_matrix(t, tenants, as_of).select(*STAFF_KEYS, "blank_files", "total_files", "blank_pct")


def month_hours(t: Tables, tenants: Sequence[Tenant], as_of: dt.date) -> DataFrame:
    """Recorded hours and adherence of the month to date."""
    return adherence_matrix(t, tenants, as_of).select(*STAFF_KEYS, "mtd_seconds", "mtd_hours", "mtd_adherence_pct")


def week_matrix(t: Tables, tenants: Sequence[Tenant], as_of: dt.date) -> DataFrame:
    """Adherence per week of the month."""
    return adherence_matrix(t, tenants, as_of).select(*STAFF_KEYS, *WEEK_COLUMNS)


def day_matrix(t: Tables, tenants: Sequence[Tenant], as_of: dt.date) -> DataFrame:
    """Adherence of the last four days."""
    return adherence_matrix(t, tenants, as_of).select(*STAFF_KEYS, *DAY_COLUMNS)


def headline_of(table: DataFrame, tenants: Sequence[Tenant]) -> DataFrame:
    """Headline figures of a finished adherence matrix; 0 for an idle tenant."""
    figures = table.groupBy("tenant").agg(
        whole(half_even(mean_of_rounded(F.col("d_1")))).alias("avg_adherence"),
        count_where(F.col("d_1") > 0).alias("active_staff"),
        F.count(F.lit(1)).alias("total_staff"),
    )
    return tenant_frame(table.sparkSession, tenants).select("tenant").join(figures, "tenant", "left").na.fill(0)


def headline(t: Tables, tenants: Sequence[Tenant], as_of: dt.date) -> DataFrame:
    """Mean adherence of the as-of day, staff heard that day and all staff, per tenant."""
    return headline_of(adherence_matrix(t, tenants, as_of), tenants)


def _category_matrix(calls: DataFrame, array: str, tenants: Sequence[Tenant], as_of: AsOf) -> DataFrame:
    """Month count, share and week/day counts per category, folded per day before the as-of key."""
    categories = N.texts(calls, array, "category")
    daily = (
        tag(calls.select("path", "date", F.explode_outer(categories).alias("category")), tenants)
        .where(F.col("category").isNotNull())
        .groupBy("tenant", "date", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows, day, n = attach(daily, as_of, MONTH), F.col("date"), F.col("n")
    ago = P.days_ago(day, F.col("as_of"))
    counts = rows.groupBy("tenant", "as_of", "category").agg(
        F.sum("n").alias("mtd"),
        *[sum_or_zero(F.when(P.week_of_month(day) == w, n)).alias(f"week_{w}") for w in WEEKS],
        *[sum_or_zero(F.when(ago == d, n)).alias(f"d_{d}") for d in DAYS],
    )
    shares = share_of_total(counts, ["tenant", "as_of"], "mtd", "contribution_pct", 1)
    return positioned(shares, ["tenant", "as_of"], [F.desc("contribution_pct"), F.asc("category")])


def reason_matrix(t: Tables, tenants: Sequence[Tenant], as_of: AsOf = MONTH_END) -> DataFrame:
    """Loss reasons of the month with share, week and day counts, largest share first."""
    lost = t.interactions.where(F.col("sales_outcome") == C.LOST_CALL_OUTCOME)
    return _category_matrix(lost, "reason_loss_of_sale", tenants, as_of).select(
        "tenant", "as_of", F.col("category").alias("reason"), "mtd", "contribution_pct", *WEEK_COLUMNS, *DAY_COLUMNS, "position"
    )


def objection_matrix(t: Tables, tenants: Sequence[Tenant], as_of: AsOf = MONTH_END) -> DataFrame:
    """Objections of the month, labelled for display."""
    return _category_matrix(t.interactions, "customer_objection_handling", tenants, as_of).select(
        "tenant",
        "as_of",
        title(F.col("category")).alias("objection"),
        "mtd",
        "contribution_pct",
        *WEEK_COLUMNS,
        *DAY_COLUMNS,
        "position",
    )
