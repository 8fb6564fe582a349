"""Scheme pitch -> sale funnel per area manager and staff member."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from floortally import constants as C
from floortally.functions import nested as N
from floortally.functions.numbers import half_even, parse_number, percent_or_zero, sum_or_zero, whole
from floortally.functions.periods import month_start
from floortally.operators.asof import as_date, on_days
from floortally.operators.shaping import append, min_max_heat, nulls_last, pinned_order, positioned
from floortally.operators.temporal import valid_on
from floortally.operators.totals import grouped_with_total
from floortally.plans.lost_sales import long_calls
from floortally.plans.organisation import in_regions, store_chain
from floortally.sources.tables import Tables

KEYS = ["regional_manager_id", "manager"]
WINDOW_DAYS = 6
FLAGS = ["gms_pitched", "gms_sold", *C.SCHEME_BENEFITS]


def _window_start(as_of: dt.date) -> Column:
    return F.date_sub(as_date(as_of), WINDOW_DAYS)


def scheme_steps(t: Tables, days: Sequence[dt.date]) -> DataFrame:
    """Scheme elements of the long calls of some days: the rows every funnel report is made of. Bound as the
    role `scheme_steps`, they take the place of both facts."""
    rows = _scheme_rows(t, as_date(min(days)), as_date(max(days)), *FLAGS).where(on_days(F.col("date"), days))
    return rows.select("id", "interaction_code", "date", "store_id", "sales_person_id", "step")


def seller_days(t: Tables, days: Sequence[dt.date]) -> DataFrame:
    """Calls, pitches and sales per day, store and seller; bound as the role `seller_days` they add up to any period."""
    rows = _scheme_rows(t, as_date(min(days)), as_date(max(days)), "gms_pitched", "gms_sold").where(on_days(F.col("date"), days))
    return rows.groupBy("date", "store_id", "sales_person_id").agg(
        F.count("id").alias("interactions"),
        *[F.sum(N.int_field(F.col("step"), f"gms_{c}")).alias(c) for c in ("pitched", "sold")],
    )


def _scheme_rows(t: Tables, first: Column, last: Column, *fields: str) -> DataFrame:
    """One row per scheme element of a long call in the day range; calls without one keep a NULL."""
    if "scheme_steps" in t:
        return t.scheme_steps.where(F.col("date").between(first, last))
    flags = t.scheme_flags
    flags = flags.select("id", "interaction_id", N.objects(flags, "sop_new", *fields).alias("sop"))
    calls = (
        long_calls(t.interactions)
        .where(F.col("date").between(first, last))
        .select(F.col("id").alias("call_id"), "interaction_code", "date", "store_id", "sales_person_id")
    )
    return flags.join(calls, flags.interaction_id == calls.call_id).withColumn("step", F.explode_outer("sop"))


def _seller_totals(t: Tables, as_of: dt.date) -> DataFrame:
    """Window and month sums per (store, seller): one scan, folded before any dimension join."""
    end = as_date(as_of)
    first = F.least(_window_start(as_of), month_start(end))
    in_window = F.col("date") >= _window_start(as_of)
    in_month = F.col("date") >= month_start(end)
    measures = []
    if "seller_days" in t:
        for prefix, inside in (("", in_window), ("mtd_", in_month)):
            sums = {c: F.sum(F.when(inside, F.col(c))) for c in ("interactions", "pitched", "sold")}
            sums["interactions"] = F.coalesce(sums["interactions"], F.lit(0))
            measures += [value.alias(f"{prefix}{c}") for c, value in sums.items()]
        return t.seller_days.where(F.col("date").between(first, end)).groupBy("store_id", "sales_person_id").agg(*measures)
    rows = _scheme_rows(t, first, end, "gms_pitched", "gms_sold")
    for prefix, inside in (("", in_window), ("mtd_", in_month)):
        measures += [
            F.count(F.when(inside, F.col("id"))).alias(f"{prefix}interactions"),
            F.sum(F.when(inside, N.int_field(F.col("step"), "gms_pitched"))).alias(f"{prefix}pitched"),
            F.sum(F.when(inside, N.int_field(F.col("step"), "gms_sold"))).alias(f"{prefix}sold"),
        ]
    return rows.groupBy("store_id", "sales_person_id").agg(*measures)


def _manager_measures(t: Tables, as_of: dt.date, regions: Sequence[int] | None) -> DataFrame:
    """Funnel counts per manager for the window and (`mtd_`) the month."""
    rows = in_regions(_seller_totals(t, as_of).join(store_chain(t), "store_id"), regions)
    measures = []
    for prefix in ("", "mtd_"):
        seen = F.col(f"{prefix}interactions") > 0
        measures += [
            F.countDistinct(F.when(seen, F.col("store_id"))).alias(f"{prefix}store_count"),
            F.countDistinct(F.when(seen, F.col("sales_person_id"))).alias(f"{prefix}executive_count"),
            F.sum(f"{prefix}interactions").alias(f"{prefix}interactions"),
            sum_or_zero(F.col(f"{prefix}pitched")).alias(f"{prefix}pitched"),
            sum_or_zero(F.col(f"{prefix}sold")).alias(f"{prefix}sold"),
        ]
    return rows.groupBy(*KEYS).agg(*measures)


def _rates(prefix: str = "") -> dict[str, Column]:
    n, pitched, sold = (F.col(f"{prefix}{c}") for c in ("interactions", "pitched", "sold"))
    return {
        f"{prefix}pitched_pct": whole(percent_or_zero(pitched, n)),
        f"{prefix}sold_pct": whole(percent_or_zero(sold, pitched)),
    }


def _funnel(t: Tables, as_of: dt.date, regions: Sequence[int] | None, prefix: str) -> DataFrame:
    names = ["store_count", "executive_count", "interactions", "pitched", "sold"]
    return (
        _manager_measures(t, as_of, regions)
        .where(F.col(f"{prefix}interactions") > 0)
        .withColumns(_rates(prefix))
        .select(*KEYS, *[F.col(f"{prefix}{c}").alias(c) for c in [*names, "pitched_pct", "sold_pct"]])
    )


def funnel_window(t: Tables, as_of: dt.date, regions: Sequence[int] | None = None) -> DataFrame:
    """Funnel per manager over the seven days to `as_of`."""
    return positioned(_funnel(t, as_of, regions, ""), ["regional_manager_id"], nulls_last(["manager"]))


def funnel_mtd(t: Tables, as_of: dt.date, regions: Sequence[int] | None = None) -> DataFrame:
    """Funnel per manager for the month to date, best sellers first."""
    best = [F.desc("sold_pct"), F.asc_nulls_last("manager")]
    return positioned(_funnel(t, as_of, regions, "mtd_"), ["regional_manager_id"], best)


def active_roster(
    t: Tables, as_of: dt.date, regions: Sequence[int] | None = None, brands: Sequence[int] | None = None
) -> DataFrame:
    """Stores and staff per manager with an assignment valid at `as_of`."""
    on_duty = t.salesperson_stores.where(valid_on(F.col("start_date"), F.col("end_date"), as_date(as_of))).select("sp_id")
    staff = t.sales_persons.select(F.col("id").alias("sp_id"), "store_id")
    chain = store_chain(t)
    if brands is not None:
        chain = chain.where(F.col("brand_id").isin(list(brands)))
    rows = in_regions(on_duty.join(staff, "sp_id").join(chain, "store_id"), regions)
    return rows.groupBy(*KEYS).agg(
        F.countDistinct("store_id").alias("total_store_count"), F.countDistinct("sp_id").alias("total_executive_count")
    )


def combined(
    t: Tables, as_of: dt.date, regions: Sequence[int] | None = None, brands: Sequence[int] | None = None
) -> DataFrame:
    """Roster, month rates and window funnel per manager, with a ratio-of-sums total per region.

    Roster and funnel meet in one group-by over their union (NULL managers meet, as in a
    null-safe merge); managers without calls this month only count towards the totals.
    """
    both = append(active_roster(t, as_of, regions, brands), _manager_measures(t, as_of, regions))
    measures = [c for c in both.columns if c not in KEYS]
    table = grouped_with_total(both, ["regional_manager_id"], "manager", *[F.sum(c).alias(c) for c in measures])
    table = table.where(F.col("is_total") | (F.col("mtd_interactions") > 0))
    window = ["store_count", "executive_count", "interactions", "pitched", "sold"]
    seen = F.col("is_total") | (F.col("interactions") > 0)
    rows = (
        table.withColumns({c: F.when(seen, F.col(c)) for c in window})
        .withColumns({**_rates("mtd_"), **_rates()})
        .withColumns({c: F.when(F.col("interactions").isNotNull(), F.col(c)) for c in ("pitched_pct", "sold_pct")})
        .select(
            *KEYS,
            "is_total",
            "total_store_count",
            "total_executive_count",
            "mtd_pitched_pct",
            "mtd_sold_pct",
            "store_count",
            "executive_count",
            "interactions",
            "pitched",
            "pitched_pct",
            "sold",
            "sold_pct",
        )
    )
    best = [*pinned_order("is_total", "mtd_sold_pct"), F.asc_nulls_last("manager")]
    return positioned(rows, ["regional_manager_id"], best)


def heat(
    t: Tables, as_of: dt.date, regions: Sequence[int] | None = None, brands: Sequence[int] | None = None
) -> DataFrame:
    """Min-max heat of the month rates among a region's managers, the total row left out."""
    rows = combined(t, as_of, regions, brands).where(~F.col("is_total"))
    return min_max_heat(
        rows.select(*KEYS, "mtd_pitched_pct", "mtd_sold_pct"),
        ["regional_manager_id"],
        ["mtd_pitched_pct", "mtd_sold_pct"],
    )


def staff_funnel(t: Tables, as_of: dt.date, regions: Sequence[int] | None = None) -> DataFrame:
    """Window funnel per manager, store and staff member, sorted by them."""
    staff = t.sales_persons.select(F.col("id").alias("sales_person_id"), F.col("name").alias("staff_name"), "email")
    rows = (
        _seller_totals(t, as_of)
        .where(F.col("interactions") > 0)
        .join(store_chain(t), "store_id")
        .join(staff, "sales_person_id", "left")
    )
    names = ["manager", "store", "staff_name", "email"]
    table = (
        in_regions(rows, regions)
        .groupBy("regional_manager_id", *names)
        .agg(
            F.sum("interactions").alias("interactions"),
            sum_or_zero(F.col("pitched")).alias("pitched"),
            sum_or_zero(F.col("sold")).alias("sold"),
        )
    )
    return positioned(table, ["regional_manager_id"], nulls_last(names))


def effectiveness_flags(t: Tables, as_of: dt.date, regions: Sequence[int] | None = None) -> DataFrame:
    """The scheme flags of every call element in the window, as text."""
    staff = t.sales_persons.select(F.col("id").alias("sales_person_id"), F.col("name").alias("sales_person"))
    rows = (
        _scheme_rows(t, _window_start(as_of), as_date(as_of), *FLAGS)
        .join(store_chain(t), "store_id")
        .join(staff, "sales_person_id", "left")
    )
    return in_regions(rows, regions).select(
        *KEYS, "store", "sales_person", "interaction_code", *[f"step.{f}" for f in FLAGS]
    )


def effectiveness(
    t: Tables, as_of: dt.date, sold: bool = False, regions: Sequence[int] | None = None
) -> DataFrame:
    """Share of each benefit explained where the scheme was pitched (or pitched and sold).

    Every manager seen in the window has a row, 0 where nothing was pitched; the total row sums
    the counts and takes the unweighted mean of the managers' shares.
    """
    rows = _scheme_rows(t, _window_start(as_of), as_date(as_of), *FLAGS).join(store_chain(t), "store_id")
    rows = in_regions(rows, regions)
    number = {f: F.col("step")[f].try_cast("double") for f in FLAGS}
    chosen = number["gms_pitched"] == 1
    if sold:
        chosen = chosen & (number["gms_sold"] == 1)
    chosen = chosen & F.col("manager").isNotNull()
    count = "sold" if sold else "pitched"
    hundredths = {
        f: F.coalesce(F.rint(F.avg(F.when(chosen, number[f])) * 100 * 100).cast("bigint"), F.lit(0))
        for f in C.SCHEME_BENEFITS
    }
    table = rows.groupBy(*KEYS).agg(
        F.count(F.when(chosen, F.lit(1))).alias(count), *[value.alias(f) for f, value in hundredths.items()]
    )
    total = F.grouping("manager") == 1
    shares = [
        F.when(total, half_even(F.sum(f) / (F.count(F.lit(1)) * 100.0), 1)).otherwise(F.sum(f) / 100.0).alias(f)
        for f in C.SCHEME_BENEFITS
    ]
    return grouped_with_total(
        table, ["regional_manager_id"], "manager", F.sum(count).alias(count), *shares
    )
