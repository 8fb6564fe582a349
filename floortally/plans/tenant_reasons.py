"""Outcome totals, loss-reason and objection tables of many tenants in one job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from floortally import constants as C
from floortally.functions import nested as N
from floortally.functions.numbers import count_where, percent_or_zero, sum_or_zero
from floortally.operators.asof import DAILY, DAY, MONTH, MONTH_END, WEEK, WEEK_OR_MONTH, AsOf, as_date, attach, on_days, within
from floortally.operators.code_lists import code_counts, code_list, listed
from floortally.operators.shaping import append
from floortally.plans.lost_sales import long_calls
from floortally.sources.tables import Tables
from floortally.sources.tenants import Tenant, tag, tenant_frame

KEYS = ["tenant", "as_of"]


CALL_COLUMNS = ["tenant", "date", "sales_outcome", "interaction_code", "reason_loss_of_sale", "customer_objection_handling"]


def tenant_calls(t: Tables, tenants: Sequence[Tenant], days: Sequence[dt.date]) -> DataFrame:
    """Long calls of some days with their tenant: the rows every tenant report is made of. Bound as the role
    `tenant_calls`, they take the place of the interactions."""
    return tag(long_calls(t.interactions).where(on_days(F.col("date"), days)), tenants).select(*CALL_COLUMNS)


def _tenant_calls(t: Tables, tenants: Sequence[Tenant]) -> DataFrame:
    if "tenant_calls" in t:
        return t.tenant_calls.where(F.col("tenant").isin([tenant.name for tenant in tenants]))
    return tag(long_calls(t.interactions), tenants)


def _with_idle(rows: DataFrame, tenants: Sequence[Tenant], as_of: AsOf) -> DataFrame:
    """For a report of one day, a row with nothing but its keys for every configured tenant, so that
    tenants without a call keep their zero rows. A history has the days on which there were calls."""
    if as_of in (DAILY, MONTH_END):
        return rows
    keys = tenant_frame(rows.sparkSession, tenants).select("tenant", as_date(as_of).alias("as_of"))
    return append(rows, keys)


def outcome_totals(t: Tables, tenants: Sequence[Tenant], as_of: AsOf = DAILY) -> DataFrame:
    """Calls per outcome, with the tenant's total and lost calls of the day."""
    counts = (
        attach(_tenant_calls(t, tenants), as_of, DAY)
        .groupBy(*KEYS, "sales_outcome")
        .agg(F.count("interaction_code").alias("interactions"))
    )
    day = W.partitionBy(*KEYS)
    lost = F.when(F.col("sales_outcome") == C.LOST_CALL_OUTCOME, F.col("interactions"))
    return counts.withColumns(
        {
            "total_interactions": F.sum("interactions").over(day),
            "total_unsuccessful": F.coalesce(F.sum(lost).over(day), F.lit(0)),
        }
    )


def _categorised_calls(t: Tables, tenants: Sequence[Tenant], as_of: AsOf) -> DataFrame:
    """Calls of the day with the loss categories of the lost ones."""
    calls = attach(_tenant_calls(t, tenants), as_of, DAY)
    lost = F.col("sales_outcome") == C.LOST_CALL_OUTCOME
    calls = calls.withColumn("lost", lost)
    categories = F.when(F.col("lost"), N.texts(calls, "reason_loss_of_sale", "category"))
    return N.parsed(calls, [*KEYS, "lost", "interaction_code"], categories=categories)


def reasons_of_day(t: Tables, tenants: Sequence[Tenant], as_of: AsOf = DAILY, lists: bool = False) -> DataFrame:
    """Fixed loss categories with row count and share of the lost calls, from one aggregate per tenant and day.

    With `lists`, the codes behind each count as well, one entry per row; `part` is 0, as a cell holds its whole list."""
    calls = _categorised_calls(t, tenants, as_of)
    counts = [N.occurrences(F.col("categories"), name).alias(f"n_{i}") for i, name in enumerate(C.LOSS_CATEGORIES)]
    known_loss = (F.col("lost") & F.col("interaction_code").isNotNull()).alias("known_loss")
    rows = _with_idle(calls.select(*KEYS, listed("interaction_code").alias("code"), known_loss, *counts), tenants, as_of)
    lost = count_where(F.col("known_loss")).alias("lost_calls")
    sums = [sum_or_zero(F.col(f"n_{i}")).alias(f"n_{i}") for i in range(len(C.LOSS_CATEGORIES))]
    codes = []
    if lists:
        rows = rows.groupBy(*KEYS, "code").agg(lost, *sums)
        lost = sum_or_zero(F.col("lost_calls")).alias("lost_calls")
        codes = [code_list("code", f"n_{i}").alias(f"codes_{i}") for i in range(len(C.LOSS_CATEGORIES))]
    days = rows.groupBy(*KEYS).agg(lost, *sums, *codes)
    names = {"interactions": "n", "interaction_codes": "codes"} if lists else {"interactions": "n"}
    cells = [
        F.struct(F.lit(category).alias("category"), *[F.col(f"{x}_{i}").alias(name) for name, x in names.items()])
        for i, category in enumerate(C.LOSS_CATEGORIES)
    ]
    share = percent_or_zero(F.col("interactions"), F.col("lost_calls"), 1).alias("pct")
    listing = [F.lit(0).cast("bigint").alias("part"), "interaction_codes"] if lists else []
    return days.select(*KEYS, "lost_calls", F.inline(F.array(*cells))).select(*KEYS, "category", "interactions", share, *listing)


def reason_codes(t: Tables, tenants: Sequence[Tenant], as_of: AsOf = DAILY) -> DataFrame:
    """The call codes behind each count of the day's loss categories, with the rows of each."""
    rows = _categorised_calls(t, tenants, as_of).select(*KEYS, "interaction_code", F.explode("categories").alias("category"))
    return code_counts(rows.where(F.col("category").isin(C.LOSS_CATEGORIES)), [*KEYS, "category"], "interaction_code")


def daily_reasons(t: Tables, tenants: Sequence[Tenant]) -> DataFrame:
    """Coded rows of lost calls per tenant, day and loss category (NULL for any other). It adds up over days;
    bound as the role `tenant_reasons` it serves every report of a period."""
    if "tenant_reasons" in t:
        return t.tenant_reasons.where(F.col("tenant").isin([tenant.name for tenant in tenants]))
    calls = _tenant_calls(t, tenants).where(F.col("sales_outcome") == C.LOST_CALL_OUTCOME)
    category = F.explode_outer(N.texts(calls, "reason_loss_of_sale", "category")).alias("category")
    known = F.col("category").isin(C.LOSS_CATEGORIES)
    return (
        calls.select("tenant", "date", "interaction_code", category)
        .withColumn("category", F.when(known, F.col("category")))
        .groupBy("tenant", "date", "category")
        .agg(F.count("interaction_code").alias("n"))
    )


def reason_trend(t: Tables, tenants: Sequence[Tenant], as_of: AsOf = DAILY) -> DataFrame:
    """Fixed loss categories week and month to date; absent ones are 0.

    One wide aggregate holds every (category, period) cell and is then turned into rows,
    so neither an outer join of the periods nor a domain join is needed.
    """
    category = F.col("category")
    daily = daily_reasons(t, tenants)
    cells = []
    for i, name in enumerate(C.LOSS_CATEGORIES):
        for label, period in (("wtd", WEEK), ("mtd", MONTH)):
            cells.append(sum_or_zero(F.when((category == name) & within(period), F.col("n"))).alias(f"{label}_{i}"))
    wide = _with_idle(attach(daily, as_of, WEEK_OR_MONTH), tenants, as_of).groupBy(*KEYS).agg(*cells)
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("category"), F.col(f"wtd_{i}").alias("wtd"), F.col(f"mtd_{i}").alias("mtd"))
            for i, name in enumerate(C.LOSS_CATEGORIES)
        ]
    )
    return wide.select(*KEYS, F.inline(rows))


def _objections(t: Tables, tenants: Sequence[Tenant], as_of: AsOf) -> DataFrame:
    """Objections raised in the day's calls, one row each; a call without one keeps a row."""
    calls = attach(_tenant_calls(t, tenants), as_of, DAY)
    raised = N.objects(calls, "customer_objection_handling", "category", "handling")
    return calls.select(*KEYS, "interaction_code", F.explode_outer(raised).alias("objection")).select(
        *KEYS, "interaction_code", "objection.category", "objection.handling"
    )


def objection_handling(t: Tables, tenants: Sequence[Tenant], as_of: AsOf = DAILY, lists: bool = False) -> DataFrame:
    """Fixed objection categories x handlings, and all objections, from one aggregate per tenant and day.

    With `lists`, the codes behind each count as well, one entry per row; `part` is 0, as a cell holds its whole list."""
    category, handling = F.col("category"), F.col("handling")
    rows = _with_idle(_objections(t, tenants, as_of), tenants, as_of)
    total = count_where(category.isNotNull() & ~category.isin(C.NO_OBJECTION)).alias("total_objections")
    counts = {
        f"{way.lower()}_count_{i}": count_where((category == name) & (handling == way))
        for i, name in enumerate(C.OBJECTION_CATEGORIES)
        for way in C.HANDLINGS
    }
    sums = [count.alias(name) for name, count in counts.items()]
    names = [f"{way.lower()}_count" for way in C.HANDLINGS]
    if lists:
        rows = rows.groupBy(*KEYS, listed("interaction_code").alias("code")).agg(total, *sums)
        total = sum_or_zero(F.col("total_objections")).alias("total_objections")
        sums = [sum_or_zero(F.col(name)).alias(name) for name in counts]
        sums += [code_list("code", name).alias(name.replace("count", "codes")) for name in counts]
        names += [f"{way.lower()}_codes" for way in C.HANDLINGS]
    days = rows.groupBy(*KEYS).agg(total, *sums)
    cells = [
        F.struct(F.lit(C.OBJECTION_LABELS[category]).alias("objection"), *[F.col(f"{name}_{i}").alias(name) for name in names])
        for i, category in enumerate(C.OBJECTION_CATEGORIES)
    ]
    part = [F.lit(0).cast("bigint").alias("part")] if lists else []
    return days.select(*KEYS, "total_objections", F.inline(F.array(*cells))).select(*KEYS, "objection", *part, *names, "total_objections")


def objection_codes(t: Tables, tenants: Sequence[Tenant], as_of: AsOf = DAILY) -> DataFrame:
    """The call codes behind each cell of the objection table, with the rows of each."""
    rows = _objections(t, tenants, as_of)
    rows = rows.where(F.col("category").isin(C.OBJECTION_CATEGORIES) & F.col("handling").isin(C.HANDLINGS))
    labels = F.create_map(*[F.lit(x) for pair in C.OBJECTION_LABELS.items() for x in pair])
    rows = rows.withColumn("objection", labels[F.col("category")])
    return code_counts(rows, [*KEYS, "objection", "handling"], "interaction_code")
