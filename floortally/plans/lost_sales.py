"""Lost-sale follow-ups, reason counts and product-category tables of one tenant's flags."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from floortally import constants as C
from floortally.functions import nested as N
from floortally.functions.durations import parse_milliseconds
from floortally.functions.numbers import percent_or_zero, sum_or_zero, whole
from floortally.functions.text import not_blank
from floortally.operators.asof import DAILY, DAY, MONTH, WEEK, WEEK_OR_MONTH, AsOf, Period, as_date, attach, on_days, within
from floortally.operators.code_lists import code_counts, code_list, listed
from floortally.operators.shaping import positioned, share_of_total, top_k
from floortally.sources.tables import Tables

# Short column prefixes for the follow-up issues, in the order of the fixed list.
ISSUE_PREFIXES = dict(zip(C.FOLLOW_UP_ISSUES, ["uncertainty", "deferred", "glitch"]))


def long_calls(calls: DataFrame) -> DataFrame:
    """Calls above three minutes; a duration that is no number does not count."""
    return calls.where(parse_milliseconds(F.col("duration")) > C.MIN_CALL_MS)


def lost_flags(t: Tables) -> DataFrame:
    """Flags of lost sales, their id named `flag_id`."""
    flags = t.interaction_flags.withColumnRenamed("id", "flag_id")
    return flags.where((F.col("sales_outcome") == C.LOST_FLAG_OUTCOME) & (F.col("type_of_interaction") == C.SALES_TYPE))


FLAG_COLUMNS = ["primary_category_new", "reason_loss_of_sale", "customer_objection_handling"]
CALL_COLUMNS = [
    "interaction_code", "audio_url", "start_time", "end_time", "date", "sales_person_id", "store_id", "phone_number_discussion",
]


def lost_calls(t: Tables, days: Sequence[dt.date]) -> DataFrame:
    """Lost-sale flags with their long calls of some days: the rows every lost-sale report is made of.

    Bound as the role `lost_calls`, they take the place of both facts."""
    calls = long_calls(t.interactions).where(on_days(F.col("date"), days)).select("id", *CALL_COLUMNS)
    flags = lost_flags(t).select("flag_id", "interaction_id", *FLAG_COLUMNS)
    return flags.join(calls, flags.interaction_id == calls.id).drop("id", "interaction_id")


Part = Callable[[DataFrame, list[str]], DataFrame]


def _flagged_calls(t: Tables, as_of: AsOf, period: Period, of_flags: Part, of_calls: Part, names: Sequence[str]) -> DataFrame:
    """Lost-sale flags with the named columns of their long calls. `of_flags` and `of_calls` keep columns and add
    what a report needs of either side; over the facts that is done before the join, which moves only that."""
    if "lost_calls" in t:
        rows = attach(t.lost_calls, as_of, period)
        rows = of_flags(rows, rows.columns)
        return of_calls(rows, rows.columns)
    flags = of_flags(lost_flags(t), ["flag_id", "interaction_id"])
    calls = of_calls(attach(long_calls(t.interactions), as_of, period), list(dict.fromkeys(["id", "as_of", *names])))
    return flags.join(calls, flags.interaction_id == calls.id).drop(calls.id)


def _as_they_are(rows: DataFrame, kept: list[str]) -> DataFrame:
    return rows.select(*kept)


def _issue_count(i: int) -> Column:
    return F.col(f"n_{i}")


def _has_issue() -> Column:
    return sum((_issue_count(i) for i in range(1, len(C.FOLLOW_UP_ISSUES))), _issue_count(0)) > 0


def _with_issues(flags: DataFrame, kept: list[str]) -> DataFrame:
    """The number of reasons, and how often each follow-up issue is among them."""
    rows = N.parsed(flags, kept, issues=N.texts(flags, "reason_loss_of_sale", "sub_category"))
    counts = [N.occurrences(F.col("issues"), issue).alias(f"n_{i}") for i, issue in enumerate(C.FOLLOW_UP_ISSUES)]
    return rows.select(*kept, F.coalesce(F.size("issues"), F.lit(0)).alias("n_reasons"), *counts)


def _with_phones(calls: DataFrame, kept: list[str]) -> DataFrame:
    """The number of phone numbers exchanged."""
    rows = N.parsed(calls, kept, exchanged=N.texts(calls, "phone_number_discussion", "phone_number_exchange"))
    return rows.select(*kept, N.occurrences(F.col("exchanged"), "true").alias("n_phones"))


def follow_ups(t: Tables, as_of: AsOf = DAILY) -> DataFrame:
    """One row per follow-up call, exchanged phone number and loss reason."""
    names = ["audio_url", "interaction_code", "start_time", "end_time", "date", "sales_person_id", "store_id"]

    def reasons(flags: DataFrame, kept: list[str]) -> DataFrame:
        raw = [c for c in ("primary_category_new", "customer_objection_handling") if c not in kept]
        rows = N.parsed(flags, [*kept, *raw], reasons=N.objects(flags, "reason_loss_of_sale", "category", "reason", "sub_category"))
        return rows.where(N.any_in(F.col("reasons.sub_category"), C.FOLLOW_UP_ISSUES))

    def phones(calls: DataFrame, kept: list[str]) -> DataFrame:
        found = N.objects(calls, "phone_number_discussion", "phone_number", "exchange_context", "phone_number_exchange")
        rows = N.parsed(calls, kept, phones=found)
        return rows.where(N.any_in(F.col("phones.phone_number_exchange"), ["true"]))

    staff = t.sales_persons.select(F.col("id").alias("sales_person_id"), F.col("name").alias("se_name"))
    stores = t.stores.select(F.col("id").alias("store_id"), F.col("name").alias("store_name"))
    return (
        _flagged_calls(t, as_of, DAY, reasons, phones, names)
        .join(staff, "sales_person_id", "left")
        .join(stores, "store_id", "left")
        .withColumn("phone", F.explode("phones"))
        .where(F.col("phone.phone_number_exchange") == "true")
        .withColumn("loss", F.explode("reasons"))
        .select(
            "as_of",
            "audio_url",
            "interaction_code",
            "start_time",
            "end_time",
            "date",
            "se_name",
            "store_name",
            "primary_category_new",
            "phone.phone_number",
            "phone.exchange_context",
            "loss.category",
            "loss.sub_category",
            "loss.reason",
            "customer_objection_handling",
        )
    )


def unsuccessful_total(t: Tables, as_of: AsOf = DAILY) -> DataFrame:
    """Lost-sale flags of long calls per as-of day (a single date always gives a row)."""
    rows = _flagged_calls(t, as_of, DAY, _as_they_are, _as_they_are, [])
    count = F.count("flag_id").alias("interaction_count")
    if isinstance(as_of, dt.date):
        return rows.agg(count).select(as_date(as_of).alias("as_of"), "interaction_count")
    return rows.groupBy("as_of").agg(count)


def _counted_issues(t: Tables, as_of: AsOf) -> DataFrame:
    """Lost-sale flags of long calls with the rows they stand for per issue, one per phone exchange and reason."""
    rows = _flagged_calls(t, as_of, DAY, _with_issues, _with_phones, ["interaction_code"])
    counts = [(F.col("n_phones") * _issue_count(i)).alias(f"n_{i}") for i in range(len(C.FOLLOW_UP_ISSUES))]
    return rows.select("as_of", "flag_id", "interaction_code", *counts)


def _issue_rows(lists: bool = False) -> Column:
    """One row per follow-up issue from the columns n_0, n_1, ... (and codes_0, codes_1, ...) of a group or flag."""
    names = ["n", "codes"] if lists else ["n"]
    rows = [F.struct(F.lit(issue).alias("sub_category"), *[F.col(f"{x}_{i}").alias(x) for x in names]) for i, issue in enumerate(C.FOLLOW_UP_ISSUES)]
    return F.inline(F.array(*rows))


def reason_summary(t: Tables, as_of: AsOf = DAILY, lists: bool = False) -> DataFrame:
    """R2: per follow-up issue the row count and its share of the day's lost sales, from one aggregate over one join.

    With `lists`, the codes behind each count as well, one entry per row; `part` is 0, as a cell holds its whole list."""
    sums = [sum_or_zero(_issue_count(i)).alias(f"n_{i}") for i in range(len(C.FOLLOW_UP_ISSUES))]
    rows = _counted_issues(t, as_of)
    total = F.count("flag_id")
    if lists:
        rows = rows.groupBy("as_of", listed("interaction_code").alias("code")).agg(total.alias("flags"), *sums)
        total = sum_or_zero(F.col("flags"))
        sums += [code_list("code", f"n_{i}").alias(f"codes_{i}") for i in range(len(C.FOLLOW_UP_ISSUES))]
    total = total.alias("interaction_count")
    if isinstance(as_of, dt.date):
        days = rows.agg(total, *sums).withColumn("as_of", as_date(as_of))
    else:
        days = rows.groupBy("as_of").agg(total, *sums)
    issues = days.select("as_of", "interaction_count", _issue_rows(lists))
    columns = ["as_of", "sub_category", F.col("n").alias("interactions"), percent_or_zero(F.col("n"), F.col("interaction_count"), 1).alias("pct")]
    if lists:
        columns += [F.lit(0).cast("bigint").alias("part"), F.col("codes").alias("interaction_codes")]
    return issues.select(*columns)


def reason_codes(t: Tables, as_of: AsOf = DAILY) -> DataFrame:
    """R2: the call codes behind each count of the reason summary, with the rows of each."""
    rows = _counted_issues(t, as_of).select("as_of", "interaction_code", _issue_rows()).where("n > 0")
    return code_counts(rows, ["as_of", "sub_category"], "interaction_code", F.col("n"))


def phone_follow_ups(t: Tables, as_of: AsOf = DAILY) -> DataFrame:
    """R1 headline: lost sales of the day and the follow-up rows with a phone number, as `follow_ups` lists them."""
    rows = _flagged_calls(t, as_of, DAY, _with_issues, _with_phones, [])
    named = F.when(_has_issue(), F.col("n_reasons")).otherwise(0)
    counts = [
        F.count("flag_id").alias("interaction_count"),
        sum_or_zero(F.col("n_phones") * named).alias("phone_rows"),
    ]
    if isinstance(as_of, dt.date):
        return rows.agg(*counts).select(as_date(as_of).alias("as_of"), "interaction_count", "phone_rows")
    return rows.groupBy("as_of").agg(*counts)


REASONS, PRODUCTS = "reason", "product"
_LABELS = {REASONS: ("reason_loss_of_sale", "sub_category"), PRODUCTS: ("primary_category_new", "category")}


def lost_labels(t: Tables, as_of: AsOf = DAILY) -> DataFrame:
    """Per day, kind of label (loss reason or product), label and call code, the rows they stand for.

    A partial aggregate that adds up over days; bound as the role `lost_labels` it serves every report of a period."""
    kinds = [_labels(t, kind, as_of, DAY).withColumn("kind", F.lit(kind)) for kind in _LABELS]
    rows = kinds[0].unionByName(kinds[1])
    return rows.groupBy("date", "kind", "label", "interaction_code").agg(F.sum("n").alias("n"))


def _labels(t: Tables, kind: str, as_of: AsOf = DAILY, period: Period = DAY) -> DataFrame:
    """Dates, labels (NULL for none) and codes of lost-sale calls, with the rows `n` they stand for."""
    if "lost_labels" in t:
        rows = t.lost_labels.where(F.col("kind") == kind)
        if isinstance(as_of, dt.date):
            rows = attach(rows, as_of, period)
        return rows.select("date", "label", "interaction_code", "n")

    def labels(flags: DataFrame, kept: list[str]) -> DataFrame:
        return flags.select(*kept, N.texts(flags, *_LABELS[kind]).alias("labels"))

    days = as_of if isinstance(as_of, dt.date) else DAILY
    rows = _flagged_calls(t, days, period if isinstance(as_of, dt.date) else DAY, labels, _as_they_are, ["interaction_code", "date"])
    return rows.select("date", F.explode_outer("labels").alias("label"), "interaction_code", F.lit(1).cast("bigint").alias("n"))


def _daily_reasons(t: Tables, as_of: AsOf, period: Period) -> DataFrame:
    """Rows with a code per day and loss reason."""
    coded = F.when(F.col("interaction_code").isNotNull(), F.col("n")).otherwise(0)
    rows = _labels(t, REASONS, as_of, period).withColumnRenamed("label", "category")
    return rows.groupBy("date", "category").agg(F.sum(coded).alias("n"))


def reason_trend(t: Tables, as_of: AsOf = DAILY) -> DataFrame:
    """Loss-reason rows week-to-date and month-to-date from one scan of the wider window."""
    return (
        attach(_daily_reasons(t, as_of, WEEK_OR_MONTH), as_of, WEEK_OR_MONTH)
        .groupBy("as_of", "category")
        .agg(
            F.sum(F.when(within(WEEK), F.col("n"))).alias("wtd"),
            F.sum(F.when(within(MONTH), F.col("n"))).alias("mtd"),
        )
    )


def top_reasons(t: Tables, as_of: AsOf = DAILY, period: Period = MONTH, k: int = 3) -> DataFrame:
    """The k most frequent loss reasons of the month or week to date."""
    daily = attach(_daily_reasons(t, as_of, period), as_of, period)
    counts = daily.groupBy("as_of", "category").agg(F.sum("n").alias("interactions"))
    return top_k(counts, ["as_of"], "interactions", "category", k).select(
        "as_of", "category", "interactions", "rank"
    )


def _counted_categories(t: Tables, as_of: AsOf) -> DataFrame:
    """Follow-up flags per product category. Rows are the product of phone exchanges, categories and reasons of
    a call; exchanges and reasons only multiply the counts, so they travel as numbers instead of being exploded."""

    def categories(flags: DataFrame, kept: list[str]) -> DataFrame:
        kept = [c for c in kept if c != "primary_category_new"]
        issues, products = (N.texts(flags, *x) for x in (("reason_loss_of_sale", "sub_category"), ("primary_category_new", "category")))
        rows = N.parsed(flags, kept, issues=issues, categories=products)
        counts = [N.occurrences(F.col("issues"), issue).alias(f"n_{i}") for i, issue in enumerate(C.FOLLOW_UP_ISSUES)]
        return rows.select(*kept, "categories", *counts).where(_has_issue())

    def phones(calls: DataFrame, kept: list[str]) -> DataFrame:
        return _with_phones(calls, kept).where("n_phones > 0")

    rows = _flagged_calls(t, as_of, DAY, categories, phones, ["interaction_code"])
    rows = rows.withColumn("prod_category", F.explode("categories")).where(not_blank(F.col("prod_category")))
    weighted = [(F.col("n_phones") * _issue_count(i)).alias(f"n_{i}") for i in range(len(C.FOLLOW_UP_ISSUES))]
    return rows.select("as_of", "prod_category", "interaction_code", *weighted)


def category_issues(t: Tables, as_of: AsOf = DAILY, lists: bool = False) -> DataFrame:
    """Product category x follow-up issue, the number of rows in each cell.

    With `lists`, the distinct codes of each cell as well; `part` is 0, as a cell holds its whole list."""
    keys = ["as_of", "prod_category"]
    rows = _counted_categories(t, as_of)
    cells = [sum_or_zero(_issue_count(i)).alias(f"{prefix}_count") for i, prefix in enumerate(ISSUE_PREFIXES.values())]
    if lists:
        sums = [sum_or_zero(_issue_count(i)).alias(f"n_{i}") for i in range(len(C.FOLLOW_UP_ISSUES))]
        rows = rows.groupBy(*keys, listed("interaction_code").alias("code")).agg(*sums)
        codes = [code_list("code", f"n_{i}", distinct=True).alias(f"{prefix}_codes") for i, prefix in enumerate(ISSUE_PREFIXES.values())]
        cells += [F.lit(0).cast("bigint").alias("part"), *codes]
    return rows.groupBy(*keys).agg(*cells)


def category_codes(t: Tables, as_of: AsOf = DAILY) -> DataFrame:
    """The call codes behind each cell of the product-category table, with the rows of each."""
    keys = ["as_of", "prod_category"]
    rows = _counted_categories(t, as_of).select(*keys, "interaction_code", _issue_rows()).where("n > 0")
    return code_counts(rows, [*keys, "sub_category"], "interaction_code", F.col("n"))


def _first_seen(t: Tables, kind: str, as_of: AsOf) -> DataFrame:
    """Per day and label, the calls not seen before in the day's month and in its week.

    A report of one day looks no further back than its week and month, as earlier dates decide nothing there.

    A code may recur on a later date, so distinct codes of days do not add up; but a period that
    ends on any as-of day begins on the day's own first, so its distinct codes are those whose
    previous date lies before that first.
    """
    rows = _labels(t, kind, as_of, WEEK_OR_MONTH).where(F.col("interaction_code").isNotNull())
    days = rows.select("date", "label", "interaction_code").distinct()
    before = F.lag("date").over(W.partitionBy("label", "interaction_code").orderBy("date"))
    new = {
        name: (F.col("_before").isNull() | (F.col("_before") < period.first(F.col("date")))).cast("int")
        for name, period in (("new_wtd", WEEK), ("new_mtd", MONTH))
    }
    seen = days.withColumn("_before", before)
    return seen.groupBy("date", "label").agg(*[F.sum(flag).alias(name) for name, flag in new.items()])


def category_trend(t: Tables, as_of: AsOf = DAILY) -> DataFrame:
    """Distinct lost calls per product category, week and month to date, largest month first.

    Categories seen only in the part of the week before the month began are left out.
    """
    daily = _first_seen(t, PRODUCTS, as_of).withColumnRenamed("label", "prod_category")
    daily = daily.where(not_blank(F.col("prod_category")))
    table = (
        attach(daily, as_of, WEEK_OR_MONTH)
        .groupBy("as_of", "prod_category")
        .agg(
            F.sum(F.when(within(WEEK), F.col("new_wtd"))).alias("wtd"),
            F.sum(F.when(within(MONTH), F.col("new_mtd"))).alias("mtd"),
        )
        .where(F.col("mtd").isNotNull())
    )
    return positioned(table, ["as_of"], [F.desc("mtd"), F.asc("prod_category")])


def top_reasons_of_day(t: Tables, as_of: AsOf = DAILY, k: int = 5) -> DataFrame:
    """The day's top reasons by distinct calls and their share of the top-k subtotal."""
    rows = _labels(t, REASONS, as_of, DAY).withColumnRenamed("label", "category")
    daily = rows.groupBy("date", "category").agg(F.countDistinct("interaction_code").alias("interactions"))
    top = top_k(attach(daily, as_of, DAY).drop("date"), ["as_of"], "interactions", "category", k)
    return share_of_total(top, ["as_of"], "interactions", "share_pct", 0).select(
        "as_of", "category", "interactions", "rank", whole(F.col("share_pct")).alias("share_pct")
    )
