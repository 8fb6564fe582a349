"""As-of keys: the same report for one day, for every day, or for every month end.

A fact row dated `d` belongs to the report of an as-of day `a` when `first(a) <= d <= a`.
With one as-of date that is a range filter (pushed to the scan). For a history the as-of
day becomes a group key: rows are first rolled up per day, and only those few rolled-up rows
are repeated for the as-of days that see them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from floortally.functions import periods as P

DAILY = "daily"
MONTH_END = "month_end"
AsOf = dt.date | str


@dataclass(frozen=True)
class Period:
    """`first(as_of)` opens the period; `last_seen(day)` is the last as-of day that sees a day."""

    name: str
    first: Callable[[Column], Column]
    last_seen: Callable[[Column], Column]


DAY = Period("day", lambda a: a, lambda d: d)
WEEK = Period("week", P.monday_of, lambda d: F.date_add(P.monday_of(d), 6))
MONTH = Period("month", P.month_start, F.last_day)
WEEK_OR_MONTH = Period(
    "week_or_month",
    lambda a: F.least(P.monday_of(a), P.month_start(a)),
    lambda d: F.greatest(F.date_add(P.monday_of(d), 6), F.last_day(d)),
)


def as_date(as_of: AsOf) -> Column:
    return F.lit(str(as_of)).cast("date")


def attach(df: DataFrame, as_of: AsOf, period: Period, day: str = "date") -> DataFrame:
    """Add `as_of`, keeping a row once per as-of day whose period holds it."""
    if as_of == MONTH_END:
        anchored = df.withColumn("as_of", F.last_day(day))
        return anchored.where(F.col(day) >= period.first(F.col("as_of")))
    if as_of == DAILY:
        if period is DAY:
            return df.where(F.col(day).isNotNull()).withColumn("as_of", F.col(day))
        days = F.sequence(F.col(day), period.last_seen(F.col(day)))
        return df.withColumn("as_of", F.explode(days)).where(F.col(day) >= period.first(F.col("as_of")))
    anchor = as_date(as_of)
    return df.where(F.col(day).between(period.first(anchor), anchor)).withColumn("as_of", anchor)


def within(period: Period, day: str = "date") -> Column:
    """True for a row inside the narrower `period` of its `as_of`."""
    return F.col(day).between(period.first(F.col("as_of")), F.col("as_of"))


def on_days(day: Column, days: Sequence[dt.date]) -> Column:
    """True on one of the days: a range that prunes a scan, and the days themselves."""
    return day.between(as_date(min(days)), as_date(max(days))) & day.isin([as_date(d) for d in days])
