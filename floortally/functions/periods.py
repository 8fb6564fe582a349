"""Calendar columns: period starts, week-of-month and relative-day labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from floortally import constants as C


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def monday_of(day: Column) -> Column:
    return F.date_sub(day, F.weekday(day))


def sunday_of(day: Column) -> Column:
    """First day of the Sunday-to-Saturday week."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def rolling_week_start(day: Column) -> Column:
    """Six days back, but never before the first of the month."""
    return F.greatest(month_start(day), F.date_sub(day, 6))


def look_back_start(day: Column) -> Column:
    """Month start, or four days back when that is earlier."""
    return F.least(month_start(day), F.date_sub(day, 4))


def days_between(first: Column, last: Column) -> Column:
    """Length of an inclusive day range."""
    return F.datediff(last, first) + 1


def week_of_month(day: Column) -> Column:
    """Week 1 ends on the month's first Saturday, later weeks run Sunday to Saturday."""
    offset = F.dayofweek(month_start(day)) - 1
    return F.floor((F.dayofmonth(day) - 1 + offset) / 7).cast("int") + 1


def week_label(day: Column) -> Column:
    return F.concat(F.lit("Week "), week_of_month(day))


def week_start(month_first: Column, number: Column) -> Column:
    """First day of week `number` of the month starting at `month_first`."""
    return F.greatest(month_first, F.date_add(sunday_of(month_first), 7 * (number - 1)))


def week_end(month_first: Column, number: Column) -> Column:
    return F.least(F.last_day(month_first), F.date_add(sunday_of(month_first), 7 * number - 1))


def days_elapsed(first: Column, last: Column, as_of: Column) -> Column:
    """Days of [first, last] up to `as_of`; 0 when the range has not begun."""
    return F.greatest(F.lit(0), F.datediff(F.least(last, as_of), first) + 1)


def days_ago(day: Column, as_of: Column) -> Column:
    """1 for the as-of day itself: reports run on the morning after `as_of`."""
    return F.datediff(as_of, day) + 1


def day_label(day: Column, as_of: Column) -> Column:
    ago = days_ago(day, as_of)
    return (
        F.when(day.isNull(), F.lit(None).cast("string"))
        .when(ago.between(1, 4), F.concat(F.lit("D-"), ago.cast("string")))
        .otherwise("D-X")
    )


def ordinal(number: Column) -> Column:
    """1st, 2nd, 3rd, 4th ... 11th, 12th, 13th."""
    tail = number % 10
    teen = (number % 100).between(11, 13)
    suffix = (
        F.when(teen, "th").when(tail == 1, "st").when(tail == 2, "nd").when(tail == 3, "rd").otherwise("th")
    )
    return F.concat(number.cast("string"), suffix)


def long_date(day: Column) -> Column:
    """`1st Dec'25`."""
    return F.concat(ordinal(F.dayofmonth(day)), F.lit(" "), F.date_format(day, "MMM''yy"))


def short_date(day: Column) -> Column:
    return F.date_format(day, "dd-MM-yyyy")


def parse_timestamp(text: Column, formats: Sequence[str] = C.TIME_FORMATS) -> Column:
    """An ISO text, or the first of the formats that fits; NULL when none does."""
    # Read as UTC and taken as the time since its epoch, so that the session's zone has no say.
    marked = F.concat(F.trim(text), F.lit(" Z"))
    tries = [F.try_to_timestamp(marked, F.lit(f"{form} XXX")) for form in formats]
    since = F.coalesce(*tries) - F.expr("timestamp'1970-01-01 00:00:00Z'")
    return F.coalesce(text.try_cast("timestamp_ntz"), F.expr("timestamp_ntz'1970-01-01 00:00:00'") + since)


def parse_date(text: Column, formats: Sequence[str] = C.TIME_FORMATS) -> Column:
    """The date of an ISO text or of the first of the formats that fits; NULL when none does."""
    return F.coalesce(text.try_cast("date"), parse_timestamp(text, formats).cast("date"))
