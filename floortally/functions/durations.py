"""Durations are kept in seconds; text forms are read and written at the edge only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from floortally import constants as C
from floortally.functions.periods import parse_timestamp

DAY_SECONDS = 86_400


_NUMBER = r"[+-]?\s*\d+(?:\.\d*)?|[+-]?\s*\.\d+"
_CLOCK = r"([+-]?)(\d+):([0-5]?\d)(?::([0-5]?\d(?:\.\d+)?))?"
_GRAMMAR = (
    r"^\s*@?\s*(?=.*\d)" + "".join(rf"(?:(?:{_NUMBER})\s*(?:{unit})(?![a-z])\s*)?" for unit, _ in C.INTERVAL_UNITS) + rf"(?:{_CLOCK})?\s*(?:ago)?\s*$"
)


def _number(text: Column) -> Column:
    """A number that may be missing, as 0."""
    return F.coalesce(F.replace(text, F.lit(" "), F.lit("")).try_cast("double"), F.lit(0.0))


def interval_seconds(text: Column) -> Column:
    """Seconds (double) of an interval text; NULL for anything else.

    `H:MM:SS[.f]` or `H:MM`, signed or not, behind any of the units of `INTERVAL_UNITS` in falling order
    (`1 day -2:00`, `2 hours 3.5 mins`, `1h30m`), all of it negated by `ago`; a bare number is seconds."""
    plain = F.lower(text)
    clock = (
        F.substring_index(plain, ":", 1).try_cast("double") * 3600
        + F.substring_index(F.substring_index(plain, ":", 2), ":", -1).try_cast("double") * 60
        + F.substring_index(plain, ":", -1).try_cast("double")
    )
    units = [
        _number(F.regexp_extract(plain, rf"({_NUMBER})\s*(?:{unit})(?![a-z])", 1)) * F.lit(float(seconds))
        for unit, seconds in C.INTERVAL_UNITS
    ]
    part = lambda i: F.regexp_extract(plain, rf"(?:^|\s|@|[a-z]){_CLOCK}", i)
    signed = (_number(part(2)) * 3600 + _number(part(3)) * 60 + _number(part(4))) * F.when(part(1) == "-", -1.0).otherwise(1.0)
    whole = (sum(units[1:], units[0]) + signed) * F.when(F.rtrim(plain).endswith("ago"), -1.0).otherwise(1.0)
    return (
        F.when(text.rlike(r"^\s*\d+:[0-5]?\d:[0-5]?\d(\.\d+)?\s*$"), clock)
        .when(plain.rlike(rf"^\s*(?:{_NUMBER})\s*$"), _number(F.trim(plain)))
        .when(plain.rlike(_GRAMMAR), whole)
    )


def clock_text(seconds: Column, hour_digits: int = 2) -> Column:
    """`HH:MM:SS` with hours running past 23."""
    total = F.rint(seconds).cast("bigint")
    return F.when(
        seconds.isNotNull(),
        F.format_string(
            f"%0{hour_digits}d:%02d:%02d",
            F.floor(total / 3600),
            F.floor((total % 3600) / 60),
            total % 60,
        ),
    )


def parse_milliseconds(text: Column) -> Column:
    """Whole milliseconds kept as text; NULL when they do not parse."""
    return text.try_cast("bigint")


def wrapped(seconds: Column) -> Column:
    """Seconds within the day only: what is left when a `N days HH:MM:SS` text loses its days."""
    return seconds % DAY_SECONDS


def shift_seconds(
    clock_in: Column, clock_out: Column, wrap_24h: bool = False, formats: Sequence[str] = C.TIME_FORMATS
) -> Column:
    """Attendance shift less the break; missing or negative shifts count as the default shift."""
    worked = parse_timestamp(clock_out, formats) - parse_timestamp(clock_in, formats)
    worked = worked.cast("decimal(18,6)").cast("double")
    worked = worked - C.SHIFT_BREAK_SECONDS
    shift = F.when(worked >= 0, worked).otherwise(F.lit(float(C.DEFAULT_SHIFT_SECONDS)))
    return wrapped(shift) if wrap_24h else shift


def default_shift(days: Column, wrap_24h: bool = False) -> Column:
    shift = days * float(C.DEFAULT_SHIFT_SECONDS)
    return wrapped(shift) if wrap_24h else shift
