"""Business rules on audio files and adherence percentages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from floortally import constants as C


def blank_file(duration: Column, speech: Column, rule: str) -> Column:
    """1 for a blank recording, 0 otherwise; three rule sets are in use.

    a: valid only with a positive duration and a speech share in [0.1, 1]; unknown is blank.
    b: blank when the duration is missing or 0, or the share is above 1 or at most 0.1.
    c: blank only with a positive duration and a share below 0.1 or above 1.
    """
    share = F.when(duration != 0, speech / duration)
    if rule == "a":
        blank = ~F.coalesce((duration > 0) & share.between(0.1, 1), F.lit(False))
    elif rule == "b":
        blank = F.coalesce(duration, F.lit(0)).eqNullSafe(0) | F.coalesce(
            (share > 1) | (share <= 0.1), F.lit(False)
        )
    elif rule == "c":
        blank = F.coalesce((duration > 0) & ((share < 0.1) | (share > 1)), F.lit(False))
    else:
        raise ValueError(f"unknown blank-file rule {rule!r}")
    return blank.cast("int")


def recorded_in_hours(filename: Column, hours: tuple[str, str] = C.WORK_HOURS) -> Column:
    """Time of day, HHMMSS at position 10 of the file name, inside working hours."""
    return F.substring(filename, 10, 6).between(*hours)


def same_day_upload(day: Column, created: Column) -> Column:
    return day == created


def band(value: Column) -> Column:
    """Traffic-light band of a percentage; NULL stays NULL."""
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for floor, name in C.BANDS:
        chain = chain.when(value >= floor, name)
    return chain.otherwise(C.LOWEST_BAND)


def blank_alert(blank_pct: Column) -> Column:
    return F.coalesce(blank_pct > C.BLANK_ALERT_PCT, F.lit(False))


def adherence_alert(adherence_pct: Column) -> Column:
    return F.coalesce(adherence_pct < C.ADHERENCE_ALERT_PCT, F.lit(False))


def comment(blank_pct: Column, adherence_pct: Column) -> Column:
    """`High Blank Files`, `Low Device Adherence`, both with a comma, or an empty text."""
    return F.concat_ws(
        ", ",
        F.when(blank_alert(blank_pct), "High Blank Files"),
        F.when(adherence_alert(adherence_pct), "Low Device Adherence"),
    )
