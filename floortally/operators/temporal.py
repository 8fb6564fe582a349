"""Validity intervals `[first, last]`, where a NULL end is open."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from floortally import constants as C


def open_end(last: Column) -> Column:
    return F.coalesce(last, F.lit(C.OPEN_END).cast("date"))


def valid_on(first: Column, last: Column, day: Column) -> Column:
    return (first <= day) & (open_end(last) >= day)


def overlaps(first: Column, last: Column, start: Column, end: Column) -> Column:
    return (first <= end) & (open_end(last) >= start)


def inside_clipped(day: Column, first: Column, last: Column, start: Column, end: Column) -> Column:
    """The day lies in the interval cut to `[start, end]`."""
    return day.between(F.greatest(first, start), F.least(open_end(last), end))
