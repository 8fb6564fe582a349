"""Rounding, guarded ratios and lenient number parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_even(value: Column, digits: int = 0) -> Column:
    """Round half to even on doubles, scaling by 10**digits as array libraries do."""
    if digits == 0:
        return F.rint(value)
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def half_away(value: Column, digits: int = 1) -> Column:
    """Round half away from zero on exact decimals, as SQL NUMERIC does."""
    return F.round(value.cast("decimal(38,18)"), digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient; NULL unless the denominator is positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))


def percent(numerator: Column, denominator: Column, digits: int = 0) -> Column:
    """Half-even percentage; NULL unless the denominator is positive."""
    return half_even(ratio(numerator, denominator) * 100, digits)


def percent_or_zero(numerator: Column, denominator: Column, digits: int = 0) -> Column:
    return F.coalesce(percent(numerator, denominator, digits), F.lit(0.0))


def sql_percent(part: Column, total: Column, digits: int = 1) -> Column:
    """Half-away percentage of two counts in decimal arithmetic; NULL for a zero total."""
    exact = part.cast("decimal(18,0)") * 100 / F.nullif(total, F.lit(0)).cast("decimal(18,0)")
    return F.round(exact, digits).cast("double")


def finite_or_zero(value: Column) -> Column:
    """NULL, NaN and infinities become 0."""
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(bad, F.lit(0.0)).otherwise(value)


def parse_number(text: Column) -> Column:
    """Number from display text: commas and a trailing % are dropped, anything else is NULL."""
    bare = F.regexp_replace(F.trim(text), ",", "")
    bare = F.regexp_replace(bare, "%$", "")
    plain = bare.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")
    return F.when(plain, F.trim(bare).try_cast("double"))


def clamp01(value: Column) -> Column:
    """Into [0, 1]; a missing value counts as 0."""
    filled = F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(value)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), filled))


def interpolate(low: Column, high: Column, share: Column) -> Column:
    return low + (high - low) * clamp01(share)


def whole(value: Column) -> Column:
    """A rounded value as BIGINT."""
    return value.cast("bigint")


def count_where(condition: Column) -> Column:
    """Rows of the group for which the condition holds (NULL does not)."""
    return F.count(F.when(condition, F.lit(1)))


def sum_or_zero(value: Column) -> Column:
    """Sum that is 0, not NULL, for an all-NULL group."""
    return F.coalesce(F.sum(value), F.lit(0))
