"""Labels, slugs and display forms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from floortally import constants as C


def slug(name: Column) -> Column:
    """`Two Words` -> `two_words`."""
    return F.regexp_replace(F.trim(F.lower(name)), r"\s+", "_")


def title(code: Column) -> Column:
    """`two_words` -> `Two Words`."""
    return F.initcap(F.replace(code, F.lit("_"), F.lit(" ")))


def not_blank(text: Column) -> Column:
    return text.isNotNull() & (F.trim(text) != "")


def percent_text(value: Column) -> Column:
    return F.when(value.isNotNull(), F.format_string("%.1f%%", value))


def dash_if_missing(value: Column) -> Column:
    """Display cell: integral numbers without decimals, `-` for a missing value."""
    number = value.cast("double")
    plain = F.when(number == F.floor(number), number.cast("bigint").cast("string"))
    return F.coalesce(plain, value.cast("string"), F.lit("-"))


def device_code(path: Column, pattern: str = C.DEVICE_PATTERN) -> Column:
    """Lower-cased device code inside a path; NULL when there is none."""
    return F.lower(F.regexp_substr(path, F.lit(pattern)))


def zero_pad(number: Column, width: int) -> Column:
    return F.format_string(f"%0{width}d", number.cast("bigint"))
