"""Means of rounded percentages and grand-total rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from floortally import constants as C
from floortally.functions.numbers import half_even


def mean_of_rounded(value: Column, digits: int = 1) -> Column:
    """Mean of values already rounded to `digits`, NULL ignored.

    Summed as whole units of the last digit, so the result does not depend on row order.
    """
    units = F.rint(value * float(10**digits)).cast("bigint")
    return F.sum(units) / (F.count(value) * float(10**digits))


def mean_parts(value: Column, name: str, digits: int = 1) -> list[Column]:
    """What `mean_of_rounded` is made of, as two columns that further aggregates can add up."""
    units = F.rint(value * float(10**digits)).cast("bigint")
    return [F.sum(units).alias(f"{name}_units"), F.count(value).alias(f"{name}_n")]


def added_parts(name: str) -> list[Column]:
    return [F.sum(part).alias(part) for part in (f"{name}_units", f"{name}_n")]


def mean_of_parts(name: str, digits: int = 1) -> Column:
    return F.when(F.col(f"{name}_n") > 0, F.col(f"{name}_units") / (F.col(f"{name}_n") * float(10**digits)))


def grouped_with_total(df: DataFrame, keys: Sequence[str], label: str, *measures: Column) -> DataFrame:
    """Aggregate by keys + label and by the keys alone in one pass (grouping sets).

    `is_total` tells the total rows, whose label is the grand-total text; measures may ask
    `F.grouping(label)` to treat them differently.
    """
    rows = df.groupingSets([[*keys, label], [*keys]], *keys, label).agg(
        *measures, (F.grouping(label) == 1).alias("is_total")
    )
    return rows.withColumn(label, F.when(F.col("is_total"), F.lit(C.GRAND_TOTAL)).otherwise(F.col(label)))


def with_total(
    df: DataFrame, keys: Sequence[str], label: str, sums: Sequence[str], means: Sequence[str]
) -> DataFrame:
    """One row per label as it is, and per key group a total of summed counts and of unweighted
    means of the whole-number percentages."""
    return grouped_with_total(
        df,
        keys,
        label,
        *[F.sum(c).alias(c) for c in sums],
        *[half_even(mean_of_rounded(F.col(c), 0)).alias(c) for c in means],
    )
