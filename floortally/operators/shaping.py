"""Domain fill, top-k, shares, min-max heat and total rows over already aggregated frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from floortally.functions.numbers import half_even, ratio


def literal_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(value) for value in values])


def with_domain(groups: DataFrame, name: str, domain: Sequence[str]) -> DataFrame:
    """Every value of a fixed domain for every group; further columns are carried along."""
    return groups.withColumn(name, F.explode(literal_array(domain)))


def top_k(df: DataFrame, keys: Sequence[str], measure: str, label: str, k: int) -> DataFrame:
    """The k largest per group; ties go to the alphabetically first label, NULL last."""
    order = W.partitionBy(*keys).orderBy(F.desc(measure), F.asc_nulls_last(label))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def share_of_total(df: DataFrame, keys: Sequence[str], measure: str, name: str, digits: int) -> DataFrame:
    """Percentage of the group's sum of the measure."""
    total = F.sum(measure).over(W.partitionBy(*keys))
    return df.withColumn(name, half_even(ratio(F.col(measure), total) * 100, digits))


def min_max_heat(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Position of each value between the group's least and largest; a flat column is 1.0."""
    group = W.partitionBy(*keys)
    heat = {}
    for column in columns:
        low, high = F.min(column).over(group), F.max(column).over(group)
        heat[f"{column}_heat"] = F.when(low == high, F.when(F.col(column).isNotNull(), F.lit(1.0))).otherwise(
            (F.col(column) - low) / (high - low)
        )
    return df.withColumns(heat)


def pinned_order(total_flag: str, measure: str, ascending: bool = False) -> list[Column]:
    """Sort keys that leave the total row last in either direction."""
    by = F.asc_nulls_last(measure) if ascending else F.desc_nulls_last(measure)
    return [F.asc(total_flag), by]


def nulls_last(columns: Sequence[str], ascending: bool = True) -> list[Column]:
    """Sort keys that leave NULL last in either direction."""
    order = F.asc_nulls_last if ascending else F.desc_nulls_last
    return [order(column) for column in columns]


def positioned(df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str = "position") -> DataFrame:
    """The rows in order of their groups and, within each, of `order`, with their place in the group from 1.

    A table that was written and read again keeps its order by groups and position. `order` should tell all
    rows of a group apart; places are taken per group, so that no task sees all rows."""
    placed = df.withColumn(name, F.row_number().over(W.partitionBy(*groups).orderBy(*order)))
    return placed.orderBy(*[F.asc_nulls_last(g) for g in groups], name)


def append(upper: DataFrame, lower: DataFrame) -> DataFrame:
    """UNION ALL by name; columns missing on one side are NULL."""
    return upper.unionByName(lower, allowMissingColumns=True)
