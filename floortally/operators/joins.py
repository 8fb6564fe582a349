"""Join forms the reports share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def left_on(left: DataFrame, right: DataFrame, left_key: str, right_key: str, null_safe: bool = False) -> DataFrame:
    """Left merge on differently named keys, dropping the right key; optionally NULL meets NULL."""
    right = right.withColumnRenamed(right_key, "_right_key")
    same: Column = (
        F.col(left_key).eqNullSafe(F.col("_right_key")) if null_safe else F.col(left_key) == F.col("_right_key")
    )
    return left.join(right, same, "left").drop("_right_key")


def keep_matching(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Semi join: rows whose keys occur in the other frame."""
    return df.join(other.select(*keys).distinct(), keys, "left_semi")


def split_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    inside: Column | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Left join for a right side with hot keys, as an inner join plus the unmatched left rows.

    Adaptive execution splits skewed partitions of either side of an inner join, but never of
    the right side of a left join. `inside` is a further condition on columns of the frames
    aliased `l` and `r`; `seen` may give the right side's distinct condition columns instead of
    the whole right side to decide which left rows are unmatched.
    """
    l, r = left.alias("l"), right.alias("r")
    same = [F.col(f"l.{key}") == F.col(f"r.{key}") for key in keys]
    on = same if inside is None else [*same, inside]
    extra = [c for c in right.columns if c not in keys]
    matched = l.join(r, on, "inner").select("l.*", *[f"r.{c}" for c in extra])
    unmatched = l.join((right if seen is None else seen).alias("r"), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
