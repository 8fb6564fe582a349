"""The codes behind the counts of a report: a long table beside a summary, or a summary with a list in every cell.

A group may hold a third of all rows, so rows are folded by code first: the code is part of the aggregation key,
which spreads a hot group over all tasks. The long table ends there. A list has to meet in its cell; it gets one
entry per code and group then, whatever the number of rows. Counts are of every row, with or without a code;
lists and long tables have the codes that are there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from floortally.functions.text import not_blank


def listed(code: str) -> Column:
    """The code as lists show it, NULL for one that is blank only."""
    return F.when(not_blank(F.col(code)), F.trim(code))


def code_list(code: str, n: str, distinct: bool = False) -> Column:
    """Aggregate over rows folded by code: the codes with `n` rows in order, each `n` times or once; empty without any."""
    entry = code if distinct else f"concat({code}, repeat(concat(', ', {code}), cast({n} - 1 as int)))"
    return F.expr(f"coalesce(listagg({entry}, ', ') within group (order by {code}) filter (where {n} > 0 and {code} is not null), '')")


def code_counts(rows: DataFrame, keys: Sequence[str], code: str, weight: Column | None = None) -> DataFrame:
    """Keys, code and `n`, the rows (or summed weights) of the group with that code; NULL and blank codes are left out."""
    rows = rows.select(*keys, F.trim(code).alias(code), (F.lit(1) if weight is None else weight).cast("bigint").alias("n"))
    return rows.where(not_blank(F.col(code))).groupBy(*keys, code).agg(F.sum("n").alias("n"))
