"""JSON arrays of objects: only the needed fields are parsed, as text, once.

Plain array functions and `explode_outer` are used rather than higher-order functions, and a
filter follows the explode rather than preceding it: both keep the parse in generated code and
stop predicate inference from repeating it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def objects(df: DataFrame, column: str, *keys: str) -> Column:
    """Array of structs of text fields from a JSON text column, or from an array column.

    Non-text fields come out as their JSON text, missing ones as NULL; a text that is no JSON
    is NULL.
    """
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return F.transform(
            F.col(column), lambda e: F.struct(*[e[key].cast("string").alias(key) for key in keys])
        )
    fields = ", ".join(f"{key}: string" for key in keys)
    return F.from_json(F.col(column), f"array<struct<{fields}>>")


def texts(df: DataFrame, column: str, key: str) -> Column:
    """Array of one field: far smaller to shuffle than the objects."""
    return objects(df, column, key)[key]


def parsed(df: DataFrame, kept: Sequence[str], **columns: Column) -> DataFrame:
    """The kept columns and the given expressions, each evaluated once per row however often its name is used:
    nothing above a generator is moved below it, so a filter and a projection share the parse."""
    return df.select(*kept, F.inline(F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))))


def any_in(array: Column, values: Sequence[str]) -> Column:
    """True when an array of texts holds one of the values; never NULL."""
    return F.coalesce(F.arrays_overlap(array, F.array(*[F.lit(v) for v in values])), F.lit(False))


def int_field(element: Column, key: str) -> Column:
    return element[key].cast("int")


def occurrences(array: Column, value: str) -> Column:
    """How often a value stands in an array; 0 for a missing array."""
    return F.coalesce(F.size(array) - F.size(F.array_remove(array, value)), F.lit(0))
