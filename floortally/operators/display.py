"""Display forms of finished report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from floortally.functions.text import dash_if_missing, percent_text


def as_text(df: DataFrame, numbers: Sequence[str] = (), percents: Sequence[str] = ()) -> DataFrame:
    """Numbers as text with `-` for a missing one, percentages as `x.x%`."""
    shown = {c: dash_if_missing(F.col(c)) for c in numbers}
    return df.withColumns({**shown, **{c: percent_text(F.col(c)) for c in percents}})
