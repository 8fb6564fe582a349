"""Writers for report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """UTF-8 CSV with a header and no byte-order mark."""
    df.write.mode(mode).option("header", True).option("encoding", "UTF-8").csv(path)


def write_report(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    file_format: str = "parquet",
    mode: str = "errorifexists",
) -> None:
    """Report table as Parquet or JSON, partitioned by keys such as tenant and as_of."""
    if file_format not in ("parquet", "json"):
        raise ValueError(f"unsupported report format {file_format!r}")
    writer = df.write.mode(mode).format(file_format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
