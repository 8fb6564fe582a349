"""Store -> area manager chain and region restriction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from floortally.sources.tables import Tables


def store_chain(t: Tables) -> DataFrame:
    """One row per store with its name, brand, regional manager and area manager's name."""
    managers = t.managers.select(F.col("id").alias("abm_id"), "user_id")
    users = t.users.select(F.col("id").alias("user_id"), F.col("name").alias("manager"))
    return (
        t.stores.withColumnsRenamed({"id": "store_id", "name": "store"})
        .join(managers, "abm_id", "left")
        .join(users, "user_id", "left")
        .select("store_id", "store", "brand_id", "regional_manager_id", "manager")
    )


def in_regions(df: DataFrame, regions: Sequence[int] | None) -> DataFrame:
    """Rows of the named regional managers; with None every region, each a group of its own."""
    region = F.col("regional_manager_id")
    return df.where(region.isNotNull() if regions is None else region.isin(list(regions)))
