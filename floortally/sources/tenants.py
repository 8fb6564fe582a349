"""Tenant configuration: one job serves every tenant, `tenant` being a group key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from floortally import constants as C


@dataclass(frozen=True)
class Tenant:
    name: str
    shift_seconds: int = C.EIGHT_HOURS_SECONDS

    @property
    def path_pattern(self) -> str:
        """LIKE pattern on paths; `_` in the slug matches any one character."""
        return f"%{'_'.join(self.name.lower().split())}%"


def tag(df: DataFrame, tenants: Sequence[Tenant], path: str = "path", ignore_case: bool = False) -> DataFrame:
    """Add `tenant`, keeping a row once per tenant whose pattern its path matches.

    The patterns are literals of the configuration, so this is a projection, not a join.
    """
    text = F.col(path)
    hits = [
        F.when(text.ilike(t.path_pattern) if ignore_case else text.like(t.path_pattern), F.lit(t.name))
        for t in tenants
    ]
    found = F.filter(F.array(*hits), lambda name: name.isNotNull())
    return df.withColumn("tenant", F.explode(found))


def tenant_frame(spark: SparkSession, tenants: Sequence[Tenant]) -> DataFrame:
    """The configuration as a literal frame, one row per tenant."""
    rows = F.array(
        *[
            F.struct(F.lit(t.name).alias("tenant"), F.lit(float(t.shift_seconds)).alias("shift_seconds"))
            for t in tenants
        ]
    )
    return spark.range(1, numPartitions=1).select(F.inline(rows))


def shift_of(tenant: Column, tenants: Sequence[Tenant]) -> Column:
    """Shift seconds of a tenant from a literal map: a lookup, not a join."""
    pairs = [F.lit(x) for t in tenants for x in (t.name, float(t.shift_seconds))]
    return F.create_map(*pairs)[tenant]
