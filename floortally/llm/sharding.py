"""Sharding by sampled splitters, with DataFrame functions only.

Records are ordered by a key, the hash of their text, so that equal texts stand together. A
size-weighted sample of the keys gives quantile splitters; each range between two splitters is
summed exactly, and a record's shard follows from the bytes in front of it. A group of equal texts
larger than a small part of a shard is an overfull range: it is subdivided by the hash of its ids,
so that no task, range or shard has to take a hot group whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from floortally.llm.storage import stored

#: Fixed bounds of the method.
SAMPLES_PER_RANGE = 32
ROWS_PER_RANGE = 20_000
LEAST_RANGES, MOST_RANGES = 2_048, 16_384
#: Groups above this part of a shard are subdivided; the others stay whole.
WHOLE_GROUP_PART = 1 / 200


def size_column(text: Column) -> Column:
    """UTF-8 bytes plus one; a null text has no bytes."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def range_of(key: Column, splitters: list[int]) -> Column:
    """Number of splitters at or below the key, by binary search over a literal array."""
    if not splitters:
        return F.lit(0)
    depth = math.ceil(math.log2(len(splitters) + 1))
    filled = [f"{x}L" if x > -(2**63) else "bigint(-9223372036854775808)" for x in splitters]
    padded = F.expr(f"array({', '.join(filled + ['bigint(null)'] * (2**depth - 1 - len(splitters)))})")
    steps = F.array(*[F.lit(2 ** (depth - 1 - i)) for i in range(depth)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(padded, at + step - 1) <= key, at + step).otherwise(at))


def splitters_of(keys: DataFrame, total: int, n_ranges: int) -> list[int]:
    """Quantiles of a sample in which a row's chance is its size's share: about SAMPLES_PER_RANGE a range.

    At most `n_ranges` values reach the driver."""
    odds = F.pmod(F.xxhash64(F.col("key"), F.col("sub"), F.lit(7)), F.lit(2**31)) / F.lit(float(2**31))
    sample = keys.where(odds < F.col("size") * F.lit(n_ranges * SAMPLES_PER_RANGE / max(total, 1)))
    quantiles = [i / n_ranges for i in range(1, n_ranges)]
    found = sample.agg(F.percentile_approx("key", quantiles, 10 * n_ranges).alias("q")).first()["q"] or []
    return sorted(set(found))


def assign_shards(documents: DataFrame, n_shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row; shards hold nearly equal bytes, slots run
    gaplessly from 0 within a shard.

    Equal texts share a shard unless their group is larger than `WHOLE_GROUP_PART` of a shard. A null
    text is sized 1 and grouped with the empty ones; a null doc_id is kept; repeated rows are each
    placed; an empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = stored(
        documents.select(
            F.col("doc_id"),
            size_column(F.col("text")).alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
        )
    )
    totals = narrow.agg(F.sum("size").alias("b"), F.count("*").alias("n")).first()
    total, n = totals["b"] or 0, totals["n"]
    shard_bytes = max(total / n_shards, 1)

    # Fewer than n_shards / WHOLE_GROUP_PART groups can be that large: a bound on this list.
    heavy = (
        narrow.groupBy("key")
        .agg(F.sum("size").alias("b"))
        .where(F.col("b") > shard_bytes * WHOLE_GROUP_PART)
        .select("key", F.least(F.ceil(F.col("b") / (shard_bytes * WHOLE_GROUP_PART)), F.lit(2**20)).cast("int").alias("parts"))
    )
    keyed = (
        narrow.join(F.broadcast(heavy), "key", "left")
        .withColumn("sub", F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.xxhash64("doc_id", "key")))
        .withColumn("part", F.when(F.col("parts").isNull(), F.lit(-1)).otherwise(
            F.floor((F.shiftright(F.col("sub"), 1) + F.lit(2**62)) / F.lit(float(2**63)) * F.col("parts")).cast("int")))
    )
    n_ranges = min(MOST_RANGES, max(LEAST_RANGES, n // ROWS_PER_RANGE))
    bounds = splitters_of(keyed, total, n_ranges)
    keyed = keyed.withColumn("range", range_of(F.col("key"), bounds))
    # A subdivided group has a cell for each of its parts; any order of the cells will do.
    keyed = keyed.withColumn("hot", F.when(F.col("parts").isNotNull(), F.col("key")).otherwise(0)).drop("parts")
    cell = ["range", "hot", "part"]
    # One row per cell: at most MOST_RANGES, and the bounded number of parts.
    before = Window.orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        keyed.groupBy(*cell)
        .agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
        .select(*cell, F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("bytes_before"),
                F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("rows_before"))
    )
    peers = Window.partitionBy(*cell, "key", "sub")
    upto = Window.partitionBy(*cell).orderBy("key", "sub").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = Window.partitionBy(*cell).orderBy("key", "sub", "doc_id", "size")
    placed = (
        keyed.withColumn("rank", F.row_number().over(numbered))
        .withColumn("upto", F.sum("size").over(upto))
        .withColumn("unit", F.sum("size").over(peers))
        .join(F.broadcast(cells), cell)
    )
    middle = F.col("bytes_before") + F.col("upto") - F.col("unit") / 2
    placed = stored(
        placed.select(
            "doc_id", "size", "text_crc32",
            F.least(F.floor(middle / F.lit(shard_bytes)), F.lit(n_shards - 1)).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("rank") - 1).alias("_row"),
        )
    )
    first = placed.groupBy("shard").agg(F.min("_row").alias("_first"))  # n_shards rows
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_row") - F.col("_first")).alias("slot")
    )
