"""Mixing sources to target weights by hierarchical budgets, with DataFrame functions only.

The tree's levels are columns, from domain to source. Capacities add up from the leaves; budgets
come down: a node's budget is dealt to its children by weight, no child above its capacity, what one
cannot use going to its siblings. A node asks its own parent for no more than its subtree can hold,
so a shortage is made good among siblings first and reaches the ancestors only when all are full.
Each leaf fills its budget from seeded epochs: every epoch is an order of its documents by a seeded
hash, and the leaf takes whole epochs and then a prefix, counted in tokens, of the last one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from floortally.llm.storage import stored

WORD_BREAK = r"[\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    """Words of a text; a null or blank text has none."""
    words = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), WORD_BREAK, " "))
    return F.when(words == "", F.lit(0)).otherwise(F.length(words) - F.length(F.replace(words, F.lit(" "))) + 1).cast("long")


def seeded(seed: int, epoch: int, doc_id: Column, text_hash: Column) -> Column:
    """28-bit place of a document, known by id and text, in an epoch's order."""
    known = F.coalesce(doc_id.cast("string"), F.lit("null")), F.coalesce(text_hash.cast("string"), F.lit("null"))
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(str(epoch)), *known)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("long")


def weight_of(level: str, weights: Mapping[str, float]) -> Column:
    """Weight of a node among its siblings: as given, else 1."""
    weight = F.lit(1.0)
    for name, value in weights.items():
        weight = F.when(F.col(level) == name, F.lit(float(value))).otherwise(weight)
    return weight


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]], target: float) -> DataFrame:
    """Leaves (`levels`, `capacity`) with a `budget` each, in tokens, rounded down.

    A child's share is min(capacity, rate * weight), with the one rate per parent that spends the
    budget; with children ordered by capacity / weight it is a running sum, so a window finds it.
    Windows are over the children of one node; the tree has a row per leaf, never one per document.
    A weight of 0 leaves a node out: its subtree has no capacity and a budget of 0.
    """
    for level in levels:
        leaves = leaves.withColumn("capacity", F.when(weight_of(level, weights.get(level, {})) > 0, F.col("capacity")).otherwise(0))
    whole = leaves.agg(F.sum("capacity")).first()[0] or 0
    nodes, parents = None, []
    for depth, level in enumerate(levels):
        keys = list(levels[: depth + 1])
        children = (
            leaves.groupBy(*keys).agg(F.sum("capacity").cast("double").alias("capacity"))
            .withColumn("w", weight_of(level, weights.get(level, {})))
        )
        if nodes is None:
            children = children.withColumn("budget", F.lit(min(float(whole), float(target))))
        else:
            children = children.join(nodes, parents)
        siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
        fill = siblings.orderBy((F.col("capacity") / F.nullif(F.col("w"), F.lit(0.0))).asc_nulls_last(), level)
        before = fill.rowsBetween(Window.unboundedPreceding, -1)
        rest = F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))
        weight_left = F.sum("w").over(siblings) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
        full = F.col("capacity") * weight_left <= rest * F.col("w")
        children = children.withColumns({"rest": rest, "weight_left": weight_left, "full": full.cast("int")})
        # From the first child that is not full on, all share what is left at one rate.
        open_from = F.row_number().over(fill)
        children = children.withColumn("at", open_from).withColumn(
            "first_open", F.min(F.when(F.col("full") == 0, F.struct("at", "rest", "weight_left"))).over(siblings)
        )
        share = F.when(
            F.col("first_open").isNull() | (F.col("at") < F.col("first_open.at")), F.col("capacity")
        ).otherwise(F.greatest(F.col("first_open.rest"), F.lit(0.0)) * F.col("w") / F.col("first_open.weight_left"))
        nodes = children.select(*keys, share.alias("budget"))
        parents = keys
    # Sums of doubles may end a hair under a whole number of tokens.
    return nodes.select(*levels, F.floor(F.col("budget") + 1e-6).cast("long").alias("budget"))


def mixed(
    documents: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[str, Mapping[str, float]],
    target_part: float,
    max_epochs: int = 1,
    seed: int = 42,
) -> DataFrame:
    """doc_id, text_hash, the levels, n_tokens, `copies` (times the document is taken), the leaf's `budget`.

    One row per row of `documents`; `target_part` is the wanted part of all tokens. In a leaf's last,
    partial epoch a document is taken while the tokens up to its end stay within the budget. A null
    level value is a node of its own, named ''; a document without tokens costs nothing and is taken
    in full epochs, in front of the last prefix's end, and once in a leaf that has no tokens at all; repeated rows
    stand together in the order and are each counted; rows that share an id, or have none, are told apart by their
    texts, so that the selection does not depend on partitions; an empty table gives no rows; texts may be of any
    length and other columns of any name.
    """
    names = list(levels)
    rows = documents.select(
        "doc_id", *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()], token_count(F.col("text")).alias("n_tokens"),
        F.xxhash64("text").alias("text_hash"),
    )
    rows = stored(rows)
    leaves = rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"))
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    dealt = budgets(leaves.select(*names, (F.col("tokens") * max_epochs).alias("capacity")), names, weights, target_part * total)
    leaves = stored(
        leaves.join(dealt, names)
        .withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(1).cast("int"))
        .withColumn("left", F.col("budget") - F.col("epochs") * F.col("tokens"))
    )
    # Place in the last epoch. Bins of the order are summed first, so only a leaf's one bin at the
    # budget's end is ordered by document: a leaf with a third of all rows is never in one task.
    place = F.element_at(F.array(*[seeded(seed, e, F.col("doc_id"), F.col("text_hash")) for e in range(max_epochs + 1)]), F.col("epochs") + 1)
    rows = rows.join(leaves.select(*names, "budget", "epochs", "left"), names)
    rows = rows.withColumn("place", place).withColumn("bin", F.shiftright("place", 28 - 12))
    order = Window.partitionBy(*names).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Written, so that its size is known: a tree that is small is broadcast, and no leaf's rows meet in a task.
    ends = stored(
        rows.groupBy(*names, "left", "bin").agg(F.sum("n_tokens").alias("t"))
        .withColumn("upto", F.sum("t").over(order))
        .where((F.col("upto") > F.col("left")))
        .groupBy(*names)
        .agg(F.min(F.struct("bin", "upto", "t")).alias("end"))
        .select(*names, F.col("end.bin").alias("end_bin"), (F.col("end.upto") - F.col("end.t")).alias("end_before"))
    )
    # The bin at the budget's end meets its rows by (leaf, bin): the rest of a leaf never joins them there.
    prefix = Window.partitionBy(*names, "bin").orderBy("place", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ending = rows.join(ends.withColumnRenamed("end_bin", "bin"), [*names, "bin"]).withColumn(
        "taken", F.col("end_before") + F.sum("n_tokens").over(prefix) <= F.col("left")
    )
    others = rows.join(ends.drop("end_before"), names, "left").where(~F.coalesce(F.col("bin") == F.col("end_bin"), F.lit(False)))
    others = others.withColumn("taken", F.col("end_bin").isNull() | (F.col("bin") < F.col("end_bin")))
    copies = F.col("epochs") + (F.col("taken") & (F.col("left") > 0)).cast("int")
    columns = ["doc_id", "text_hash", *names, "n_tokens", copies.alias("copies"), "budget"]
    return others.select(*columns).unionByName(ending.select(*columns))


def mixture(documents: DataFrame, *args, **parameters) -> DataFrame:
    """The rows of `documents` that `mixed` takes, each as often as it is taken, all columns as they are, whatever
    their names. Nulls, repeated and shared ids, empty texts and tables are as in `mixed`."""
    taken = mixed(documents, *args, **parameters).groupBy("doc_id", "text_hash").agg(F.sum("copies").cast("int").alias("copies")).where("copies > 0")
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    rows = rows.join(taken, rows["id"].eqNullSafe(taken["doc_id"]) & (rows["text"] == taken["text_hash"]))
    rows = rows.dropDuplicates(["id", "text"])  # repeated rows are counted in copies
    return rows.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
