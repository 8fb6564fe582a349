"""Merkle fingerprints of documents, with DataFrame functions only.

A text splits into sections (at blank lines), these into paragraphs (lines), these into pieces
(sentences). A piece's digest is the SHA-256 of its bytes; a paragraph's is that of its pieces'
digests, a section's that of its paragraphs', and the root that of the sections'. Every byte of the
text, breaks included, belongs to exactly one piece, so equal roots mean equal texts, and where roots
differ, differing branches locate the edit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Breaks stay at the end of what they close.
SECTION_END = r"(?<=\n\n)"
PARAGRAPH_END = r"(?<=\n)"
PIECE_END = r"(?<=[.!?。！？] )"
#: Most ranges of the ordering; each holds a row of the table in as many.
MOST_RANGES = 65_536


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def merkle_tree(text: Column) -> Column:
    """Sections, each an array of paragraphs, each an array of its pieces' hex digests.
    A null text counts as empty and has one empty piece."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), SECTION_END),
        lambda section: F.transform(
            F.split(section, PARAGRAPH_END), lambda paragraph: F.transform(F.split(paragraph, PIECE_END), _digest)
        ),
    )


def _node(children: Column, digest) -> Column:
    return _digest(F.array_join(F.transform(children, digest), ""))


def root_of(tree: Column) -> Column:
    return _node(tree, lambda section: _node(section, lambda paragraph: _digest(F.array_join(paragraph, ""))))


def leaves_of(tree: Column) -> Column:
    """Distinct piece digests."""
    return F.array_distinct(F.flatten(F.flatten(tree)))


def likeness(left: Column, right: Column) -> Column:
    """Jaccard similarity of two trees' leaf sets: 1 for equal texts, 0 without a common piece."""
    both = F.size(F.array_intersect(left, right))
    return both / (F.size(left) + F.size(right) - both)


def first_difference(left: Column, right: Column) -> Column:
    """struct(section, paragraph), counted from 0, of the first differing branch; null for equal trees."""
    n = F.greatest(F.size(left), F.size(right))
    at = F.array_position(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(left, i).eqNullSafe(F.get(right, i))), False) - 1
    a, b = F.get(left, at.cast("int")), F.get(right, at.cast("int"))
    m = F.greatest(F.coalesce(F.size(a), F.lit(0)), F.coalesce(F.size(b), F.lit(0)))
    inner = F.array_position(F.transform(F.sequence(F.lit(0), m - 1), lambda i: F.get(a, i).eqNullSafe(F.get(b, i))), False) - 1
    return F.when(at >= 0, F.struct(at.alias("section"), inner.alias("paragraph")))


def with_next(documents: DataFrame, value: str, key: str = "doc_id", ranges: int | None = None) -> DataFrame:
    """Each row with `next_<value>`: the value of the row that follows by key (after the last: the first).

    Keys are cut into ranges at quantiles that are keys themselves. The rows of each range's first key
    also go, as guests, to the range before it, so every row finds its successor in its own range and no
    window spans the table. Null keys come first; rows of one key follow each other by value.
    """
    ranges = ranges or min(MOST_RANGES, 8 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    quantiles = [i / ranges for i in range(ranges)]
    nulls, least, found = documents.agg(
        F.count(F.when(F.col(key).isNull(), 1)), F.min(key), F.percentile_approx(key, quantiles, 4 * ranges)
    ).first()
    bounds = sorted({*(found or []), *([] if least is None else [least])})  # at most ranges + 1 keys
    at = F.expr(f"array({', '.join(f'bigint({x})' for x in bounds)})") if bounds else F.array().cast("array<bigint>")
    # Range 0 has the null keys, range i the keys from the i-th bound on.
    own = F.when(F.col(key).isNull(), 0).otherwise(_count_at_or_below(at, F.col(key), len(bounds)))
    rows = documents.withColumn("_own", own)
    is_head = F.col(key).isNull() | (F.get(at, F.col("_own") - 1) == F.col(key))
    first = 0 if nulls else 1
    before = F.when(F.col("_own") == first, F.lit(len(bounds))).otherwise(F.col("_own") - 1)
    places = F.when(is_head, F.array(_place(F.col("_own"), 0), _place(before, 1))).otherwise(F.array(_place(F.col("_own"), 0)))
    rows = rows.select("*", F.explode(places).alias("_at")).select(*documents.columns, "_at.range", "_at.guest")
    order = Window.partitionBy("range").orderBy("guest", F.col(key).asc_nulls_first(), value)
    return rows.withColumn(f"next_{value}", F.lead(value).over(order)).where("guest = 0").drop("range", "guest")


def _place(number: Column, guest: int) -> Column:
    return F.struct(number.cast("int").alias("range"), F.lit(guest).alias("guest"))


def _count_at_or_below(bounds: Column, key: Column, n: int) -> Column:
    depth = n.bit_length()
    steps = F.array(*[F.lit(2 ** (depth - 1 - i)) for i in range(depth)]).cast("array<int>")
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when((at + step <= n) & (F.get(bounds, at + step - 1) <= key), at + step).otherwise(at)
    )


def edited_text(text: Column, following: Column) -> Column:
    """The text with its last quarter, floor(n / 4) code points, replaced by the first as many of `following`."""
    n = F.length(text)
    part = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - part), F.substring(following, F.lit(1), part))


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and the
    tree's size and the first edited branch.

    A null text is empty. Repeated rows follow each other in the order and each have a result; with one
    row in all, the next document is the row itself. Empty table: no rows. Other columns are ignored.
    """
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(texts, "text")
    rows = rows.select("doc_id", "text", "next_text", edited_text(F.col("text"), F.col("next_text")).alias("edited"))
    trees = rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        _digest(F.col("edited")).alias("edited_sha256"),
        merkle_tree(F.col("text")).alias("tree"),
        merkle_tree(F.col("edited")).alias("edited_tree"),
        merkle_tree(F.col("next_text")).alias("next_tree"),
    )
    nodes = trees.select(
        "doc_id", "n_chars", "edited_sha256", "tree",
        root_of(F.col("tree")).alias("fingerprint"),
        root_of(F.col("edited_tree")).alias("edited_fingerprint"),
        leaves_of(F.col("tree")).alias("leaves"),
        leaves_of(F.col("edited_tree")).alias("edited_leaves"),
        leaves_of(F.col("next_tree")).alias("next_leaves"),
        first_difference(F.col("tree"), F.col("edited_tree")).alias("edit"),
    )
    return nodes.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("leaves"), F.col("edited_leaves")).alias("near_edited"),
        likeness(F.col("leaves"), F.col("next_leaves")).alias("near_next"),
        F.size("tree").alias("n_sections"),
        F.aggregate("tree", F.lit(0), lambda n, section: n + F.size(section)).alias("n_paragraphs"),
        F.col("edit.section").cast("int").alias("edit_section"),
        F.col("edit.paragraph").cast("int").alias("edit_paragraph"),
    )
