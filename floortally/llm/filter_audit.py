"""What each of several filters removes, in any order, read off count-weighted decision diagrams.

Every document has a mask of the filters it fails. Spark folds the documents of a part to a count per
mask; a part's counts become a decision diagram whose levels are the filters and whose end nodes are
counts. Two neighbouring levels are swapped in place, so that all orders come up one swap apart, and the
path on which every filter passes gives what each step of an order keeps and removes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from floortally.llm.storage import stored

SPACE = r"[\x20\x09-\x0D]+"
DUPLICATE = "E"
STEP_SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_conditions() -> dict[str, Column]:
    """Failure conditions over the columns `text` and `words`; bit i of a mask is the i-th of them."""
    n_words, n_distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    return {
        "A": n_words < 50,
        "B": n_distinct.cast("long") * 100 < n_words.cast("long") * 65,
        "C": capitals.cast("long") * 100 > F.length("text").cast("long") * 5,
        "D": F.col("text").rlike(r"[#$%&*|]"),
    }


def failure_counts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of each part by the filters they fail.

    Copies of a text are folded per part before they meet, so that a hot text is a few rows; the
    least id of a text decides which of its rows fail `DUPLICATE`.
    """
    conditions = text_conditions()
    read = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source"), F.lit("")).alias("part"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumn("words", F.filter(F.split("text", SPACE), lambda w: w != ""))
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions.values())), F.lit(0))
    known = read.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("text_id"), mask.alias("mask"))
    rows = known.groupBy("doc_id", "text_id", "part", "mask").agg(F.count("*").alias("n"))

    marked = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)
    # Written first: a join on the exchange of its own aggregate could not be split where one id is hot.
    flags = stored(
        labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(marked("quality"), marked("toxic")).withColumnsRenamed({"quality": "good"})
    )
    flagged = rows.join(flags, "doc_id", "left").na.fill(0, ["good", "toxic"])
    cells = stored(
        flagged.groupBy("text_id", "part", "mask", "good", "toxic").agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n")).otherwise(0)).alias("with_id"),
            F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"),
        )
    )
    # A text has at most four cells in each part.
    texts = cells.groupBy("text_id").agg(F.min("least.doc_id").alias("first"), F.count("*").alias("cells"))
    several = texts.where("cells > 1").select("text_id", "first")
    known_first = cells.join(several, "text_id", "left").withColumn("first", F.coalesce("first", "least.doc_id"))
    not_first = F.when(F.col("least.doc_id") == F.col("first"), F.col("with_id") - F.col("least.n")).otherwise(F.col("with_id"))
    split = known_first.withColumn("late", not_first).select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct(F.col("mask"), (F.col("n") - F.col("late")).alias("n")),
            F.struct((F.col("mask") + (1 << len(conditions))).alias("mask"), F.col("late").alias("n")),
        )),
    ).where("n > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


class Diagram:
    """Reduced decision diagram of counts by mask. Every level is kept; equal subdiagrams are one node.

    A node's weight is the sum of the count vectors below it."""

    def __init__(self, counts: dict[int, tuple[int, ...]], names: str):
        self.order = list(names)
        self.children: dict[int, tuple[int, int]] = {}
        self.weight: dict[int, tuple[int, ...]] = {}
        self.levels: list[dict[tuple, int]] = [{} for _ in names]
        self._ends: dict[tuple[int, ...], int] = {}
        self._last = 0
        nothing = (0,) * len(next(iter(counts.values())))
        nodes = [self._end(counts.get(mask, nothing)) for mask in range(1 << len(names))]
        for level in reversed(range(len(names))):
            half = len(nodes) // 2  # the bit of this level tells the two halves apart
            nodes = [self._node(level, nodes[i], nodes[i + half]) for i in range(half)]
        (self.root,) = nodes

    def _end(self, counts: tuple[int, ...]) -> int:
        if counts not in self._ends:
            self._last += 1
            self._ends[counts] = self._last
            self.weight[self._last] = counts
        return self._ends[counts]

    def _node(self, level: int, passes: int, fails: int) -> int:
        known = self.levels[level]
        if (passes, fails) not in known:
            self._last += 1
            known[passes, fails] = self._last
            self.children[self._last] = passes, fails
            self.weight[self._last] = tuple(map(sum, zip(self.weight[passes], self.weight[fails])))
        return known[passes, fails]

    def swap(self, level: int) -> None:
        """Exchanges a level with the next: nodes above and below stay as they are."""
        upper, lower = self.levels[level], self.levels[level + 1]
        self.levels[level], self.levels[level + 1] = {}, {}
        for (passes, fails), node in upper.items():
            both, second = self.children[passes]
            first, none = self.children[fails]
            now = self._node(level + 1, both, first), self._node(level + 1, second, none)
            self.children[node] = now
            self.levels[level][now] = node
        for node in lower.values():
            del self.children[node], self.weight[node]
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[str, tuple, tuple, tuple]]:
        """Along the path on which all pass: filter, counts kept, removed, and failing this filter alone."""
        node = self.root
        for name in self.order:
            passes, fails = self.children[node]
            alone = fails
            while alone in self.children:
                alone = self.children[alone][0]
            yield name, self.weight[passes], self.weight[fails], self.weight[alone]
            node = passes


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap with the next, one after the other, so that each order of n comes up once:
    the last filter wanders through the others, which take one swap whenever it has arrived."""
    if n < 2:
        return
    others, falling = [*adjacent_swaps(n - 1), None], True
    for other in others:
        yield from range(n - 2, -1, -1) if falling else range(n - 1)
        if other is not None:
            yield other + falling
        falling = not falling


def order_steps(counts: dict[int, tuple[int, int, int]], names: str) -> list[tuple]:
    """filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley of all orders."""
    diagram = Diagram(counts, names)
    walks = []
    for level in [None, *adjacent_swaps(len(names))]:
        if level is not None:
            diagram.swap(level)
        walks.append(list(diagram.steps()))
    failing = {walk[0][0]: walk[0][2][0] for walk in walks}  # a filter that comes first removes all that fail it
    shares = dict.fromkeys(names, 0)
    for walk in walks:
        for name, _, removed, _ in walk:
            shares[name] += removed[0]
    return [
        ("".join(s[0] for s in walk), step, kept[0], removed[0], failing[name] - removed[0], alone[0], removed[1], removed[2], shares[name])
        for walk in walks
        for step, (name, kept, removed, alone) in enumerate(walk, 1)
    ]


def filter_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part (`source`), order of the five filters and step: documents kept, removed, redundant (failing
    the step's filter but removed earlier), unique_fails (failing that filter only), good_lost and toxic_lost
    (removed here, labelled so), shapley (removed by that filter, summed over all orders).

    A null source is the part '', a null text empty. A null doc_id is never smaller nor later than another
    and has no labels; repeated rows count each, and rows sharing the least id of a text are all its first.
    A document is good or toxic if any of its label rows says so. An empty table gives no parts; other
    columns are ignored. Texts of any length take one pass; the diagram of a part has at most 32 end nodes.
    """
    names = "".join(text_conditions()) + DUPLICATE

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, cells in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist()):
                steps = order_steps({c["mask"]: (c["n"], c["good"], c["toxic"]) for c in cells}, names)
                columns = [pa.array([part] * len(steps)), *(pa.array(c) for c in zip(*steps))]
                columns[2] = columns[2].cast(pa.int32())
                yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in STEP_SCHEMA.split(", ")])

    counts = failure_counts(documents, labels)
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    return parts.mapInArrow(audit, STEP_SCHEMA)
