"""Benchmark decontamination by greedy string tiling.

Benchmark items are cut into word seeds. Every text's running seed hashes are looked up among them;
a text and an item that share a seed become a pair, and only pairs are tiled: the longest common run of
unmarked words, found by running Karp-Rabin hashes at halving lengths, is marked again and again, until
no run of `least_match` words is left. An item is leaked where the marked part of it reaches
`threshold`: reordered passages still cover it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from floortally.llm.arrays import doubled, normal_words, text_chunks
from floortally.llm.storage import discard, stored

#: About so many bytes of different benchmark texts are carried by one pass over the documents; more take more passes.
BYTES_PER_BLOCK = 12_000_000


class Seeds:
    """Sorted seed hashes of a block of items, with the item and place of each, behind a bit table."""

    def __init__(self, items: list[np.ndarray], length: int):
        runs = [doubled(words, length) for words in items]
        seeds = np.concatenate([np.zeros(0, np.uint64), *runs])
        item = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.item = seeds[order], item[order]
        self.bits = max(16, int(4 * max(len(seeds), 1)).bit_length() + 4)
        self.table = np.zeros(1 << self.bits, bool)
        self.table[(self.seeds >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def hits(self, runs: np.ndarray) -> np.ndarray:
        """Places of runs that are seeds."""
        at = np.flatnonzero(self.table[(runs >> np.uint64(64 - self.bits)).astype(np.int64)])
        if not len(at) or not len(self.seeds):
            return at[:0]
        near = np.minimum(np.searchsorted(self.seeds, runs[at]), len(self.seeds) - 1)
        return at[self.seeds[near] == runs[at]]

    def items_of(self, run: np.uint64) -> np.ndarray:
        return self.item[np.searchsorted(self.seeds, run, "left") : np.searchsorted(self.seeds, run, "right")]


def _longest(text: np.ndarray, item: np.ndarray, free_text: np.ndarray, free_item: np.ndarray, least: int):
    """The longest common run of free words: place in the text, place in the item, length."""

    def common(length: int):
        """Places of some common run of that length, the first of the item's, then of the text's."""
        a, b = doubled(text, length), doubled(item, length)
        if not len(a) or not len(b):
            return None
        span = lambda free: np.convolve(free, np.ones(length, np.int64), "valid") == length
        at_a, at_b = np.flatnonzero(span(free_text)), np.flatnonzero(span(free_item))
        if not len(at_a) or not len(at_b):
            return None
        order = np.argsort(a[at_a], kind="stable")
        near = np.minimum(np.searchsorted(a[at_a][order], b[at_b]), len(at_a) - 1)
        same = np.flatnonzero(a[at_a][order][near] == b[at_b])
        for k in same:
            i, j = int(at_a[order[near[k]]]), int(at_b[k])
            if np.array_equal(text[i : i + length], item[j : j + length]):
                return i, j, length
        return None

    best, low, high = None, least, min(len(text), len(item))
    while low <= high:  # a run of some length has runs of every smaller one
        middle = (low + high) // 2
        if found := common(middle):
            best, low = found, middle + 1
        else:
            high = middle - 1
    return best


def tiled(text: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in text, place in item, length), longest first, none overlapping."""
    free_text, free_item, tiles = np.ones(len(text), np.int64), np.ones(len(item), np.int64), []
    while tile := _longest(text, item, free_text, free_item, least):
        i, j, n = tile
        free_text[i : i + n] = 0
        free_item[j : j + n] = 0
        tiles.append(tile)
    return tiles


def neighbourhood(hits: np.ndarray, length: int, reach: int, n: int) -> np.ndarray:
    """Word places within reach of a hit: all that a tile can touch, so a long text is not tiled whole."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, np.maximum(hits - reach, 0), 1)
    np.add.at(marks, np.minimum(hits + length + reach, n), -1)
    return np.flatnonzero(np.cumsum(marks[:-1]) > 0)


def leaks(
    documents: DataFrame, benchmark: DataFrame, seed_words: int = 5, least_match: int = 5, threshold: float = 0.5
) -> DataFrame:
    """doc_id, text_hash, item_id, coverage, n_tiles of every text and benchmark item with coverage >= threshold.

    Coverage is the part of the item's words in tiles. Case (A-Z) and ASCII punctuation do not matter.
    An item of fewer than `seed_words` words has one seed, itself. Null or empty texts and items match
    nothing; a null doc_id or item_id is kept; repeated rows give repeated results; with an empty table
    on either side there are no rows; other columns are ignored.
    """
    context = documents.sparkSession.sparkContext
    text = F.coalesce("text", F.lit(""))
    named = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.sha2(text, 256).alias("item_key"))
    # Items of one text are matched once: blocks by the hash of different texts come out even.
    texts = stored(benchmark.select(F.sha2(text, 256).alias("item_key"), text.alias("text")).dropDuplicates(["item_key"]))
    n_blocks = (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BYTES_PER_BLOCK + 1
    rows = documents.selectExpr("cast(doc_id as bigint) doc_id", "text", "xxhash64(text) text_hash")
    parts = []
    for block in range(n_blocks):
        # The benchmark is the stated query set: each pass over all rows carries one block of it, and its
        # matches are written before the next is read.
        items = texts.where(F.pmod(F.xxhash64("item_key"), F.lit(n_blocks)) == block).collect()
        shared = context.broadcast([tuple(r) for r in items])
        schema = "doc_id long, text_hash long, item_key string, coverage double, n_tiles int"
        parts.append(stored(rows.mapInArrow(_matcher(shared, seed_words, least_match, threshold), schema)))
        shared.destroy()
    discard(texts)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.join(named, "item_key").select("doc_id", "text_hash", "item_id", "coverage", "n_tiles")


def _matcher(shared, seed_words: int, least_match: int, threshold: float):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, items = [], []
        for item_id, text in shared.value:
            data = np.frombuffer((text or "").encode(), np.uint8)
            hashes, _ = normal_words(data, np.array([0, len(data)]))
            if len(hashes):
                ids.append(item_id)
                items.append(hashes)
        by_length = {}
        for n in {min(seed_words, len(x)) for x in items}:
            at = [k for k, x in enumerate(items) if min(seed_words, len(x)) == n]
            by_length[n] = (Seeds([items[k] for k in at], n), at)
        for batch in batches:
            out: list[tuple] = []
            doc_ids, text_hashes = batch.column("doc_id"), batch.column("text_hash")
            for rows, data, offsets in text_chunks(batch):
                hashes, begins = normal_words(data, offsets)
                pairs: dict[tuple[int, int], list[int]] = {}
                for n, (seeds, at) in by_length.items():
                    runs = doubled(hashes, n)
                    places = seeds.hits(runs)
                    texts = np.searchsorted(begins, places, "right") - 1
                    inside = places + n <= begins[texts + 1]
                    for place, text in zip(places[inside], texts[inside]):
                        for k in np.unique(seeds.items_of(runs[place])):
                            pairs.setdefault((int(text), at[k]), []).append(int(place - begins[text]))
                for (text, k), places in pairs.items():
                    words, item = hashes[begins[text] : begins[text + 1]], items[k]
                    least = min(least_match, len(item))
                    near = neighbourhood(np.array(places), least, len(item), len(words))
                    # Gaps are closed by words that match nothing, so that no tile runs across one.
                    gaps = np.flatnonzero(np.diff(near) > 1) + 1
                    tiles = tiled(np.insert(words[near], gaps, np.uint64(0)), item, least)
                    coverage = sum(t[2] for t in tiles) / len(item)
                    if coverage >= threshold:
                        out.append((doc_ids[rows.start + text].as_py(), text_hashes[rows.start + text].as_py(), ids[k], coverage, len(tiles)))
            names = ["doc_id", "text_hash", "item_key", "coverage", "n_tiles"]
            types = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int32()]
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return match


def without_leaks(documents: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The documents without those that leak a benchmark item; all columns stay as they are, whatever their names.

    A document is known by its id and text, so a clean row with a leaking row's id stays. Null ids are one id;
    null and empty texts leak nothing and stay; repeated rows go or stay together; empty tables are as in `leaks`."""
    bad = leaks(documents, benchmark, **parameters).select(
        F.col("doc_id").alias("leak_id"), F.col("text_hash").alias("leak_text")
    ).distinct()
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("text"))
    same = F.col("id").eqNullSafe(F.col("leak_id")) & (F.col("text") == F.col("leak_text"))
    return rows.join(bad, same, "left_anti").select("row.*")
