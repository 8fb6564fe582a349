"""Periodic runs of words, found by block convolution.

At scale L the words of a text are cut into blocks of L. A run of period q, L <= q < 2L, that lasts three
periods holds a whole block together with its copy q words on. The squared differences between a block and
every place of the window that follows, summed over the block, come from one product of number-theoretic
transforms per block and window, exact integers modulo 65537; where the sum is zero the block may occur
again. The distances of these places seed extensions, which compare the words themselves: what extends to
three periods is a run. Scales go up, so that a run is known before the multiples of its period.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: The transform: all its powers of two up to 2**16 have roots of unity modulo this prime.
PRIME, GENERATOR = 65537, 3
LONGEST_PATTERN = 1 << 15
#: A run has this many words and periods at least; the first scale must fit both.
LEAST_WORDS, LEAST_PERIODS, FIRST_SCALE = 24, 3, 8
WORDS_PER_CHUNK = 200_000
RUN_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def reduced(x: np.ndarray) -> np.ndarray:
    """Residues of integers below 2**53 in absolute value, in place; a multiple of the prime may stay the prime."""
    quotient = x * (1 / PRIME)
    np.floor(quotient, out=quotient)
    quotient *= PRIME
    x -= quotient
    return x


def _roots(order: int, exponents: np.ndarray) -> np.ndarray:
    """Powers of a root of unity of the given order, as exact doubles."""
    root, table = pow(GENERATOR, (PRIME - 1) // order, PRIME), np.ones(order, np.int64)
    have = 1
    while have < order:  # doubling: entries have..2*have are the first ones times root**have
        table[have : 2 * have] = table[:have] * pow(root, have, PRIME) % PRIME
        have *= 2
    return table[exponents % order].astype(np.float64)


class Transform:
    """Transform of rows of 2**k numbers by one or two matrix products; frequencies come in the order `frequency`.

    Products stay below 2**53, so that doubles hold the integers exactly."""

    def __init__(self, size: int):
        self.size = size
        bits = size.bit_length() - 1
        self.one = 1 << (bits // 2 if size > 32 else 0)
        self.two = size // self.one
        i, j = np.arange(self.one), np.arange(self.two)
        self.first, self.second = _roots(self.one, np.outer(i, i)), _roots(self.two, np.outer(j, j))
        self.twist = _roots(size, np.outer(i, j))
        self.back_first, self.back_second = _roots(self.one, -np.outer(i, i)), _roots(self.two, -np.outer(j, j))
        self.back_twist = _roots(size, -np.outer(i, j)) * pow(size, -1, PRIME) % PRIME
        self.frequency = (i[:, None] + self.one * j[None, :]).ravel()
        place = np.empty(size, np.int64)
        place[self.frequency] = np.arange(size)
        self.opposite = place[-self.frequency % size]
        self.sign = np.where(self.frequency % 2, -1.0, 1.0)  # a shift by half the size

    def forward(self, rows: np.ndarray) -> np.ndarray:
        x = rows.reshape(-1, self.one, self.two)
        if self.one > 1:
            x = reduced(np.matmul(self.first, x))
            x *= self.twist
            reduced(x)
        return reduced(np.matmul(x, self.second)).reshape(-1, self.size)

    def inverse(self, spectra: np.ndarray) -> np.ndarray:
        x = reduced(np.matmul(spectra.reshape(-1, self.one, self.two), self.back_second))
        x *= self.back_twist
        reduced(x)
        if self.one > 1:
            x = reduced(np.matmul(self.back_first, x))
        return x.reshape(-1, self.size)


_transforms: dict[int, Transform] = {}


def transform(size: int) -> Transform:
    if size not in _transforms:
        _transforms[size] = Transform(size)
    return _transforms[size]


def occurrences(texts: list[np.ndarray], scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of a text, starts of its blocks and distances at which they may occur again: L to 2L-1 words
    on, and from 1 on at the first scale. Blocks over `LONGEST_PATTERN` speak by their first words."""
    width = min(scale, LONGEST_PATTERN)
    per_block = scale // width
    whole = [len(x) // width for x in texts]
    rows = [-(-len(x) // width) + 1 for x in texts]
    first_row = np.cumsum([0, *rows])
    codes = np.zeros((first_row[-1], width))
    patterns, windows, owners = [], [], []
    for i, x in enumerate(texts):
        flat = codes[first_row[i] : first_row[i + 1]].reshape(-1)
        flat[: len(x)] = (x * 40503 + 1) % PRIME  # spread codes; those of a text's first 65537 words differ
        ahead = np.arange(0 if scale == FIRST_SCALE else per_block, 2 * per_block)
        block = np.arange(0, whole[i], per_block)
        pattern, window = np.repeat(block, len(ahead)), (block[:, None] + ahead).ravel()
        there = window < whole[i]
        patterns.append(first_row[i] + pattern[there])
        windows.append(first_row[i] + window[there])
        owners.append(np.full(there.sum(), i))
    pattern, window, owner = map(np.concatenate, (patterns, windows, owners))
    if not len(pattern):
        return
    t = transform(2 * width)
    spectra = t.forward(np.concatenate([codes, np.zeros_like(codes)], axis=1))
    squares = codes * codes
    reduced(squares)
    total = squares.sum(axis=1)
    upto = np.concatenate([np.zeros((len(codes), 1)), np.cumsum(squares, axis=1)], axis=1)[:, :width]
    found: list[list[np.ndarray]] = [[], [], []]
    per_step = max(1, WORDS_PER_CHUNK // (2 * width))
    for at in range(0, len(pattern), per_step):
        a, w = pattern[at : at + per_step], window[at : at + per_step]
        after = spectra[w + 1] * t.sign
        after += spectra[w]
        after *= spectra[a][:, t.opposite]
        agreeing = t.inverse(reduced(after))[:, :width]
        # Sum of squared differences at every lag: both sums of squares less twice the products.
        apart = (total[a] + total[w])[:, None] - upto[w] + upto[w + 1] - 2 * agreeing
        reduced(apart)
        pair, lag = np.nonzero((apart == 0) | (apart == PRIME))
        if len(pair):
            found[0].append(owner[at + pair])
            found[1].append((a[pair] - first_row[owner[at + pair]]) * width)
            found[2].append((w[pair] - a[pair]) * width + lag)
    if not found[0]:
        return
    owner, start, distance = map(np.concatenate, found)
    lengths = np.array([len(x) for x in texts])
    ok = (distance > 0) & (start + distance + width <= lengths[owner])
    owner, start, distance = owner[ok], start[ok], distance[ok]
    for own in np.unique(owner):
        mine = owner == own
        yield int(own), start[mine], distance[mine]


def first_difference(left: np.ndarray, right: np.ndarray) -> int:
    """Number of leading entries that agree, looked at in steps of growing size."""
    at, size = 0, 64
    while at < len(left):
        differs = left[at : at + size] != right[at : at + size]
        if differs.any():
            return at + int(differs.argmax())
        at += size
        size *= 2
    return len(left)


def extend(x: np.ndarray, start: np.ndarray, distance: np.ndarray, width: int, runs: list[tuple[int, int, int]]) -> None:
    """Adds to `runs` (start, stop, period) what the seeds extend to. Seeds inside a run whose period
    divides their distance give nothing new."""

    def news(begin: int, stop: int, period: int, s: np.ndarray, d: np.ndarray) -> np.ndarray:
        return (d % period != 0) | (s < begin) | (s + d + width > stop)

    order = np.lexsort((start, distance))
    start, distance = start[order], distance[order]
    for run in runs:
        if run[1] - run[0] >= width + distance[0] if len(distance) else False:
            new = news(*run, start, distance)
            start, distance = start[new], distance[new]
    while len(start):
        s, q = int(start[0]), int(distance[0])
        right = s + first_difference(x[s : len(x) - q], x[s + q :])
        if right - s < width:
            start, distance = start[1:], distance[1:]
            continue
        left = s - first_difference(x[:s][::-1], x[q : s + q][::-1])
        rest = (distance != q) | (start >= right)
        if right + q - left >= max(LEAST_WORDS, LEAST_PERIODS * q):
            runs.append((left, right + q, q))
            rest &= news(left, right + q, q, start, distance)
        start, distance = start[rest], distance[rest]


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Runs (start, stop, smallest period) of sequences of word numbers, by start, then period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    scale = FIRST_SCALE
    while long := [i for i, x in enumerate(texts) if len(x) >= LEAST_PERIODS * scale]:
        for k, start, distance in occurrences([texts[i] for i in long], scale):
            extend(texts[long[k]], start, distance, min(scale, LONGEST_PATTERN), found[long[k]])
        scale *= 2
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers, different ones different numbers."""
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))


def periodic_runs(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, runs and collapsed text of every row.

    A run is a stretch of words of smallest period q, at least 24 words and three periods long, that
    cannot be extended. The collapsed text keeps the words that no run holds beyond its first q, joined
    by a space. Words are `[^\\x20\\x09-\\x0D]+`.

    A null text has no words; a null doc_id and repeated rows are kept; an empty table gives no rows;
    other columns are ignored. A text of any length is read whole, in one task: time grows with its words
    times the square of their logarithm, memory with its words. Of runs over the same words each is listed.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, waiting = batch.column("doc_id"), []
            size = first = 0
            for i, text in enumerate(batch.column("text")):
                waiting.append((text.as_py() or "").encode().split())
                size += len(waiting[-1])
                if size >= WORDS_PER_CHUNK:
                    yield _described(ids.slice(first, len(waiting)), waiting)
                    waiting, size, first = [], 0, i + 1
            if waiting:
                yield _described(ids.slice(first, len(waiting)), waiting)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(find, RUN_SCHEMA)


def _described(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
    found = runs_of([numbered(words) for words in texts])
    collapsed = []
    for words, runs in zip(texts, found):
        kept = np.ones(len(words), bool)
        for start, stop, period in runs:
            kept[start + period : stop] = False
        collapsed.append(b" ".join(itertools.compress(words, kept)))
    flat = np.array([(a, b - a, q) for runs in found for a, b, q in runs], np.int64).reshape(-1, 3)
    offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
    parts = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
    columns = [ids, pa.array([len(w) for w in texts], pa.int64()), pa.ListArray.from_arrays(offsets, parts), pa.array(collapsed, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])


def with_periods(documents: DataFrame) -> DataFrame:
    """Every tenth document, by the hash of its id, made periodic from a word on: h = crc32 of the decimal
    id, g = h // 10, a = g mod n, p = 1 + (n - a) // (3 + g mod 8); word i >= a becomes word a + (i - a) mod p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = documents.select("doc_id", "text", (h % 10 == 0).alias("altered"), F.floor(h / 10).cast("long").alias("g"))
    split = rows.withColumn("words", F.when(F.col("altered"), words)).withColumn("n", F.size("words"))
    at = split.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    changed = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return at.withColumn("p", p).select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))
