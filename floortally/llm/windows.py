"""Repeated windows of token sequences, found in passes of growing depth.

A window is `length` consecutive tokens of one text. Neighbouring windows whose least `depth`-token hash
is the same form a run and travel as one row: a repeated window has its least hash at the same place in
every copy, so equal windows always meet under one digit. Per digit, runs that agree in their whole reach
form a class and are settled together; only one run of each class of a digit that has several classes (or
repeats itself) goes on to the next, deeper pass, until a digit is a whole window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from floortally.llm.arrays import doubled, joined, sliding_min
from floortally.llm.storage import discard, stored

RUN_SCHEMA = "digit long, sig long, uid long, doc long, piece int, start int, n int, tied boolean"
_NAMES = ["digit", "sig", "uid", "doc", "piece", "start", "n", "tied"]
_LOW = np.uint64(0xFF)


def window_runs(codes: np.ndarray, offsets: np.ndarray, length: int, depth: int) -> tuple[np.ndarray, ...]:
    """Runs of windows of the sequences `codes[offsets[i]:offsets[i + 1]]`: place of the first window,
    number of windows, digit, signature of the whole reach, and whether windows of one run may be equal."""
    reach = length - depth + 1
    if len(codes) < length:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty.astype(bool)
    deep = doubled(codes, depth)
    full = doubled(codes, length)
    if reach == 1:
        digit, tied = full, np.zeros(len(full), bool)
    else:
        # The low byte holds the place, once rising and once falling: ties of the least hash show as two places.
        place = np.arange(len(deep), dtype=np.uint64) & _LOW
        high = deep & ~_LOW
        first, last = sliding_min(high | place, reach), sliding_min(high | (_LOW - place), reach)
        digit = first >> np.uint64(8)
        tied = (first & _LOW) + (last & _LOW) != 255
    ok = np.zeros(len(codes) + 1, np.int32)
    room = np.diff(offsets) >= length
    ok[offsets[:-1][room]] += 1
    ok[offsets[1:][room] - length + 1] -= 1
    ok = np.cumsum(ok[: len(full)]).astype(bool)
    at = np.flatnonzero(ok)
    if not len(at):
        return at, at, at.astype(np.uint64), at.astype(np.uint64), at.astype(bool)
    values = digit[at]
    new = np.ones(len(at), bool)
    new[1:] = (values[1:] != values[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(at)))
    long = size > reach
    tie = np.logical_or.reduceat(tied[at], begin) | long
    if long.any():
        parts = -(-size // reach)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begin, tie = np.repeat(begin, parts) + nth * reach, np.repeat(tie, parts)
        size = np.diff(np.append(begin, len(at)))
    start = at[begin]
    sig = joined(joined(full[start], full[start + size - 1]), size.astype(np.uint64))
    return start, size, digit[start], sig, tie


Sequences = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def runs(rows: DataFrame, sequences: Sequences, length: int, depth: int) -> DataFrame:
    """Runs of all sequences. `rows` have uid, doc, piece (place of the sequence in its text) and what
    `sequences` turns into row numbers, codes and offsets."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, doc, piece = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "doc", "piece"))
            for row, codes, offsets in sequences(batch):
                start, n, digit, sig, tied = window_runs(codes, offsets, length, depth)
                which = np.searchsorted(offsets, start, "right") - 1
                own = row[which]
                columns = [digit.view(np.int64), sig.view(np.int64), uid[own], doc[own], piece[own], piece[own] + start - offsets[which], n, tied]
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(columns, types)], _NAMES)

    return rows.mapInArrow(find, RUN_SCHEMA)


def settle(found: DataFrame, length: int, smaller_document: bool) -> tuple[DataFrame, DataFrame]:
    """Spans of repeated windows (uid, start, stop: places of tokens; source, source_start: the place
    of their first copy), and the runs that need a deeper pass.

    A window counts as repeated if it also starts anywhere else, or, with `smaller_document`, in a
    document of smaller number. All joins are by digit and signature, inner, and so can be split."""
    # Keys are written before they are joined: a join on the exchange of its own aggregate could not be split.
    shared = stored(found.groupBy("digit").agg(F.count("*").alias("_n")).where("_n > 1").select("digit"))
    open_runs = found.join(shared, "digit")
    if not smaller_document:
        # A run alone under its digit can still hold equal windows.
        alone = found.where("tied").join(shared, "digit", "left_anti").select(open_runs.columns)
        open_runs = open_runs.unionByName(alone)
    open_runs = stored(open_runs)
    classes = stored(open_runs.groupBy("digit", "sig").agg(F.count("*").alias("_n"), F.min(F.struct("doc", "uid", "start")).alias("_first")))
    several = stored(classes.groupBy("digit").agg(F.count("*").alias("_classes")).where("_classes > 1").select("digit"))
    known = open_runs.join(classes, ["digit", "sig"])
    repeated = F.col("_first.doc") < F.col("doc") if smaller_document else F.col("_n") > 1
    spans = known.where(repeated).select(
        "uid", "start", (F.col("start") + F.col("n") + length - 1).alias("stop"), F.col("_first.uid").alias("source"), F.col("_first.start").alias("source_start")
    )
    if smaller_document:
        speaks = F.col("_first.doc") == F.col("doc")
    else:
        speaks = F.expr("struct(doc, uid, start) = _first")
    speakers = known.where(speaks).select("uid", "piece", "start", "n", "doc", "digit", "tied")
    deeper = speakers.join(several, "digit")
    if not smaller_document:
        deeper = deeper.unionByName(speakers.where("tied").join(several, "digit", "left_anti").select(deeper.columns))
    settled = stored(spans), stored(deeper.select("uid", "piece", "start", "n", "doc").distinct())
    discard(shared, open_runs, classes, several)
    return settled


def lists_of(rows: DataFrame, *columns: str) -> DataFrame:
    """Per text, its rows in one list: no longer than the text."""
    return rows.groupBy("uid").agg(F.collect_list(F.struct(*columns)).alias("found"))
