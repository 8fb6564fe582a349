"""Substring dedup on a compacted de Bruijn graph of words.

Edges of the graph are the k-mers of `length` words, nodes the k - 1 words two edges share. Edges enter as
super-k-mers: neighbouring edges with the same least-hash minimizer, so that all places of an edge meet
under one key of a join without a row per word. Where copies branch off, super-k-mers are broken up by deeper
minimizers down to single edges. Each repeated piece knows its source, the first place of the same words;
pieces that follow each other both in their text and in the source are a nonbranching path and compacted
into one span, whose source coordinates verify that it repeats an earlier document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from floortally.llm.arrays import find_words, text_chunks, word_hashes
from floortally.llm.storage import discard, stored
from floortally.llm.windows import lists_of, runs, settle

LENGTH = 50
DEPTHS = (0.24, 0.64, 0.9, 1.0)
LAST = 2**63 - 1


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, text, uid (key of the row) and doc: the id by which documents are ordered, null last."""
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("uid"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"),
    )


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for rows, data, offsets in text_chunks(batch):
        words = find_words(data, offsets)
        yield np.arange(rows.start, rows.stop), word_hashes(data, words), words.text_starts


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    column = batch.column("codes")
    for first in range(0, len(column), 2048):
        pieces = [np.frombuffer(p.as_py(), np.uint64) for p in column[first : first + 2048]]
        yield np.arange(first, first + len(pieces)), np.concatenate(pieces), np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)


_SLICES = "uid long, doc long, piece int, codes binary"


def _cut(length: int, column: str):
    """Word codes of the listed runs' whole reach, from a text or an earlier slice."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            origin, uids = batch.column("piece").to_pylist(), batch.column("uid").to_pylist()
            for k in range(len(batch)):
                if column == "text":
                    data = np.frombuffer(batch.column("text")[k].as_py().encode(), np.uint8)
                    codes = word_hashes(data, find_words(data, np.array([0, len(data)])))
                else:
                    codes = np.frombuffer(batch.column("codes")[k].as_py(), np.uint64)
                for run in batch.column("found")[k].as_py():
                    at = run["start"] - origin[k]
                    out.append((uids[k], run["doc"], run["start"], codes[at : at + run["n"] + length - 1].tobytes()))
            columns = list(zip(*out)) or [()] * 4
            types = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["uid", "doc", "piece", "codes"])

    return cut


def repeated_spans(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """uid, start, stop (words), source, source_start of the windows that also start in a smaller document:
    maximal nonbranching paths, which may overlap where they branch."""
    rows = keyed(documents).where("text is not null").select("uid", "doc", F.lit(0).alias("piece"), "text")
    depths = [max(1, round(d * length)) for d in DEPTHS]
    first = stored(runs(rows, _texts, length, depths[0]))
    spans, deeper = settle(first, length, smaller_document=True)
    found = [spans]
    discard(first)
    texts = rows.dropDuplicates(["uid"]).select("uid", "piece", "text")
    slices = stored(texts.join(lists_of(deeper, "doc", "start", "n"), "uid").mapInArrow(_cut(length, "text"), _SLICES))
    for depth in depths[1:]:
        pass_runs = stored(runs(slices, _slices, length, depth))
        spans, deeper = settle(pass_runs, length, smaller_document=True)
        found.append(spans)
        if depth < length:
            listed = deeper.groupBy("uid", "piece").agg(F.collect_list(F.struct("doc", "start", "n")).alias("found"))
            cut = stored(slices.drop("doc").join(listed, ["uid", "piece"]).mapInArrow(_cut(length, "codes"), _SLICES))
            discard(slices)
            slices = cut
        discard(pass_runs)
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionByName(more)
    return compacted(spans, length)


def compacted(spans: DataFrame, length: int) -> DataFrame:
    """Pieces that continue each other, in the text and in the source, as one span. The windows are those
    of one text and source, never longer than the text."""
    along = Window.partitionBy("uid", "source", F.col("source_start") - F.col("start")).orderBy("start", "stop")
    gap = F.col("start") > F.coalesce(F.lag("stop").over(along), F.lit(-1)) - (length - 1)
    paths = spans.withColumn("_shift", F.col("source_start") - F.col("start")).withColumn("_gap", gap.cast("int")).withColumn("_path", F.sum("_gap").over(along))
    return paths.groupBy("uid", "source", "_shift", "_path").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("source_start").alias("source_start")
    ).select("uid", "start", "stop", "source", "source_start")


def without_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (words joined by one space) of every row.

    A word goes if a window of `length` words that covers it also starts in a document of smaller doc_id.
    A null text has no words; a null doc_id counts as the largest; rows of one doc_id do not repeat each
    other; an empty table gives no rows; other columns are ignored.
    """
    spans = lists_of(repeated_spans(documents, length), "start", "stop")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column("text"), batch.column("found")):
                data, spans = (text.as_py() or "").encode(), found.as_py() or []
                words = data.split()  # at blanks and \x09-\x0D
                kept = words
                if spans:
                    change = np.zeros(len(words) + 1, np.int32)
                    np.add.at(change, [s["start"] for s in spans], 1)
                    np.add.at(change, [s["stop"] for s in spans], -1)
                    kept = [w for w, gone in zip(words, np.cumsum(change[:-1]).tolist()) if not gone]
                joined = b" ".join(kept)
                out.append((len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode()))
            columns = list(zip(*out)) or [()] * 4
            types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types)]], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
            )

    rows = keyed(documents).join(spans, "uid", "left").select("doc_id", "text", "found")
    return rows.mapInArrow(remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")

