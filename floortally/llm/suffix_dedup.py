"""Substring dedup by a depth-limited radix sort of suffixes.

The suffixes of all texts are ordered only through `length` bytes, by most-significant-digit passes: by
the least hash of 64 bytes, then of 160 and 190, then by the whole window. After each pass a suffix alone in its
group leaves, and groups equal throughout are settled; the groups after the last pass are exactly the
repeated windows. See `windows` for how neighbouring suffixes of one group travel as one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from floortally.llm.arrays import BYTE_CODES, text_chunks
from floortally.llm.storage import discard, stored
from floortally.llm.windows import lists_of, runs, settle

LENGTH = 200
#: Depths of the passes as parts of the window's length.
DEPTHS = (0.32, 0.8, 0.95, 1.0)


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, text and uid, the key by which a text's spans find it again; equal rows share one."""
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("uid"))


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for rows, data, offsets in text_chunks(batch):
        yield np.arange(rows.start, rows.stop), BYTE_CODES[data], offsets


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    column = batch.column("bytes")
    for first in range(0, len(column), 2048):
        pieces = [p.as_py() for p in column[first : first + 2048]]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        yield np.arange(first, first + len(pieces)), BYTE_CODES[np.frombuffer(b"".join(pieces), np.uint8)], offsets


def _cut(length: int, column: str):
    """Slices of the listed runs' whole reach, from a text or an earlier slice."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids, docs, starts, pieces = [], [], [], []
            whole, found = batch.column(column), batch.column("found")
            origin = batch.column("piece").to_pylist()
            for k in range(len(batch)):
                data = whole[k].as_py()
                data = data.encode() if isinstance(data, str) else data
                for run in found[k].as_py():
                    at = run["start"] - origin[k]
                    uids.append(batch.column("uid")[k].as_py())
                    docs.append(run["doc"])
                    starts.append(run["start"])
                    pieces.append(data[at : at + run["n"] + length - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids, pa.int64()), pa.array(docs, pa.int64()), pa.array(starts, pa.int32()), pa.array(pieces, pa.binary())], ["uid", "doc", "piece", "bytes"]
            )

    return cut


def repeated_spans(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """uid, start, stop (bytes) of all repeated windows; spans may overlap."""
    rows = keyed(documents).where(F.octet_length("text") >= length).select("uid", F.lit(0).cast("long").alias("doc"), F.lit(0).alias("piece"), "text")
    depths = [max(1, round(d * length)) for d in DEPTHS]
    first = stored(runs(rows, _texts, length, depths[0]))
    spans, deeper = settle(first, length, smaller_document=False)
    discard(first)
    texts = rows.dropDuplicates(["uid"]).select("uid", "piece", F.encode("text", "UTF-8").alias("text"))
    slices = stored(texts.join(lists_of(deeper, "doc", "start", "n"), "uid").mapInArrow(_cut(length, "text"), "uid long, doc long, piece int, bytes binary"))
    found = [spans]
    for depth in depths[1:]:
        pass_runs = stored(runs(slices, _slices, length, depth))
        spans, deeper = settle(pass_runs, length, smaller_document=False)
        found.append(spans)
        if depth < length:
            listed = deeper.groupBy("uid", "piece").agg(F.collect_list(F.struct("doc", "start", "n")).alias("found"))
            cut = stored(slices.drop("doc").join(listed, ["uid", "piece"]).mapInArrow(_cut(length, "bytes"), "uid long, doc long, piece int, bytes binary"))
            discard(slices)
            slices = cut
        discard(pass_runs)
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionByName(more)
    return spans


def without_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (bytes) of every row.

    Every byte of a `length`-byte string that also starts elsewhere goes. A null text is empty; a text
    shorter than `length` keeps all; repeated rows are copies of each other; a null doc_id is kept; an
    empty table gives no rows; other columns are ignored.
    """
    spans = lists_of(repeated_spans(documents, length), "start", "stop")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column("text"), batch.column("found")):
                data, spans = (text.as_py() or "").encode(), found.as_py() or []
                n_spans, kept = 0, data
                if spans:
                    change = np.zeros(len(data) + 1, np.int32)
                    np.add.at(change, [s["start"] for s in spans], 1)
                    np.add.at(change, [s["stop"] for s in spans], -1)
                    gone = np.cumsum(change[:-1]) > 0
                    n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out.append((len(data), len(data) - len(kept), n_spans, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out)) or [()] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            )

    rows = keyed(documents).join(spans, "uid", "left").select("doc_id", "text", "found")
    return rows.mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
