"""Words and hashes of Arrow text batches as numpy arrays: no Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# White space of the word pattern [^\x20\x09-\x0D]+.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_random = np.random.default_rng(20240131)
BYTE_CODES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _MIX, _JOIN = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0xD6E8FEB86659FD93))
CHUNK_BYTES = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the word; not linear, so that sums of codes do not cancel."""
    h = h * _MIX
    h ^= h >> np.uint64(29)
    h *= _BASE
    h ^= h >> np.uint64(32)
    return h


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring pieces from the hashes of each."""
    h = left * _JOIN
    h += right
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def doubled(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of every `length` consecutive tokens, from token codes, by log2(length) joins of halves."""
    have = 1
    while have * 2 <= length:
        h = joined(h[:-have], h[have:]) if len(h) > have else h[:0]
        have *= 2
    if have < length:
        rest = length - have
        h = joined(h[:-rest], h[rest:]) if len(h) > rest else h[:0]
    return h


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum over every `width` consecutive entries."""
    have = 1
    while have * 2 <= width:
        h = np.minimum(h[:-have], h[have:]) if len(h) > have else h[:0]
        have *= 2
    if have < width:
        rest = width - have
        h = np.minimum(h[:-rest], h[rest:]) if len(h) > rest else h[:0]
    return h


def text_chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Rows of a batch in runs of about `limit` bytes (never less than one whole text):
    the row slice, the bytes of its texts and their offsets. A null text counts as empty."""
    texts = batch.column(column).cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(texts))
        yield slice(first, last), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


@dataclass
class Words:
    """Words of a chunk: byte range of each, and the range of words of each text."""

    starts: np.ndarray
    ends: np.ndarray
    text_starts: np.ndarray  # word index of each text's first word, and the total at the end
    space: np.ndarray  # of each byte

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.text_starts) - 1), np.diff(self.text_starts))


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    space = SPACES[data]
    begins = ~space
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    stops = begins.copy()
    if len(data):
        begins[1:] &= space[:-1] | edge[1:-1]
        stops[:-1] &= space[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets), space)


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = 1 << max(8, (n - 1).bit_length())
        _powers = np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size - 1, _BASE, np.uint64))])
    return _powers[:n]


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """64-bit hash of every word's bytes."""
    if not len(words.starts):
        return np.zeros(0, np.uint64)
    place = np.zeros(len(data), np.int64)
    place[words.starts] = words.starts
    place = np.arange(len(data)) - np.maximum.accumulate(place)
    codes = BYTE_CODES[data]
    codes[words.space] = 0
    place[words.space] = 0
    codes *= powers(int(place.max()) + 1)[place]
    return mix(np.add.reduceat(codes, words.starts))


#: Bytes between plain words: white space and ASCII punctuation.
BREAKS = SPACES.copy()
BREAKS[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True


def plain_bytes(data: np.ndarray) -> np.ndarray:
    """Without case (A-Z), ASCII punctuation as blanks."""
    plain = LOWER[data]
    plain[BREAKS[data]] = 0x20
    return plain


def normal_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of plain words, and where each text's words begin."""
    plain = plain_bytes(data)
    words = find_words(plain, offsets)
    return word_hashes(plain, words), words.text_starts
