"""Toxicity of texts by a bidirectional gated recurrent network over word and character inputs.

A word's input is the embedding of its hash and the mean embedding of its four-byte pieces, blanks at
both ends included. Two gated recurrent layers read a window of words from either side, attention pools
their states, and a logistic unit scores the window. Gates are clipped lines and candidates softsigns, in
training as in scoring. Every text is scored on all its overlapping windows, one from every word; a text's
score is a logistic function of its highest window and its sum of window scores.
Training is numpy in one task over a bounded sample of labelled rows; scoring runs in Arrow batches.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from floortally.llm.arrays import find_words, plain_bytes, text_chunks, word_hashes
from floortally.llm.storage import discard, stored

WORD_BITS, CHAR_BITS, EMBED, HIDDEN = 15, 13, 8, 8
WINDOW = 24
#: Training picks its examples among windows so many words apart; scoring reads a window from every word.
STRIDE = 20
#: Windows whose states are held at a time.
WINDOWS_AT_ONCE = 4_096
#: Labelled rows that training reads at most, by label.
TRAINING_ROWS = {1: 1_500, 0: 3_500}
LEAST_STEPS = 150
THRESHOLD = 0.3


@dataclass
class Words:
    """A chunk's words as inputs: embedding rows of words and of their byte pieces."""

    word: np.ndarray
    piece: np.ndarray
    piece_starts: np.ndarray
    begins: np.ndarray


def inputs_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    plain = plain_bytes(data)
    words = find_words(plain, offsets)
    word = (word_hashes(plain, words) >> np.uint64(64 - WORD_BITS)).astype(np.int32)
    # Pieces run from the blank before a word to the blank after it.
    padded = np.full(len(plain) + 4, 0x20, np.uint32)
    padded[1 : len(plain) + 1] = plain
    code = padded[:-3] | padded[1:-2] << np.uint32(8) | padded[2:-1] << np.uint32(16) | padded[3:] << np.uint32(24)
    piece = ((code * np.uint32(2654435761)) >> np.uint32(32 - CHAR_BITS)).astype(np.int16)
    return Words(word, piece, words.starts, words.text_starts)


def vectors(p: dict[str, np.ndarray], words: Words) -> np.ndarray:
    """Input vector of each word. The last byte pieces of a gap count to the word before it."""
    if not len(words.word):
        return np.zeros((0, 2 * EMBED), np.float32)
    sums = np.add.reduceat(p["chars"][words.piece], words.piece_starts, axis=0)
    n = np.diff(np.append(words.piece_starts, len(words.piece)))
    return np.concatenate([p["words"][words.word], sums / n[:, None].astype(np.float32)], axis=1)


def windows_of(begins: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Window starts (word places) and the text of each: every `stride` words, to the text's end.
    A text without words has none."""
    n = np.diff(begins)
    count = np.where(n > 0, np.maximum(0, -(-(n - WINDOW) // stride)) + 1, 0)
    text = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return begins[text] + nth * stride, text


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial(rng: np.random.Generator) -> dict[str, np.ndarray]:
    d, h = 2 * EMBED, HIDDEN
    normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    p = {"words": normal(1 << WORD_BITS, EMBED, scale=0.05), "chars": normal(1 << CHAR_BITS, EMBED, scale=0.05)}
    for way in "fb":
        p |= {f"x{way}": normal(d, 3 * h, scale=0.4), f"h{way}": normal(h, 3 * h, scale=0.3), f"c{way}": np.zeros(3 * h, np.float32)}
    return p | {"attend": normal(2 * h, scale=0.3), "out": normal(2 * h, scale=0.5), "bias": np.zeros(1, np.float32)}


def gate(x: np.ndarray) -> np.ndarray:
    return np.clip(0.25 * x + 0.5, 0, 1)


def slope(g: np.ndarray) -> np.ndarray:
    """Derivative of a gate from its value."""
    return np.float32(0.25) * ((g > 0) & (g < 1))


def softsign(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def states(p: dict, way: str, inputs: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (steps, windows, HIDDEN) of one direction from projected inputs (steps, windows, 3 HIDDEN)."""
    steps, n, _ = inputs.shape
    h, out, k = np.zeros((n, HIDDEN), np.float32), np.empty((steps, n, HIDDEN), np.float32), HIDDEN
    for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
        rec = h @ p[f"h{way}"]
        gates = gate(inputs[t, :, : 2 * k] + rec[:, : 2 * k])
        u, r = gates[:, :k], gates[:, k:]
        new = softsign(inputs[t, :, 2 * k :] + r * rec[:, 2 * k :])
        step = mask[t][:, None]
        after = h + step * u * (new - h)
        if keep is not None:
            keep.append((t, h, u, r, new, rec[:, 2 * k :], step))
        h = out[t] = after
    return out


def full_windows(p: dict, x: np.ndarray) -> np.ndarray:
    """Logits of the windows of WINDOW words that begin at each word of `x` (words, inputs), as `forward` gives them.

    Windows stand side by side, so that a step's inputs are one slice. Attention and output need two numbers
    of a state, its weight's logit and its value, which come with the next step's product."""
    n, k = len(x) - WINDOW + 1, HIDDEN
    logits = np.empty(max(n, 0), np.float32)
    ways = {}
    for i, way in enumerate("fb"):
        inputs = p[f"x{way}"].T @ x.T
        inputs += p[f"c{way}"][:, None]
        recurrent = np.concatenate([p[f"h{way}"].T, p["attend"][None, i * k : (i + 1) * k], p["out"][None, i * k : (i + 1) * k]])
        inputs[: 2 * k] *= np.float32(0.25)
        inputs[: 2 * k] += np.float32(0.5)
        recurrent[: 2 * k] *= np.float32(0.25)
        ways[way] = inputs, np.ascontiguousarray(recurrent, np.float32)
    for at in range(0, n, WINDOWS_AT_ONCE):
        m = min(WINDOWS_AT_ONCE, n - at)
        told = np.zeros((WINDOW, 2, m), np.float32)
        for way, (inputs, recurrent) in ways.items():
            h, rec = np.zeros((k, m), np.float32), np.empty((3 * k + 2, m), np.float32)
            gates, new, size = (np.empty((c * k, m), np.float32) for c in (2, 1, 1))
            last = None
            for t in range(WINDOW) if way == "f" else range(WINDOW - 1, -1, -1):
                now = inputs[:, at + t : at + t + m]
                if last is None:
                    gates[:], new[:] = now[: 2 * k], now[2 * k :]
                else:
                    np.matmul(recurrent, h, out=rec)
                    told[last] += rec[3 * k :]
                    np.add(now[: 2 * k], rec[: 2 * k], out=gates)
                np.clip(gates, 0, 1, out=gates)
                if last is not None:
                    np.multiply(rec[2 * k : 3 * k], gates[k:], out=new)
                    new += now[2 * k :]
                np.abs(new, out=size)
                size += 1
                new /= size
                new -= h
                new *= gates[:k]
                h += new
                last = t
            told[last] += recurrent[3 * k :] @ h
        weight, value = told[:, 0], told[:, 1]
        weight -= weight.max(0)
        np.exp(weight, out=weight)
        value *= weight
        logits[at : at + m] = value.sum(0) / weight.sum(0) + p["bias"][0]
    return logits


def forward(p: dict, x: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logits of windows: x the words' vectors, `at` (steps, windows) their places, `mask` which are real."""
    tapes = {w: [] if keep is not None else None for w in "fb"}
    both = np.concatenate([states(p, w, (x @ p[f"x{w}"] + p[f"c{w}"])[at], mask, tapes[w]) for w in "fb"], axis=2)
    scores = np.where(mask > 0, both @ p["attend"], np.float32(-1e9))
    weights = np.exp(scores - scores.max(0))
    weights /= weights.sum(0)
    pooled = np.einsum("tn,tnk->nk", weights, both)
    if keep is not None:
        keep |= {"tapes": tapes, "both": both, "weights": weights, "pooled": pooled}
    return pooled @ p["out"] + p["bias"][0]


def gradients(p: dict, x: np.ndarray, at: np.ndarray, mask: np.ndarray, target: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the mean log loss for the weights and for the words' vectors."""
    keep: dict = {}
    logits = forward(p, x, at, mask, keep)
    d = ((sigmoid(logits) - target) / len(target)).astype(np.float32)
    both, weights, pooled = keep["both"], keep["weights"], keep["pooled"]
    g = {"out": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
    d_pooled = d[:, None] * p["out"]
    d_weights = np.einsum("nk,tnk->tn", d_pooled, both)
    d_scores = weights * (d_weights - (weights * d_weights).sum(0))
    d_both = weights[:, :, None] * d_pooled + d_scores[:, :, None] * p["attend"]
    g["attend"] = np.einsum("tn,tnk->k", d_scores, both)
    dx, k = np.zeros_like(x), HIDDEN
    for i, way in enumerate("fb"):
        grad, d_states = np.zeros((at.shape[1], k), np.float32), d_both[:, :, i * k : (i + 1) * k]
        d_in, g[f"h{way}"] = np.zeros((*at.shape, 3 * k), np.float32), np.zeros_like(p[f"h{way}"])
        for t, h, u, r, new, rec, step in reversed(keep["tapes"][way]):
            grad = grad + d_states[t]
            d_new = grad * step * u * (1 - np.abs(new)) ** 2
            d_u = grad * step * (new - h) * slope(u)
            d_r = d_new * rec * slope(r)
            d_in[t] = np.concatenate([d_u, d_r, d_new], axis=1)
            d_rec = np.concatenate([d_u, d_r, d_new * r], axis=1)
            g[f"h{way}"] += h.T @ d_rec
            grad = grad * (1 - step * u) + d_rec @ p[f"h{way}"].T
        flat = d_in.reshape(-1, 3 * k)
        g[f"c{way}"] = flat.sum(0)
        per_word = np.zeros((len(x), 3 * k), np.float32)
        np.add.at(per_word, at.ravel(), flat)
        g[f"x{way}"] = x.T @ per_word
        dx += per_word @ p[f"x{way}"].T
    return g, dx


@dataclass
class Adam:
    rate: float = 0.01
    step: int = 0
    moments: dict = field(default_factory=dict)

    def update(self, p: dict, g: dict) -> None:
        self.step += 1
        for k, grad in g.items():
            m, v = self.moments.get(k, (0.0, 0.0))
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            self.moments[k] = (m, v)
            p[k] -= (self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)).astype(np.float32)


def evidence(of_part, parts: list[Words], labels: np.ndarray, size: int) -> np.ndarray:
    """Log-odds of a label-1 text by the units (hashed words or pieces) it contains, shrunk for rare units."""
    counts, done = {0: np.zeros(size), 1: np.zeros(size)}, 0
    for part in parts:
        n = len(part.begins) - 1
        units, texts = of_part(part)
        seen = np.unique(units.astype(np.int64) * n + texts)
        label = labels[done + seen % n]
        for y in counts:
            counts[y] += np.bincount(seen[label == y] // n, minlength=size)
        done += n
    odds = np.log((counts[1] + 0.5) / ((labels == 1).sum() + 1)) - np.log((counts[0] + 0.5) / ((labels == 0).sum() + 1))
    return (np.clip(odds, -4, 4) * np.minimum(1, (counts[0] + counts[1]) / 6)).astype(np.float32)


def word_units(words: Words) -> tuple[np.ndarray, np.ndarray]:
    return words.word, np.repeat(np.arange(len(words.begins) - 1), np.diff(words.begins))


def piece_units(words: Words) -> tuple[np.ndarray, np.ndarray]:
    if not len(words.word):
        return np.zeros(0, int), np.zeros(0, int)
    return words.piece[words.piece_starts[0] :], np.repeat(word_units(words)[1], np.diff(np.append(words.piece_starts, len(words.piece))))


def whole(parts: list[Words]) -> Words:
    """The parts' words as one."""
    words, pieces = np.cumsum([0, *[len(p.word) for p in parts]]), np.cumsum([0, *[len(p.piece) for p in parts]])
    return Words(
        np.concatenate([p.word for p in parts]), np.concatenate([p.piece for p in parts]),
        np.concatenate([p.piece_starts + n for p, n in zip(parts, pieces)]),
        np.concatenate([[0], *[p.begins[1:] + n for p, n in zip(parts, words)]]).astype(np.int64),
    )


@dataclass
class Model:
    weights: dict[str, np.ndarray]
    pooling: np.ndarray  # bias, highest window, log of the sum of window scores

    def features(self, words: Words) -> np.ndarray:
        """Per text: 1, highest window logit, log of 1 + the sum of window scores."""
        n = len(words.begins) - 1
        starts, text = windows_of(words.begins, 1)
        found = np.zeros((n, 3))
        found[:, 0], found[:, 1] = 1, -8
        if len(starts):
            logits = window_logits(self.weights, words, starts, text)
            np.maximum.at(found[:, 1], text, np.clip(logits, -8, 8))
            found[:, 2] = np.log1p(np.bincount(text, sigmoid(logits) ** 2, n))
        return found

    def score(self, words: Words) -> np.ndarray:
        return sigmoid(self.features(words) @ self.pooling)


def window_logits(p: dict, words: Words, starts: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Logits of the windows from every word: those of long texts side by side, a short text's one with a mask."""
    x, logits = vectors(p, words), np.empty(len(starts), np.float32)
    n = np.diff(words.begins)
    long = n >= WINDOW
    if long.any():
        inside = np.repeat(long, n)
        place = np.cumsum(inside) - 1  # of a word among those of long texts
        found = full_windows(p, x[inside])
        whole_ones = long[text]
        logits[whole_ones] = found[place[starts[whole_ones]]]
    rest = np.flatnonzero(~long[text])
    for k in range(0, len(rest), WINDOWS_AT_ONCE):
        some = rest[k : k + WINDOWS_AT_ONCE]
        at = starts[some][None, :] + np.arange(WINDOW)[:, None]
        ends = words.begins[text[some] + 1][None, :]
        used, local = np.unique(np.minimum(at, ends - 1), return_inverse=True)
        logits[some] = forward(p, x[used], local.reshape(at.shape), (at < ends).astype(np.float32))
    return logits


def joined_texts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    coded = [(t or "").encode() for t in texts]
    return np.frombuffer(b"".join(coded), np.uint8), np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int64)


def train(
    texts: list[str | None], labels: np.ndarray, rate: float | None = None, epochs: int = 4, batch: int = 128, seed: int = 7
) -> Model:
    """The network from windows of two thirds of the texts, the pooling from all windows of all texts.

    Of a label-1 text its window of most evidence is an example; of a label-0 text that and another.
    `rate` is the part of label 1 among all labelled rows, where the texts are a sample by label."""
    rng, labels = np.random.default_rng(seed), np.asarray(labels)
    p = initial(rng)
    parts = [inputs_of(*joined_texts(texts[k : k + 100])) for k in range(0, len(texts), 100)]
    words = whole(parts) if parts else inputs_of(*joined_texts([]))
    if not len(words.word) or len(set(labels.tolist())) < 2:
        return Model(p, np.array([np.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5)), 0.0, 0.0]))
    p["words"][:, 0] = evidence(word_units, parts, labels, 1 << WORD_BITS)
    p["chars"][:, 0] = evidence(piece_units, parts, labels, 1 << CHAR_BITS)
    starts, text = windows_of(words.begins)
    at = np.minimum(starts[:, None] + np.arange(WINDOW), words.begins[text + 1][:, None] - 1)
    fed = text % 3 != 2 if len(texts) > 30 else text >= 0
    weight = np.maximum(p["words"][words.word, 0], 0)[at].sum(1)
    order = np.lexsort((-weight, text))
    best = order[np.append(True, text[order][1:] != text[order][:-1])]
    others = rng.permutation(np.flatnonzero(labels[text] == 0))[: len(best)]
    examples = np.concatenate([best, others])
    examples = examples[fed[examples]]
    adam = Adam()
    for _ in range(max(epochs, -(-LEAST_STEPS // max(1, len(examples) // batch)))):
        for part in np.array_split(rng.permutation(examples), max(1, len(examples) // batch)):
            places = starts[part][None, :] + np.arange(WINDOW)[:, None]
            mask = (places < words.begins[text[part] + 1][None, :]).astype(np.float32)
            used, local = np.unique(np.minimum(places, words.begins[text[part] + 1][None, :] - 1), return_inverse=True)
            x, back = _some_vectors(p, words, used)
            g, dx = gradients(p, x, local.reshape(places.shape), mask, labels[text[part]])
            adam.update(p, g | back(dx))
    model = Model(p, np.zeros(3))
    had = labels.mean()
    rate = had if rate is None else rate
    model.pooling = _logistic(np.concatenate([model.features(part) for part in parts]), labels, np.where(labels == 1, rate / had, (1 - rate) / (1 - had)))
    return model


def _some_vectors(p: dict, words: Words, used: np.ndarray):
    """Vectors of some words, and the way back from their gradients to the tables'."""
    ends = np.append(words.piece_starts[1:], len(words.piece))[used]
    n = ends - words.piece_starts[used]
    owner = np.repeat(np.arange(len(used)), n)
    piece = words.piece[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(words.piece_starts[used], n)]
    sums = np.zeros((len(used), EMBED), np.float32)
    np.add.at(sums, owner, p["chars"][piece])
    x = np.concatenate([p["words"][words.word[used]], sums / n[:, None].astype(np.float32)], axis=1)

    def back(dx: np.ndarray) -> dict[str, np.ndarray]:
        g = {"words": np.zeros_like(p["words"]), "chars": np.zeros_like(p["chars"])}
        np.add.at(g["words"], words.word[used], dx[:, :EMBED])
        np.add.at(g["chars"], piece, (dx[:, EMBED:] / n[:, None].astype(np.float32))[owner])
        return g

    return x, back


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(30):
        q = sigmoid(x @ w)
        curve = x.T @ (x * (weight * q * (1 - q))[:, None]) + ridge * np.eye(len(w))
        w = w - np.linalg.solve(curve, x.T @ (weight * (q - y)) + ridge * w)
    return w


def held_out(doc_id: str = "doc_id"):
    """Rows never trained on: crc32 of the id as text leaves 2 modulo 4. A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("bigint").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit(documents: DataFrame, labels: DataFrame, rows: dict[int, int] = TRAINING_ROWS) -> Model:
    """A model from at most `rows` labelled texts of each label, the first by a hash of their id.
    Null labels, ids or held-out ids are not read. Without both labels the score is one constant."""
    known = labels.selectExpr("cast(doc_id as bigint) doc_id", "cast(toxic as int) toxic").where("toxic in (0, 1)").where(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rate = known.agg(F.avg("toxic")).first()[0]
    order = (F.xxhash64("doc_id", F.lit(5)), F.col("doc_id"))
    first = [known.where(F.col("toxic") == label).orderBy(*order).limit(n) for label, n in rows.items()]
    ids = first[0].unionByName(first[1])
    # Written first, so that the documents are not scanned by the one task that trains on what `rows` bounds.
    texts = stored(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id"))
    model = texts.coalesce(1).mapInArrow(_trainer(rate), "model binary").first()
    discard(texts)
    return Model(*pickle.loads(model["model"])) if model else Model(initial(np.random.default_rng(7)), np.array([-2.0, 0.0, 0.0]))


def _trainer(rate: float | None):
    def fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(list(batches)).to_pandas().sort_values(["doc_id", "text"])
        if len(found):
            model = train(found["text"].tolist(), found["toxic"].to_numpy(np.int64), rate)
            plain = (model.weights, model.pooling)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(plain)], pa.binary())], ["model"])

    return fit_all


def scored(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, held_out, score, predicted of every row.

    A null or empty text is scored as a text without windows; repeated rows get the same score; a null
    doc_id is kept; an empty table gives no rows; other columns are ignored."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # its size is fixed by the constants above

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = np.zeros(len(batch))
            for rows, data, offsets in text_chunks(batch):
                found[rows] = own.score(inputs_of(data, offsets))
            columns = [*batch.columns[:3], pa.array(found), pa.array((found >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "held_out", "score", "predicted"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(score, "doc_id long, text_hash long, held_out boolean, score double, predicted int")


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents not predicted toxic, all columns as they are, whatever their names.

    A document is known by id and text: rows that share an id are judged each by its own text, null ids are one
    id, repeated rows go or stay together. Null and empty texts are scored as texts without windows; texts of any
    length are read whole; an empty table stays empty."""
    model = fit(documents, labels)
    bad = scored(documents, model).where("predicted = 1").select(
        F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_text")
    ).distinct()
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("text"))
    same = F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("text") == F.col("bad_text"))
    return rows.join(bad, same, "left_anti").select("row.*")
