"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

A token's class is its two-byte ending: the most frequent endings of the training corpus are classes of
their own, the others share a few by hash, and the end of a text is one. The model is
p(token | context) = p(class | context) p(token | class). The first factor is a softmax over classes of
weights for the context's features: the previous word (n-gram), the word before it (skip) and both (hashed
n-gram), each by its hash, and the same three of the words' classes. The second is the token's smoothed
count in its class. The class features are learned by gradients, the word features then by a step of
iterative scaling against them; counts, gradients and expectations run over the whole training corpus and are summed
by Spark. Texts are scored in numpy batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from floortally.llm.arrays import LOWER, find_words, joined, mix, text_chunks, word_hashes
from floortally.llm.storage import stored

CLASSES, SHARED = 64, 8
PAIR_BITS = 11
UPDATES = 30
#: Hash rows of each kind of word feature: one per so many different words of the corpus, a power of two in bounds.
WORDS_PER_ROW, ROW_BITS = 256, (14, 16)
#: Part of a full step of iterative scaling, as three word features share a place, and the places a feature must outweigh.
STEP, PRIOR = 0.6, 60.0
#: Tokens whose class scores are held at once, places held before they are summed, tokens whose sums go on together.
BLOCK, CELLS_HELD, TOKENS_PER_TASK = 4096, 1 << 20, 1 << 23
#: Tokens with at least 1 / FREQUENT of the corpus travel with the tasks: no more than FREQUENT of them exist.
FREQUENT = 1 << 18
END = np.uint64(0x5BD1E9955BD1E995)
END_CLASS, START = 0, CLASSES
ENDINGS = 1 << 16


@dataclass
class Tokens:
    """Tokens of a chunk's texts, each text closed by an end token."""

    hashes: np.ndarray
    endings: np.ndarray  # -1 for the end token
    begins: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.begins) - 1), np.diff(self.begins))


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    low = LOWER[data]
    words = find_words(low, offsets)
    n = len(words.text_starts) - 1
    begins = words.text_starts + np.arange(n + 1)
    hashes, endings = np.full(begins[-1], END, np.uint64), np.full(begins[-1], -1, np.int32)
    at = np.ones(begins[-1], bool)
    at[begins[1:] - 1] = False
    hashes[at] = word_hashes(low, words)
    last = low[words.ends - 1].astype(np.int32)
    endings[at] = np.where(words.ends - words.starts > 1, low[np.maximum(words.ends - 2, 0)].astype(np.int32) << 8, 0) | last
    return Tokens(hashes, endings, begins)


def contexts_of(tokens: Tokens, class_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of every token and its context, (class before the previous) * (CLASSES + 1) + previous."""
    classes = np.where(tokens.endings < 0, END_CLASS, class_of[np.maximum(tokens.endings, 0)])
    one, two = np.full(len(classes), START), np.full(len(classes), START)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    first = tokens.begins[:-1]
    one[first] = START
    two[first] = START
    second = first + 1
    two[second[second < tokens.begins[1:]]] = START
    return classes, two * (CLASSES + 1) + one


def row_bits(n_words: int) -> int:
    """Bits of the hash rows for a corpus of so many different words."""
    return min(max(ROW_BITS[0], (n_words // WORDS_PER_ROW).bit_length()), ROW_BITS[1])


def word_features(tokens: Tokens, bits: int) -> np.ndarray:
    """Weight rows of every token's context, a column per kind: previous word, word before it, both."""
    one, two = np.full(len(tokens.hashes), START, np.uint64), np.full(len(tokens.hashes), START, np.uint64)
    one[1:], two[2:] = tokens.hashes[:-1], tokens.hashes[:-2]
    first = tokens.begins[:-1]
    one[first] = START
    two[first] = START
    second = first + 1
    two[second[second < tokens.begins[1:]]] = START
    rows = [(mix(h) >> np.uint64(64 - bits)).astype(np.int64) for h in (one, two, joined(two, one))]
    return np.stack(rows, axis=1) + (np.arange(3) << bits)


def class_scores(scores: np.ndarray, words: np.ndarray, contexts: np.ndarray, rows: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Natural log of p(class | context) of every token, block by block, from the class features' scores
    per class context and the word features' weights."""
    for start in range(0, len(contexts), BLOCK):
        part = slice(start, start + BLOCK)
        found = scores[contexts[part]]
        for column in rows[part].T:
            found += words[column]
        found -= found.max(axis=1, keepdims=True)
        found -= np.log(np.exp(found).sum(axis=1, keepdims=True))
        yield part, found


def word_weights(texts: DataFrame, class_of: np.ndarray, scores: np.ndarray, bits: int, n_tokens: int) -> np.ndarray:
    """Weights of the word features by a step of iterative scaling: each is the log ratio of how often a class
    follows the feature to how often the class features expect it there, over the whole corpus."""
    shared = texts.sparkSession.sparkContext.broadcast((class_of, np.exp(scores), bits))
    parts = texts.select("text").coalesce(1 + n_tokens // TOKENS_PER_TASK)  # a task gives no more than all features once
    sums = parts.mapInArrow(_feature_sums(shared), "feature int, sums binary").repartition("feature")
    weights = np.zeros((3 << bits, CLASSES), np.float32)
    for row in sums.mapInArrow(_scaled, "feature int, weights binary").toLocalIterator():
        weights[row["feature"]] = np.frombuffer(row["weights"], np.float32)
    shared.destroy()
    return weights


def add_sums(sums: np.ndarray, expected: np.ndarray, cells: np.ndarray) -> None:
    """Adds to (feature, seen or expected, class) the places given as (feature, class context, class) in one number."""
    cells = np.sort(cells)
    at = np.flatnonzero(np.append(True, np.diff(cells) > 0))
    n, cells = np.diff(np.append(at, len(cells))), cells[at]
    features, contexts = np.divmod(cells // CLASSES, len(expected))
    np.add.at(sums.reshape(-1), features * (2 * CLASSES) + cells % CLASSES, n.astype(np.float32))
    for start in range(0, len(cells), BLOCK):
        part = slice(start, start + BLOCK)
        new = np.flatnonzero(np.append(True, np.diff(features[part]) > 0))
        rows = expected[contexts[part]] * n[part, None].astype(np.float32)
        sums[features[part][new], 1] += np.add.reduceat(rows, new)


def _feature_sums(shared):
    """Per feature, how often each class follows it, and how often the class features expect that."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of, expected, bits = shared.value
        sums = np.zeros((3 << bits, 2, CLASSES), np.float32)
        held, n = [], 0
        for batch in batches:
            for _, data, offsets in text_chunks(batch):
                tokens = tokens_of(data, offsets)
                classes, contexts = contexts_of(tokens, class_of)
                held.append(((word_features(tokens, bits) * len(expected) + contexts[:, None]) * CLASSES + classes[:, None]).ravel())
                n += len(held[-1])
                if n >= CELLS_HELD:
                    add_sums(sums, expected, np.concatenate(held))
                    held, n = [], 0
        if held:
            add_sums(sums, expected, np.concatenate(held))
        for start in range(0, len(sums), BLOCK):
            seen = start + np.flatnonzero(sums[start : start + BLOCK, 0].any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array([sums[i].tobytes() for i in seen], pa.binary())], ["feature", "sums"])

    return add


def scaled(sums: np.ndarray) -> np.ndarray:
    """The weights of a feature from its sums; PRIOR places like the expected ones are added to both."""
    seen, expected = sums
    prior = PRIOR / seen.sum()
    return STEP * np.log((seen / np.maximum(expected, 1e-30) + prior) / (1 + prior))


def _scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weights of every feature of a partition, which holds all sums of its features."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for feature, sums in zip(batch.column("feature").to_pylist(), batch.column("sums").to_pylist()):
            total[feature] = total.get(feature, 0) + np.frombuffer(sums, np.float32).astype(float).reshape(2, CLASSES)
    weights = [scaled(sums).astype(np.float32).tobytes() for sums in total.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(weights, pa.binary())], ["feature", "weights"])


def token_counts(texts: DataFrame) -> DataFrame:
    """token, ending, n over all texts, end tokens included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [tokens_of(d, o) for _, d, o in text_chunks(batch)]
            if found:
                hashes = np.concatenate([t.hashes for t in found])
                values, first, n = np.unique(hashes, return_index=True, return_counts=True)
                endings = np.concatenate([t.endings for t in found])[first]
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(endings), pa.array(n)], ["token", "ending", "n"])

    rows = texts.select("text").mapInArrow(count, "token long, ending int, n long")
    return rows.groupBy("token").agg(F.first("ending").alias("ending"), F.sum("n").alias("n"))


def context_counts(texts: DataFrame, class_of: np.ndarray) -> DataFrame:
    """context, class, n over all texts: at most (CLASSES + 1)^2 CLASSES rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES + 1) ** 2 * CLASSES, np.int64)
        for batch in batches:
            for _, data, offsets in text_chunks(batch):
                classes, contexts = contexts_of(tokens_of(data, offsets), class_of)
                np.add.at(total, contexts * CLASSES + classes, 1)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell // CLASSES), pa.array(cell % CLASSES), pa.array(total[cell])], ["context", "class", "n"])

    return texts.select("text").mapInArrow(count, "context long, class long, n long").groupBy("context", "class").agg(F.sum("n").alias("n"))


def pair_bucket(context: np.ndarray) -> np.ndarray:
    return ((context.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(32 - PAIR_BITS)).astype(np.int64)


def features(context: np.ndarray) -> np.ndarray:
    """Weight rows of each context: bias, previous class, skip class, hashed pair."""
    k = CLASSES + 1
    return np.stack([np.zeros_like(context), 1 + context % k, 1 + k + context // k, 1 + 2 * k + pair_bucket(context)], axis=1)


N_FEATURES = 1 + 2 * (CLASSES + 1) + (1 << PAIR_BITS)


def log_probabilities(weights: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Natural log of p(class | context) by the class features alone, a row per context."""
    scores = weights[features(context)].sum(axis=1)
    scores -= scores.max(axis=1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def train(counts: DataFrame, updates: int = UPDATES, rate: float = 0.1) -> np.ndarray:
    """Weights after `updates` Adam steps, each on the gradient over the whole corpus, summed by Spark.

    A context's counts stand for all its places in the corpus, so an update costs the contexts, not the
    tokens; each task returns one gradient of fixed size."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    prior = np.ones(CLASSES)
    for row in counts.groupBy("class").agg(F.sum("n").alias("n")).collect():
        prior[row["class"]] += row["n"]
    weights = np.zeros((N_FEATURES, CLASSES), np.float32)
    weights[0] = np.log(prior / prior.sum())
    parts = counts.coalesce(8)  # so many gradients of fixed size reach the driver at once
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, updates + 1):
        found = parts.mapInArrow(_gradient(weights), "gradient binary").collect()  # one of fixed size per task
        gradient = sum((np.frombuffer(r["gradient"], np.float32).reshape(weights.shape) for r in found), np.zeros_like(weights)) / total
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        weights = weights - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-7)
    return weights.astype(np.float32)


def _gradient(weights: np.ndarray):
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gradient = np.zeros(weights.shape, np.float32)
        for batch in batches:
            context, cls, n = (batch.column(c).to_numpy() for c in ("context", "class", "n"))
            own, at = np.unique(context, return_inverse=True)
            seen = np.zeros((len(own), CLASSES))
            np.add.at(seen, (at, cls), n)
            over = np.exp(log_probabilities(weights, own)) * seen.sum(axis=1, keepdims=True) - seen
            for column in features(own).T:
                np.add.at(gradient, column, over.astype(np.float32))
        yield pa.RecordBatch.from_arrays([pa.array([gradient.tobytes()], pa.binary())], ["gradient"])

    return partial


def class_map(endings: DataFrame) -> np.ndarray:
    """Class of each two-byte ending: the most frequent have their own, the rest share SHARED by hash."""
    own = CLASSES - 1 - SHARED
    found = endings.where("ending >= 0").orderBy(F.desc("tokens"), "ending").limit(own).collect()
    class_of = CLASSES - SHARED + np.arange(ENDINGS) * 7 % SHARED
    for k, row in enumerate(found):
        class_of[row["ending"]] = 1 + k
    return class_of


@dataclass
class Model:
    class_of: np.ndarray
    scores: np.ndarray  # of the class features, a row per class context
    words: np.ndarray  # weights of the word features
    bits: int
    class_log10: np.ndarray  # class tokens + class words + 1
    frequent: np.ndarray
    frequent_log10: np.ndarray


def held_out(doc_id: str = "doc_id"):
    """Rows never learned from: crc32 of the id as text leaves 2 modulo 7. A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("bigint").cast("string").cast("binary")) % 7 == 2, F.lit(True))


def scores(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) of every row.

    A null or empty text is its end token alone. A null doc_id is kept and never learned from; repeated
    rows count as often as they occur and are each scored; without training rows every token is unknown;
    an empty table gives no rows; other columns are ignored.
    """
    context = documents.sparkSession.sparkContext
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    training = rows.where(~held_out())
    counts = stored(token_counts(training))
    endings = stored(counts.groupBy("ending").agg(F.sum("n").alias("tokens"), F.count("*").alias("words")))  # 2^16 + 1 rows at most
    n_train, n_words = endings.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    class_of = class_map(endings)
    scores = log_probabilities(train(stored(context_counts(training, class_of))), np.arange((CLASSES + 1) ** 2)).astype(np.float32)
    bits = row_bits(n_words)
    words = word_weights(training, class_of, scores, bits, n_train)

    in_class = np.ones(CLASSES)
    for row in endings.collect():
        in_class[END_CLASS if row["ending"] < 0 else class_of[row["ending"]]] += row["tokens"] + row["words"]
    often = counts.where(F.col("n") >= max(n_train / FREQUENT, 1)).select("token", "n")  # at most FREQUENT rows
    found = often.toPandas().sort_values("token")
    model = Model(class_of, scores, words, bits, np.log10(in_class), found["token"].to_numpy(np.int64), np.log10(found["n"].to_numpy(float) + 1))

    texts = stored(
        rows.withColumn("held_out", held_out())
        .mapInArrow(
            _scorer(context.broadcast(model)),
            "doc_id long, held_out boolean, n_tokens long, n_known long, known_log10 double, steps_log10 double, rare array<long>, times array<int>",
        )
        .withColumn("_row", F.monotonically_increasing_id())
    )
    # What is rare meets its count by a join; tokens without one are unknown and add log10(0 + 1).
    rare = texts.select("_row", F.explode(F.arrays_zip("rare", "times")).alias("t")).select("_row", F.col("t.rare").alias("token"), F.col("t.times").alias("times"))
    less = counts.where(F.col("n") < max(n_train / FREQUENT, 1)).select("token", "n")
    found = rare.join(less, "token").groupBy("_row").agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_log10"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    log10 = F.col("known_log10") + zero("rare_log10")
    return texts.drop("rare", "times").join(found, "_row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + zero("rare_known")).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (log10 - F.col("n_tokens") * float(np.log10(n_train + n_words + 1))).alias("base_score"),
        (log10 + F.col("steps_log10")).alias("score"),
    )


def _scorer(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = ["doc_id", "held_out", "n_tokens", "n_known", "known_log10", "steps_log10", "rare", "times"]
        for batch in batches:
            for rows, data, offsets in text_chunks(batch):
                tokens = tokens_of(data, offsets)
                classes, contexts = contexts_of(tokens, model.class_of)
                text, n = tokens.text_of(), rows.stop - rows.start
                steps = -model.class_log10[classes]
                for part, logs in class_scores(model.scores, model.words, contexts, word_features(tokens, model.bits)):
                    steps[part] += logs[np.arange(len(logs)), classes[part]] / np.log(10)
                sums = lambda x: np.bincount(text, x, n)
                words = tokens.hashes.view(np.int64)
                if len(model.frequent):
                    near = np.minimum(np.searchsorted(model.frequent, words), len(model.frequent) - 1)
                    known = model.frequent[near] == words
                    log10 = np.where(known, model.frequent_log10[near], 0)
                else:
                    known, log10 = np.zeros(len(words), bool), np.zeros(len(words))
                order = np.lexsort((words[~known], text[~known]))
                rare, owner = words[~known][order], text[~known][order]
                new = np.flatnonzero(np.append(True, (rare[1:] != rare[:-1]) | (owner[1:] != owner[:-1]))) if len(rare) else np.zeros(0, int)
                times = np.diff(np.append(new, len(rare))).astype(np.int32)
                ends = np.searchsorted(owner[new], np.arange(n + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (rare[new], times)]
                part = batch.slice(rows.start, n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(np.diff(tokens.begins)), pa.array(sums(known).astype(np.int64)),
                     pa.array(sums(log10)), pa.array(sums(steps)), *lists],
                    names,
                )

    return score
