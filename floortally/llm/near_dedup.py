"""Near-duplicate documents by ProbMinHash, banding and verification.

A text is its five-word shingles, weighted by how often they occur. Every shingle runs a Poisson process
whose rate is its weight, seeded by the shingle; each arrival falls on one of the signature's registers,
which keeps the shingle that arrived first. A shingle stops once its next arrival is later than the latest
register, so most stop after one. Two registers agree with the probability Jaccard similarity. Bands of
registers make candidates, and every candidate link is verified on the two whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from floortally.llm.arrays import doubled, mix, normal_words, text_chunks
from floortally.llm.storage import discard, stored

SHINGLE, THRESHOLD = 5, 0.8
#: A link of similarity 0.8 misses all bands with probability (1 - 0.8 ** 4) ** 24, 3 in a million.
BANDS, ROWS = 24, 4
#: Members of a bucket travel in blocks of about so many; two blocks are compared at a time.
BLOCK = 256
#: Pairs of blocks that a task holds at a time, half a megabyte each.
BLOCK_PAIRS_AT_ONCE = 16
#: Candidates agree in so many of all registers, by their low bytes, before their texts are read. At
#: similarity 0.8 fewer agree with probability below 1e-8 (96 registers, mean 77, deviation 4).
LEAST_AGREEING = 54
#: The same for members of buckets that hold several components, who have longer signatures (mean 614, deviation 11).
WIDE, LEAST_WIDE = 768, 552
#: Shingles of texts that a verifying task keeps at hand.
REMEMBERED = 1_000_000
LAST = 2**63 - 1


def shingles_of(data: np.ndarray, offsets: np.ndarray, length: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle hash and weight, sorted by both. A shorter text has one shingle, all its words."""
    words, begins = normal_words(data, offsets)
    n = np.diff(begins)
    runs = doubled(words, length)
    at = np.arange(len(runs))
    text = np.searchsorted(begins, at, "right") - 1
    inside = at + length <= begins[text + 1] if len(at) else np.zeros(0, bool)
    hashes, owner = runs[inside], text[inside]
    for k in np.flatnonzero((n > 0) & (n < length)):
        short = doubled(words[begins[k] : begins[k + 1]], int(n[k]))
        hashes, owner = np.append(hashes, short), np.append(owner, k)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if not len(hashes):
        return owner.astype(np.int64), hashes, np.zeros(0)
    new = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])))
    return owner[new], hashes[new], np.diff(np.append(new, len(hashes))).astype(float)


def signatures(owner: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int, registers: int) -> np.ndarray:
    """ProbMinHash signatures (n, registers); a text without shingles has none set (all zero)."""
    first = np.full(n * registers, np.inf)
    kept = np.zeros(n * registers, np.uint64)
    time = np.zeros(len(hashes))
    state, arrival = hashes, 0
    while len(hashes):
        arrival += 1
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        uniform = ((state >> np.uint64(11)).astype(float) + 0.5) / 2**53
        time = time - np.log(uniform) / weights
        slot = owner * registers + (mix(state ^ np.uint64(0xA5A5A5A5)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, slot, time)
        won = time == first[slot]
        kept[slot[won]] = hashes[won]
        latest = first.reshape(n, registers).max(axis=1)
        going = time < latest[owner]
        owner, hashes, weights, time, state = owner[going], hashes[going], weights[going], time[going], state[going]
    return kept.reshape(n, registers)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of two sorted weighted sets; for equal weights it is the plain one.

    Each common shingle adds 1 / sum_j max(a_j / a_i, b_j / b_i); by order of a_j / b_j these are sums
    of a prefix and a suffix."""
    union = np.union1d(a[0], b[0])
    x, y = np.zeros(len(union)), np.zeros(len(union))
    x[np.searchsorted(union, a[0])], y[np.searchsorted(union, b[0])] = a[1], b[1]
    if not len(union):
        return 1.0
    ratio = np.where(y > 0, x / np.where(y > 0, y, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    x, y = x[order], y[order]
    below_y, from_x = np.cumsum(y) - y, np.cumsum(x[::-1])[::-1]
    both = (x > 0) & (y > 0)
    return float((1 / (from_x[both] / x[both] + below_y[both] / y[both])).sum())


def keyed(documents: DataFrame) -> DataFrame:
    """doc: the id, null last; node: the text's key; text."""
    text = F.coalesce("text", F.lit(""))
    return documents.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("node"), text.alias("text"))


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in text_chunks(batch):
            n = rows.stop - rows.start
            owner, hashes, weights = shingles_of(data, offsets)
            signed = signatures(owner, hashes, weights, n, BANDS * ROWS).reshape(n, BANDS, ROWS)
            keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS))
            for k in range(ROWS):
                keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + signed[:, :, k])
            blank = np.ones(n, bool)
            blank[owner] = False
            counts = np.where(blank, 0, BANDS)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(keys[~blank].ravel().view(np.int64)))
            low = (signed & np.uint64(0xFF)).astype(np.uint8).view(np.int8).ravel()
            sketch = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * (BANDS * ROWS)), pa.array(low))
            part = batch.slice(rows.start, n)
            yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("node"), lists, sketch], ["doc", "node", "keys", "sketch"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    remembered: dict[int, tuple] = {}
    room = REMEMBERED

    def weighted(node: int, text: pa.Scalar) -> tuple:
        nonlocal room
        if node not in remembered:
            data = np.frombuffer(text.as_py().encode(), np.uint8)
            found = shingles_of(data, np.array([0, len(data)]))[1:]
            if len(found[0]) > room:
                remembered.clear()
                room = REMEMBERED
            remembered[node] = found
            room -= len(found[0])
        return remembered[node]

    for batch in batches:
        left, right = batch.column("left_text"), batch.column("right_text")
        nodes = batch.column("left").to_pylist(), batch.column("right").to_pylist()
        found = [similarity(weighted(a, s), weighted(b, t)) for a, b, s, t in zip(*nodes, left, right)]
        yield pa.RecordBatch.from_arrays([batch.column("left"), batch.column("right"), pa.array(found, pa.float64())], ["left", "right", "similarity"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """left, right, similarity of the candidate pairs."""
    both = pairs.join(texts.select(F.col("node").alias("left"), F.col("text").alias("left_text")), "left")
    both = both.join(texts.select(F.col("node").alias("right"), F.col("text").alias("right_text")), "right")
    return both.select("left", "right", "left_text", "right_text").mapInArrow(_verify, "left long, right long, similarity double")


def components(links: DataFrame) -> DataFrame:
    """node, component (a node of it) of linked nodes. Every node moves onto the first of itself and its
    neighbours, by a hash that each round draws anew; links whose ends meet are gone, until none is left.
    The first round's hash is that of the first hubs, so that their stars fold at once."""
    edge = lambda a, b: [F.least(a, b).alias("left"), F.greatest(a, b).alias("right")]
    edges = stored(links.select(*edge("left", "right")).where("left <> right").distinct())
    labels, step = None, 0
    while True:
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(step)).alias("rank"), F.col(c).alias("to"))  # noqa: B023, E731
        both = edges.unionByName(edges.select(F.col("right").alias("left"), F.col("left").alias("right")))
        moves = stored(both.groupBy("left").agg(F.min(rank("right")).alias("near")).select(F.col("left").alias("node"), F.least("near", rank("left"))["to"].alias("to")))
        of = lambda side: moves.select(F.col("node").alias(side), F.col("to").alias(f"{side}_to"))  # noqa: B023, E731
        if labels is None:
            labels = moves.select("node", F.col("to").alias("component"))
        else:
            labels = stored(labels.join(of("component"), "component", "left").select("node", F.coalesce("component_to", "component").alias("component")).repartition("node"))
        moved = edges.join(of("left"), "left").join(of("right"), "right").where("left_to <> right_to")
        edges = stored(moved.select(*edge("left_to", "right_to")).distinct())
        if not edges.limit(1).count():
            return labels
        step += 1


def _between(labels: DataFrame, links: DataFrame) -> DataFrame:
    """left, right: the components that the links join, where they differ."""
    of = lambda side: labels.select(F.col("node").alias(side), F.col("component").alias(f"{side}_component"))
    known = links.join(of("left"), "left", "left").join(of("right"), "right", "left")
    ends = [F.coalesce(f"{side}_component", side).alias(side) for side in ("left", "right")]
    return known.select(*ends).where("left <> right").distinct()


def _relabelled(labels: DataFrame, lower: DataFrame) -> DataFrame:
    """`labels` with each component replaced by the lower one given for it (node, component)."""
    lower = lower.select(F.col("node").alias("component"), F.col("component").alias("lower"))
    alone = lower.select(F.col("component").alias("node"), "component").join(labels, "node", "left_anti")
    after = labels.unionByName(alone).join(lower, "component", "left")
    # By node, lest a large component be one file, which its next reader takes whole.
    return stored(after.select("node", F.coalesce("lower", "component").alias("component")).repartition("node"))


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """`labels` after some more links: components of the graph whose nodes are the components so far."""
    return _relabelled(labels, components(_between(labels, links)))


def _alike(a, b):
    """Whether two sketches agree often enough."""
    same = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda n, v: n + v) >= LEAST_AGREEING


def _hub() -> Column:
    """The member first by a hash. The order is the same in all buckets, so that they mostly share hubs."""
    return F.min(F.struct(F.xxhash64("node", F.lit(0)), F.col("node"), F.col("sketch"))).alias("first")


def _star(members: DataFrame) -> DataFrame:
    """Members with the hub of their bucket where they may be alike."""
    apart = (F.col("node") != F.col("first.node")) & _alike("sketch", "first.sketch")
    return members.where(apart).select("node", F.col("first.node").alias("hub"))


def _wide_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in text_chunks(batch):
            signed = signatures(*shingles_of(data, offsets), rows.stop - rows.start, WIDE)
            low = (signed & np.uint64(0xFF)).astype(np.uint8).tobytes()
            wide = pa.FixedSizeBinaryArray.from_buffers(pa.binary(WIDE), rows.stop - rows.start, [None, pa.py_buffer(low)])
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(rows.start, rows.stop - rows.start), wide.cast(pa.binary())], ["node", "sketch"])


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (key, node, component, weight) of buckets with several components, with the bucket's `size`, its
    largest component `main` and the number `n` of members of that."""
    sizes = stored(labels.groupBy("component").agg(F.count("*").alias("weight")))
    weights = stored(labels.join(sizes, "component"))
    rows = members.join(weights, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component"), F.coalesce("weight", F.lit(1)).alias("weight")
    )
    parts = rows.groupBy("key", "component").agg(F.count("*").alias("n"))
    groups = parts.groupBy("key").agg(F.sum("n").alias("size"), F.count("*").alias("parts"), F.max(F.struct("n", "component")).alias("main"))
    groups = stored(groups.where("parts > 1").select("key", "size", F.col("main.component").alias("main"), F.col("main.n").alias("n")))
    mixed = stored(rows.join(groups, "key"))
    discard(groups, weights, sizes)
    return mixed


def _blocks(mixed: DataFrame, sketches: DataFrame) -> DataFrame:
    """The members of `_mixed` with their sketches, in blocks by a hash of the node: a bucket's blocks below n_apart
    are of members outside its largest component, the n_main others of that component. A bucket of up to BLOCK
    members is the one block 0."""
    whole = F.col("size") <= BLOCK
    number = lambda n: F.ceil(n / BLOCK).cast("long")
    mixed = mixed.withColumns({
        "n_apart": F.when(whole, F.lit(1)).otherwise(number(F.col("size") - F.col("n"))),
        "n_main": F.when(whole, F.lit(0)).otherwise(number(F.col("n"))),
    })
    dealt = lambda n: F.pmod(F.xxhash64("node", F.lit(1)), F.col(n))
    own = F.when(~whole & (F.col("component") == F.col("main")), F.col("n_apart") + dealt("n_main")).otherwise(dealt("n_apart"))
    told = mixed.withColumn("block", own).join(sketches, "node")
    return stored(told.groupBy("key", "block", "n_apart", "n_main").agg(F.collect_list(F.struct("node", "component", "weight", "sketch", "keys")).alias("members")))


def _forest(one: np.ndarray, two: np.ndarray, agree: np.ndarray) -> np.ndarray:
    """Of links between components those that unite two still apart, the most agreeing first."""
    above: dict[int, int] = {}

    def root(c: int) -> int:
        while c in above:
            c = above[c]
        return c

    kept = []
    for k in np.lexsort((two, one, -agree)).tolist():
        a, b = root(int(one[k])), root(int(two[k]))
        if a != b:
            above[a] = b
            kept.append(k)
    return np.array(kept, int)


def _alike_pairs(forest: bool):
    """Pairs of two components between two blocks (within one where the other is null) whose sketches agree often
    enough, from the lighter component to the heavier: all of them, or a spanning forest of the components. A pair
    belongs to the first of its common buckets alone: as it joins two components, that one has several, too."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for column in (batch.column("members"), batch.column("others")):
                node, component, weight, sketch, keys = column.flatten().flatten()
                plain = [x.to_numpy(zero_copy_only=False) for x in (node, component, weight, keys.flatten())]
                plain[3] = plain[3].reshape(-1, BANDS)
                ends = np.append(0, np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
                sides.append((*plain, sketch, ends))
            bucket = batch.column("key").to_numpy()
            alone = batch.column("others").is_null().to_numpy(zero_copy_only=False)
            for k in range(len(batch)):
                members = []
                for *plain, sketch, ends in sides:
                    own = slice(ends[k], ends[k + 1])
                    registers = np.frombuffer(b"".join(sketch[own].to_pylist()), np.uint8).reshape(-1, WIDE)
                    members.append((*(x[own] for x in plain), registers))
                first, second = members[0], members[0 if alone[k] else 1]
                # A part of the registers, pair by pair, then all of them for the pairs that pass.
                agree = np.zeros((len(first[0]), len(second[0])), np.uint8)
                for x, y in zip(first[4][:, : BANDS * ROWS].T, second[4][:, : BANDS * ROWS].T):
                    agree += x[:, None] == y[None, :]
                i, j = np.nonzero(agree >= LEAST_AGREEING)
                keep = first[1][i] != second[1][j]
                if alone[k]:
                    keep &= i < j
                i, j = i[keep], j[keep]
                steps = [slice(n, n + 4096) for n in range(0, len(i), 4096)]
                count = np.concatenate([np.zeros(0, int), *[(first[4][i[s]] == second[4][j[s]]).sum(1) for s in steps]])
                keep = np.flatnonzero(count >= LEAST_WIDE)
                shared = first[3][i[keep]]
                band = (shared == second[3][j[keep]]).argmax(axis=1)
                keep = keep[shared[np.arange(len(keep)), band] == bucket[k]]
                if forest:
                    keep = keep[_forest(first[1][i[keep]], second[1][j[keep]], count[keep])]
                one, two = [x[i[keep]] for x in first[:3]], [x[j[keep]] for x in second[:3]]
                up = (one[2] < two[2]) | ((one[2] == two[2]) & (one[1] < two[1]))
                ends = np.where(up, one[0], two[0]), np.where(up, two[0], one[0]), count[keep].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in ends], ["left", "right", "agree"])

    return pairs


def _candidates(mixed: DataFrame, sketches: DataFrame, forest: bool) -> DataFrame:
    """left, right, agree: pairs of members of one bucket and of two components that may be alike, every one or
    those that would unite the components of a pair of blocks."""
    blocks = _blocks(mixed, sketches)
    last = F.col("n_apart") + F.col("n_main") - 1
    alone = blocks.where("block < n_apart").select("key", "members", F.lit(None).cast(blocks.schema["members"].dataType).alias("others"))
    met = blocks.where((F.col("block") < F.col("n_apart")) & (F.col("block") < last)).select("key", "members", F.explode(F.sequence(F.col("block") + 1, last)).alias("block"))
    met = met.join(blocks.select("key", "block", F.col("members").alias("others")), ["key", "block"]).select("key", "members", "others")
    found = stored(alone.unionByName(met).mapInArrow(_alike_pairs(forest), "left long, right long, agree int").distinct(), BLOCK_PAIRS_AT_ONCE)
    discard(blocks)
    return found


def _untested(pairs: DataFrame, *tested: DataFrame) -> DataFrame:
    """The pairs, whichever way round, that are in no table of tested ones."""
    ends = [F.least("left", "right").alias("low"), F.greatest("left", "right").alias("high")]
    known = tested[0].select(*ends)
    for more in tested[1:]:
        known = known.unionByName(more.select(*ends))
    return pairs.select("*", *ends).join(known, ["low", "high"], "left_anti").drop("low", "high")


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("node", "hub").alias("left"), F.greatest("node", "hub").alias("right")).distinct()


def near_classes(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc, node, text_class (least doc of equal texts), near_class (least doc of the linked class) and near_key
    (a number of the class: the key of its first text by id, then key) of every row.

    Classes are the connected components of the verified links: of two texts in one bucket every pair that may
    be alike is read, unless links join the two already. Texts without words are alike only if
    equal; a null text is the empty one; a null id counts as the largest (LAST); repeated rows share
    their classes; an empty table gives no rows; other columns are ignored.
    """
    rows = keyed(documents)
    nodes = stored(rows.mapInArrow(_band_keys, "doc long, node long, keys array<long>, sketch array<tinyint>").groupBy("node").agg(
        F.min("doc").alias("doc"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")))
    bands = nodes.select("node", "sketch", F.explode("keys").alias("key"))
    shared = stored(bands.select("key").groupBy("key").agg(F.count("*").alias("size")).where("size > 1"))
    members = stored(bands.join(shared, "key").select("key", "node", "size", "sketch"))
    hubs = stored(members.groupBy("key").agg(_hub()))
    tested = stored(_pairs(_star(members.join(hubs, "key"))))
    needed = tested.select(F.explode(F.array("left", "right")).alias("node")).unionByName(
        members.where(F.col("size") > 2).select("node")
    ).distinct()
    # One row of each needed text: equal texts differ in doc, so the least doc's row is taken.
    wanted = needed.join(nodes.select("node", "doc"), "node")
    texts = stored(rows.join(wanted, ["node", "doc"]).select("node", "text").dropDuplicates(["node"]))
    links = stored(verified(tested, texts).where(F.col("similarity") >= threshold))
    labels = components(links)
    everyone = stored(members.select("key", "node"))
    discard(members, hubs, shared)
    mixed = _mixed(everyone, labels)
    sketches = texts.join(mixed.select("node").distinct(), "node").mapInArrow(_wide_sketches, "node long, sketch binary")
    sketches = stored(sketches.join(nodes.select("node", "keys"), "node"))
    # First the links that would unite most: few pairs of two components are left after them, and none of those is left unread.
    read = [tested]
    for forest in (True, False):
        pairs = stored(_untested(_candidates(mixed, sketches, forest), *read).select("left", "right"))
        new = stored(verified(pairs, texts).where(F.col("similarity") >= threshold))
        if new.limit(1).count():
            labels = merged(labels, new)
            if forest:
                discard(mixed)
                mixed = _mixed(everyone, labels)
        read.append(pairs)
    labelled = nodes.select("node", "doc").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = F.min(F.struct("doc", "node")).alias("first")
    least = stored(labelled.groupBy("component").agg(first))  # so that a large class can be split in the join
    classes = labelled.join(least, "component")
    classes = classes.select("node", F.col("doc").alias("text_class"), F.col("first.doc").alias("near_class"), F.col("first.node").alias("near_key"))
    return rows.select("doc", "node").join(classes, "node").select("doc", "node", "text_class", "near_class", "near_key")


def without_near_duplicates(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each near class, all columns as they are, whatever their names.

    It is that of least id, a null id last; among texts of one id that of least key; among repeated rows any.
    Null and empty texts are one text; texts of any length are read whole; an empty table stays empty."""
    kept = near_classes(documents, threshold).where("node = near_key and doc = near_class").select("doc", "node").distinct()
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("node"))
    return rows.join(kept, ["doc", "node"]).dropDuplicates(["doc", "node"]).select("row.*")
