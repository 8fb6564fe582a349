"""Operators against brute force on small fixtures: nulls, empty and long texts, ties, repeated rows, empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from floortally.llm import debruijn, decontamination, fingerprints, lm_scoring, mixing, near_dedup, sharding, suffix_dedup, tokens, toxicity
from floortally.llm.queries import MIX_WEIGHTS, mix_levels

VOCABULARY = [f"w{i}" for i in range(400)]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    base, passage = prose(1, 300), prose(2, 80)
    words = base.split()
    edited = [" ".join(words[:k] + [f"new{k}"] + words[k + 1 :]) for k in (20, 150, 290)]
    made = [(1, base), (2, base), *[(3 + k, t) for k, t in enumerate(edited)]]
    made += [(10 + k, f"{prose(50 + k, 60)} {passage}\n\n{prose(90 + k, 60)}") for k in range(3)]
    made += [(20, None), (21, ""), (22, " \n\t "), (23, "one two"), (23, "one two"), (None, prose(7, 40)), (24, "ab" * 400), (25, "é€𝄞 " * 90)]
    made += [(30, prose(8, 6000)), (31, "shorter"), (32, "<|endoftext|> a<|endoftext|>")]
    return made


def collected(frame_, key="doc_id"):
    return sorted((r.asDict() for r in frame_.collect()), key=lambda r: (r[key] is None, r[key] or 0, str(r)))


def test_suffix_dedup_equals_brute_force(frame, rows):
    length, counts = 200, Counter()
    data = [((i, (t or "").encode())) for i, t in rows]
    for _, b in data:
        counts.update(b[p : p + length] for p in range(len(b) - length + 1))
    expected = []
    for i, b in data:
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if counts[b[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        expected.append((str(i), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    found = suffix_dedup.without_repeats(frame(rows)).drop("kept").collect()
    assert sorted((str(r[0]), *r[1:]) for r in found) == sorted(expected)
    assert suffix_dedup.without_repeats(frame([])).count() == 0


def test_debruijn_equals_brute_force(frame, rows):
    length, first = 50, {}
    data = [(math.inf if i is None else i, i, WORD.findall(t or "")) for i, t in rows]
    for order, _, w in data:
        for p in range(len(w) - length + 1):
            k = tuple(w[p : p + length])
            first[k] = min(order, first.get(k, math.inf))
    expected = []
    for order, i, w in data:
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p : p + length])] < order:
                gone[p : p + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        expected.append((str(i), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    found = debruijn.without_repeats(frame(rows)).drop("kept").collect()
    assert sorted((str(r[0]), *r[1:]) for r in found) == sorted(expected)
    assert debruijn.without_repeats(frame([])).count() == 0


def jaccard(a, b):
    shingles = []
    for t in (a, b):
        w = re.sub(r"[!-/:-@\[-`{-~]", " ", t.lower()).split()
        n = min(5, len(w))
        shingles.append(Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w else Counter())
    x, y = shingles
    keys = set(x) | set(y)
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in keys) for i in keys if x[i] and y[i])


def test_near_classes_equal_brute_force(frame, rows):
    rows = [r for r in rows if r[0] != 30]
    texts = sorted({t or "" for _, t in rows})
    group = {t: t for t in texts}
    for a in texts:
        for b in texts:
            if a < b and jaccard(a, b) >= 0.8:
                old, new = group[a], group[b]
                group = {t: new if g == old else g for t, g in group.items()}
    last = near_dedup.LAST
    ids = {}
    for i, t in rows:
        ids.setdefault(group[t or ""], []).append(last if i is None else i)
    expected = sorted((last if i is None else i, min(ids[group[t or ""]])) for i, t in rows)
    found = near_dedup.near_classes(frame(rows)).select("doc", "near_class").collect()
    assert sorted(map(tuple, found)) == expected
    kept = near_dedup.without_near_duplicates(frame(rows))
    assert kept.columns == frame(rows).columns
    assert kept.count() == len(ids)
    assert near_dedup.near_classes(frame([])).count() == 0


def test_every_pair_of_a_large_bucket_counts(frame):
    """Variants of one template, most pairs just below the threshold: no main component holds them together."""
    template, made = prose(11, 300).split(), []
    for k in range(200):
        r, words = random.Random(1000 + k), list(template)
        for place in r.sample(range(300), 4 if k % 2 else 5):
            words[place] = f"v{k}x{place}"
        made.append((k, " ".join(words)))
    # Shingles repeat in no text here, so that similarity is the plain one.
    sets = [{tuple(t.split()[j : j + 5]) for j in range(296)} for _, t in made]
    group = list(range(len(made)))
    for a in range(len(made)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common >= 0.8 * (592 - common) and group[a] != group[b]:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    assert 40 < len(set(group)) < 190
    assert all(len(s) == 296 for s in sets)
    found = near_dedup.near_classes(frame(made)).select("doc", "near_class").collect()
    assert sorted(map(tuple, found)) == list(enumerate(group))


def test_signatures_estimate_probability_jaccard():
    r = np.random.default_rng(3)
    hashes = r.integers(1, 2**63, 300, dtype=np.uint64)
    weights = r.integers(1, 5, 300).astype(float)
    a, b = slice(0, 220), slice(60, 300)
    sides = [(hashes[s], weights[s]) for s in (a, b)]
    sides = [(h[np.argsort(h)], w[np.argsort(h)]) for h, w in sides]
    signed = [near_dedup.signatures(np.zeros(len(h), int), h, w, 1, 4096) for h, w in sides]
    exact = near_dedup.similarity(*sides)
    assert abs((signed[0] == signed[1]).mean() - exact) < 0.03
    assert near_dedup.similarity(sides[0], sides[0]) == pytest.approx(1)


def test_fingerprints(frame, rows):
    rows = [r for r in rows if r[0] is not None and r[0] != 23]
    found = {r["doc_id"]: r for r in fingerprints.fingerprints(frame(rows)).collect()}
    order = sorted(rows)
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        part = len(text) // 4
        edited = text[: len(text) - part] + following[:part]
        assert found[i]["n_chars"] == len(text)
        assert found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (found[i]["fingerprint"] == found[i]["edited_fingerprint"]) == (text == edited)
        assert 0 <= found[i]["near_edited"] <= 1 and 0 <= found[i]["near_next"] <= 1
    assert found[1]["fingerprint"] == found[2]["fingerprint"] != found[3]["fingerprint"]
    assert found[1]["near_next"] == 1.0
    assert fingerprints.fingerprints(frame([])).count() == 0
    assert fingerprints.fingerprints(frame([(None, "a"), (None, "b"), (5, "c")])).count() == 3


def test_token_counts_equal_the_tokenizer(frame, rows):
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        source = file.read()
    odd = [(100, "It's  we'll  x\x1c\x85y ́ 𝄞"), (101, "漢字かな 12345 ½ \r\n\r\n  end ")]
    own = tokens._tokenizer(source)
    expected = sorted((str(i), len((t or "").encode()), n := len(own.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in rows + odd)
    found = tokens.count_tokens(frame(rows + odd), source).collect()
    assert sorted((str(r[0]), *r[1:]) for r in found) == expected


def test_shards(frame, rows):
    many = rows + [(1000 + k, prose(k, 20 + k % 50)) for k in range(300)] + [(2000 + k, "the same copy of a text") for k in range(200)]
    found = collected(sharding.assign_shards(frame(many), 8))
    assert len(found) == len(many)
    sizes, slots = Counter(), {}
    by_id = {}
    for r in found:
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        by_id.setdefault(r["doc_id"], []).append((r["size"], r["text_crc32"]))
    for i, text in many:
        data = (text or "").encode()
        assert (len(data) + 1, zlib.crc32(data)) in by_id[i]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign_shards(frame([])).count() == 0


def test_mixing_spends_the_budgets(frame):
    rows = [(k, prose(k, 30 + k % 20)) for k in range(200)] + [(None, "a b c"), (500, None)]
    total = sum(len((t or "").split()) for _, t in rows)
    found = collected(mixing.mixed(frame(rows), mix_levels(), MIX_WEIGHTS, 0.5, 2))
    assert len(found) == len(rows)
    spent = sum(r["copies"] * r["n_tokens"] for r in found)
    assert 0.5 * total - 60 <= spent <= 0.5 * total  # one leaf: no more than a document under its budget
    twice = mixing.mixed(frame(rows), mix_levels(), MIX_WEIGHTS, 1.5, 2)
    assert {r["copies"] for r in twice.collect()} <= {1, 2}
    assert mixing.mixture(frame(rows), mix_levels(), MIX_WEIGHTS, 0.5, 2).columns == frame(rows).columns
    assert mixing.mixed(frame([]), mix_levels(), MIX_WEIGHTS, 0.5).count() == 0


def test_budget_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 100), ("b", "z", 100)], "d string, s string, capacity long")
    dealt = {r["s"]: r["budget"] for r in mixing.budgets(leaves, ["d", "s"], {}, 100).collect()}
    assert dealt == {"x": 10, "y": 40, "z": 50}


def test_leaks_of_reordered_passages(spark, frame):
    item = prose(5, 40).split()
    moved = " ".join(item[20:] + ["gap"] + item[:20]).upper()
    rows = [(1, f"{prose(6, 50)} {moved}, {prose(9, 50)}"), (2, prose(11, 200)), (3, None), (4, ""), (None, " ".join(item)), (5, " ".join(item[:10]))]
    items = spark.createDataFrame([(7, " ".join(item)), (8, None), (9, "")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in decontamination.leaks(frame(rows), items).collect()}
    assert set(found) == {(1, 7), (None, 7)}
    assert found[1, 7]["coverage"] == 1.0 and found[1, 7]["n_tiles"] == 2
    assert sorted(r["doc_id"] for r in decontamination.without_leaks(frame(rows), items).collect()) == [2, 3, 4, 5]
    assert decontamination.leaks(frame(rows), items.limit(0)).count() == 0


def brute_leaks(rows, items, seed_words=5, least_match=5, threshold=0.5):
    """Greedy tiles word by word: the longest common run of unmarked words, the first in the item, then in the text."""
    plain = lambda t: re.sub(r"[!-/:-@\[-`{-~]", " ", t or "").lower().split()
    found = []
    for doc_id, text in rows:
        words = plain(text)
        for item_id, item in items:
            item, covered = plain(item), 0
            least = min(least_match, len(item))
            free, own = [True] * len(words), [True] * len(item)
            while item:
                best = (0, 0, 0)
                for j in range(len(item)):
                    for i in range(len(words)):
                        n = 0
                        while i + n < len(words) and j + n < len(item) and words[i + n] == item[j + n] and free[i + n] and own[j + n]:
                            n += 1
                        if n > best[0]:
                            best = (n, i, j)
                n, i, j = best
                if n < least:
                    break
                free[i : i + n], own[j : j + n] = [False] * n, [False] * n
                covered += n
            if item and covered / len(item) >= threshold:
                found.append((doc_id, item_id, round(covered / len(item), 9)))
    return sorted(found, key=str)


def test_leaks_equal_brute_force(spark, frame, monkeypatch):
    r = random.Random(8)
    items = [(k, prose(300 + k, 12 + k)) for k in range(8)] + [(50, prose(300, 12)), (51, "one two"), (None, prose(301, 13)), (52, None), (53, " ")]
    rows = []
    for k in range(60):
        words = prose(700 + k, 30).split()
        for _ in range(r.randrange(3)):
            source = (items[r.randrange(8)][1]).split()
            a = r.randrange(len(source))
            b = min(len(source), a + r.randrange(3, 14))
            at = r.randrange(len(words))
            words[at:at] = [w.upper() + "," for w in source[a:b]]
        rows.append((k, " ".join(words)))
    rows += [(100, "x one two y"), (None, items[3][1]), (101, None), (101, ""), (102, items[2][1]), (102, items[2][1])]
    expected = brute_leaks(rows, items)
    assert len(expected) > 10
    table = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, item_key string")
    for block in (decontamination.BYTES_PER_BLOCK, 300):
        monkeypatch.setattr(decontamination, "BYTES_PER_BLOCK", block)
        found = decontamination.leaks(frame(rows), table).collect()
        assert sorted(((x.doc_id, x.item_id, round(x.coverage, 9)) for x in found), key=str) == expected
    kept = decontamination.without_leaks(frame(rows), table)
    assert kept.columns == frame(rows).columns
    leaked = {e[0] for e in expected}
    assert sorted(x.doc_id for x in kept.collect() if x.doc_id is not None) == sorted(i for i, _ in rows if i not in leaked and i is not None)


def test_base_scores_equal_brute_force(frame, rows):
    rows = [r for r in rows if r[0] is not None]
    lists = [(i, WORD.findall((t or "").lower() if (t or "").isascii() else (t or "")) + [None]) for i, t in rows]
    out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, ws in lists if not out(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    expected = sorted((i, out(i), len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in lists)
    found = lm_scoring.scores(frame(rows)).collect()
    assert sorted((r[0], r[1], r[2], r[3], r[4], round(r[5], 6)) for r in found) == expected
    assert all(r["score"] < 0 for r in found)
    assert lm_scoring.scores(frame([])).count() == 0


def test_class_probabilities_sum_to_one():
    r = np.random.default_rng(0)
    weights = r.normal(size=(lm_scoring.N_FEATURES, lm_scoring.CLASSES))
    found = np.exp(lm_scoring.log_probabilities(weights, np.arange(500)))
    assert np.allclose(found.sum(axis=1), 1)


def test_scores_see_the_words_before_and_not_only_their_classes(frame):
    # Both first words end alike, so they are of one class; so are both words that may come between.
    said = ["aaab mmxy cccq", "zzab mmxy dddv", "kkgh mmxy cccq", "kkgh nnxy dddv", "cccq llop sss", "dddv llop sss"]
    rows = [(i, said[i % len(said)]) for i in range(6000)]
    asked = ["aaab mmxy cccq", "aaab mmxy dddv", "kkgh mmxy cccq", "kkgh nnxy cccq"]
    held = [i for i in range(10**6, 10**6 + 100) if zlib.crc32(str(i).encode()) % 7 == 2][: len(asked)]
    found = {r.doc_id: r.score for r in lm_scoring.scores(frame(rows + list(zip(held, asked)))).collect()}
    skip, skip_wrong, near, near_wrong = (found[i] for i in held)
    assert skip > skip_wrong + 0.3 and near > near_wrong + 0.3


def test_feature_sums_equal_brute_force(monkeypatch):
    r = np.random.default_rng(1)
    texts = [" ".join(r.choice(["ab", "cab", "xy", "zxy", "q"], n)) for n in (0, 1, 2, 3, 40, 900)]
    class_of = np.arange(lm_scoring.ENDINGS) % lm_scoring.CLASSES
    scores = r.normal(size=((lm_scoring.CLASSES + 1) ** 2, lm_scoring.CLASSES)).astype(np.float32)
    scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
    bits = 4  # with collisions
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    tokens = lm_scoring.tokens_of(data, np.cumsum([0, *map(len, texts)]))
    classes, contexts = lm_scoring.contexts_of(tokens, class_of)
    features = lm_scoring.word_features(tokens, bits)
    expected = np.zeros((3 << bits, 2, lm_scoring.CLASSES))
    for cls, context, rows in zip(classes, contexts, features):
        for row in rows:
            expected[row, 0, cls] += 1
            expected[row, 1] += np.exp(scores[context])
    shared = type("Shared", (), {"value": (class_of, np.exp(scores), bits)})
    for held in (lm_scoring.CELLS_HELD, 10):
        monkeypatch.setattr(lm_scoring, "CELLS_HELD", held)
        monkeypatch.setattr(lm_scoring, "BLOCK", min(held, 4096))
        got = np.zeros_like(expected)
        for part in lm_scoring._feature_sums(shared)([batch]):
            for feature, sums in zip(*(part.column(c).to_pylist() for c in ("feature", "sums"))):
                got[feature] += np.frombuffer(sums, np.float32).reshape(2, -1)
        assert np.allclose(got, expected, rtol=1e-4)
    words = r.normal(size=(3 << bits, lm_scoring.CLASSES)).astype(np.float32)
    logs = np.concatenate([x for _, x in lm_scoring.class_scores(scores, words, contexts, features)])
    plain = scores[contexts] + words[features].sum(axis=1)
    assert np.allclose(logs, plain - np.log(np.exp(plain).sum(axis=1, keepdims=True)), atol=1e-4)
    # Words of one class are apart as features, and no feature looks over the beginning of its text.
    assert len(np.unique(features[classes == classes[0]], axis=0)) > 1 and all((features[b] == features[0]).all() for b in tokens.begins[:-1])


def test_toxicity_learns_and_gradients_are_right(spark, frame):
    r = random.Random(0)
    rows = [(k, " ".join(r.choice(VOCABULARY) for _ in range(60))) for k in range(480)]
    rows = [(k, t.replace(" ", f" nasty{k % 3} ", 3) if k % 4 == 0 else t) for k, t in rows] + [(900, None), (901, ""), (None, "x")]
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(480)], "doc_id long, toxic int")
    model = toxicity.fit(frame(rows), labels)
    found = {r["doc_id"]: r for r in toxicity.scored(frame(rows), model).collect()}
    assert len(found) == len(rows)
    held = [k for k in range(480) if zlib.crc32(str(k).encode()) % 4 == 2]
    assert all(found[k]["held_out"] for k in held)
    assert np.mean([found[k]["predicted"] == (k % 4 == 0) for k in held]) >= 0.9
    assert all(0 <= r["score"] <= 1 for r in found.values())

    words = toxicity.inputs_of(*toxicity.joined_texts([rows[0][1]]))
    p = {k: v.astype(np.float64) for k, v in model.weights.items()}
    starts, text = toxicity.windows_of(words.begins)
    at = starts[None, :] + np.arange(toxicity.WINDOW)[:, None]
    mask = (at < words.begins[text + 1][None, :]).astype(float)
    at, x, y = np.minimum(at, len(words.word) - 1), toxicity.vectors(p, words), np.array([1.0, 0, 1])[: len(starts)]
    loss = lambda: float(np.mean(np.logaddexp(0, toxicity.forward(p, x, at, mask)) - y * toxicity.forward(p, x, at, mask)))
    g, _ = toxicity.gradients(p, x, at, mask, y)
    for name in ("xf", "hb", "attend", "out", "cf"):
        place = np.unravel_index(np.argmax(np.abs(g[name])), g[name].shape)
        p[name][place] += 1e-4
        up = loss()
        p[name][place] -= 2e-4
        down = loss()
        p[name][place] += 1e-4
        assert (up - down) / 2e-4 == pytest.approx(g[name][place], rel=2e-2, abs=1e-5), name


def test_toxicity_reads_a_window_from_every_word():
    p = toxicity.initial(np.random.default_rng(5))
    model = toxicity.Model({k: v * 4 if k in ("words", "chars") else v for k, v in p.items()}, np.ones(3))
    highest = lambda t: model.features(toxicity.inputs_of(*toxicity.joined_texts([t])))[0, 1]
    passage = max((prose(k, toxicity.WINDOW) for k in range(200)), key=highest)
    for before in range(60):
        assert highest(f"{prose(900, before)} {passage} {prose(901, 40)}") >= highest(passage) - 1e-4


def test_components_equal_union_find(spark):
    shuffled = random.Random(1)
    links = [(i, i + 1) for i in range(100, 130)] + [(500, i) for i in range(501, 560)] + [(7, 7)]
    links += [(shuffled.randrange(200, 260), shuffled.randrange(200, 260)) for _ in range(40)]
    groups = {n: {n} for link in links for n in link}
    for a, b in links:
        joint = groups[a] | groups[b]
        groups.update(dict.fromkeys(joint, joint))
    found = {}
    for row in near_dedup.components(spark.createDataFrame(links, "left long, right long")).collect():
        found.setdefault(row.component, set()).add(row.node)
    assert all(component in nodes for component, nodes in found.items())
    assert sorted(map(sorted, found.values())) == sorted(map(list, {tuple(sorted(g)) for g in groups.values() if len(g) > 1}))


def test_toxicity_windows_side_by_side_equal_single_ones():
    p = toxicity.initial(np.random.default_rng(6))
    p["words"] *= 20
    texts = [prose(k, n) for k, n in enumerate((3, 24, 25, 90, 0, 1, 400))] + ["", None]
    words = toxicity.inputs_of(*toxicity.joined_texts(texts))
    starts, text = toxicity.windows_of(words.begins, 1)
    at = starts[None, :] + np.arange(toxicity.WINDOW)[:, None]
    ends = words.begins[text + 1][None, :]
    single = toxicity.forward(p, toxicity.vectors(p, words), np.minimum(at, ends - 1), (at < ends).astype(np.float32))
    assert np.ptp(single) > 0.1
    assert np.allclose(toxicity.window_logits(p, words, starts, text), single, atol=1e-4)


def test_one_document_of_a_class_stays_whatever_its_ids(spark):
    words = prose(31, 200).split()
    variants = [" ".join(words[:k] + ["other"] + words[k + 1 :]) for k in (30, 90, 150)]
    schema = "doc_id long, text string, doc long, node string, row int, _kept_doc int"
    for ids in ((1, 2, 3), (None, None, None), (7, 7, 7), (None, 5, 5)):
        rows = [(i, t, 1, "n", 2, 3) for i, t in zip(ids, variants)] + [(None, None, 1, "n", 2, 3), (None, "", 1, "n", 2, 3), (8, prose(32, 60), 1, "n", 2, 3)]
        kept = near_dedup.without_near_duplicates(spark.createDataFrame(rows, schema))
        assert kept.columns == ["doc_id", "text", "doc", "node", "row", "_kept_doc"]
        found = kept.collect()
        assert len(found) == 3 and sum(r.text in variants for r in found) == 1
        first = min(i for i in ids if i is not None) if any(ids) else None
        assert next(r.doc_id for r in found if r.text in variants) == first


def test_mixing_does_not_depend_on_partitions(spark):
    rows = [(k % 100, prose(k, 20 + k % 9), "en", f"s{k % 3}") for k in range(400)] + [(None, prose(k, 15), "de", "s1") for k in range(500, 560)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    read = lambda n: sorted(map(tuple, mixing.mixed(docs.repartition(n), mix_levels(), MIX_WEIGHTS, 0.4, 2).collect()), key=str)
    first = read(1)
    assert read(7) == first and read(13) == first
    assert len(first) == len(rows) and 0 < sum(r[-2] for r in first) < len(rows)


def test_mixing_with_weights_of_zero_and_clashing_names(spark):
    rows = [(k, prose(k, 30), "en", f"s{k % 3}", 1, 2, "r") for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _copy int, _text int, row string")
    weights = {**MIX_WEIGHTS, "source": {"s0": 0.0}}
    found = mixing.mixed(docs, mix_levels(), weights, 0.9, 1).collect()
    assert {r.source: r.budget for r in found} == {"s0": 0, "s1": 900, "s2": 900}  # all that is left, under the target
    assert sum(r.copies for r in found if r.source == "s0") == 0
    taken = mixing.mixture(docs, mix_levels(), weights, 0.9, 1)
    assert taken.columns == docs.columns and taken.count() == 60
    assert {tuple(r)[4:] for r in taken.collect()} == {(1, 2, "r")}
    nothing = mixing.mixed(docs, mix_levels(), {"source": {f"s{k}": 0.0 for k in range(3)}}, 0.9, 1)
    assert {r.budget for r in nothing.collect()} == {0}


def test_mixing_equals_brute_force(spark):
    """Budgets by raising one rate per parent until it is spent; prefixes of each leaf by the seeded order."""
    rows = [(k, prose(k, 5 + k % 40), ("en", "de", "fr", "es", None)[k % 5], f"s{k % 4}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = mixing.mixed(docs, mix_levels(), MIX_WEIGHTS, 0.7, 2).collect()
    tokens = Counter()
    for r in found:
        tokens[r.domain, r.lang, r.source] += r.n_tokens

    def dealt(budget, level, leaves):
        if level == 3:
            return {leaf: budget for leaf in leaves}
        children = {}
        for leaf in leaves:
            children.setdefault(leaf[level], []).append(leaf)
        room = {c: 2 * sum(tokens[x] for x in own) for c, own in children.items()}
        weight = {c: MIX_WEIGHTS[("domain", "lang", "source")[level]].get(c, 1.0) for c in children}
        low, high = 0.0, 1e9
        for _ in range(200):
            rate = (low + high) / 2
            low, high = (rate, high) if sum(min(room[c], rate * weight[c]) for c in children) < budget else (low, rate)
        shares = {}
        for c, own in children.items():
            shares |= dealt(min(room[c], high * weight[c]), level + 1, own)
        return shares

    budgets = dealt(0.7 * sum(tokens.values()), 0, list(tokens))
    assert all(abs(r.budget - budgets[r.domain, r.lang, r.source]) <= 1 for r in found)
    for leaf in tokens:
        own = [r for r in found if (r.domain, r.lang, r.source) == leaf]
        whole, left = divmod(own[0].budget, tokens[leaf])
        place = lambda r: (int(hashlib.md5(f"42:{whole}:{r.doc_id}:{r.text_hash}".encode()).hexdigest()[:7], 16), r.doc_id)  # noqa: B023, E731
        for r in sorted(own, key=place):
            left -= r.n_tokens
            assert r.copies == whole + (left >= 0)
