"""The corpus pipeline, each stage held on its own input against a plain form of what it decides."""

import random
import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from floortally.llm import toxicity
from floortally.llm.queries import MIX_EPOCHS, MIX_PART

WORDS = [f"w{i}" for i in range(300)]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root, r = str(tmp_path_factory.mktemp("corpus")), random.Random(3)
    items = [(k, prose(900 + k, 30)) for k in range(4)]
    rows = []
    for k in range(240):
        text = prose(k, 60)
        if k % 5 == 0:
            text = text.replace(" ", f" vile{k % 3} nasty{k % 2} ", 3)
        rows.append((k, text))
    for k in range(240, 270):  # near copies of the first clean documents
        words = rows[k - 239][1].split()
        words[k % 50] = "changed"
        rows.append((k, " ".join(words)))
    rows += [(270 + k, f"{prose(400 + k, 30)} {items[k % 4][1].upper()}. {prose(500 + k, 20)}") for k in range(12)]
    rows += [(300, None), (301, ""), (None, prose(600, 40)), (None, prose(601, 40)), (302, prose(602, 30)), (302, prose(602, 30)), (303, prose(603, 5000))]
    made = [(i, t, r.choice(["en", "de", "fr", "es", None]), f"src{r.randrange(4)}", len(t or "")) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(made, schema).repartition(3).write.parquet(f"{root}/documents.parquet")
    labels = [(k, r.randrange(2), int(k % 5 == 0)) for k in range(240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def told(frame):
    return Counter(map(tuple, frame.collect()))


def plain(text):
    return re.sub(r"[!-/:-@\[-`{-~]", " ", text or "").lower().split()


def near(a, b):
    x, y = ({tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))} if t else {()} for t in (plain(a), plain(b)))
    return x == y if () in (x | y) else len(x & y) >= 0.8 * len(x | y)


def test_each_stage_decides_as_its_plain_form(spark, folder):
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    docs, stages = read("documents"), dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    columns, kept = docs.columns, {}
    for name in list(stages)[:-1]:
        after = stages[name](spark, docs, folder)
        assert after.columns == columns
        after.write.parquet(f"{folder}/after_{name}")
        kept[name] = (docs, spark.read.parquet(f"{folder}/after_{name}"))
        docs = kept[name][1]

    before, after = kept["toxicity"]
    model = toxicity.fit(before, read("labels"))
    bad = {(r.doc_id, r.text_hash) for r in toxicity.scored(before, model).where("predicted = 1").collect()}
    hashed = before.selectExpr("doc_id", "xxhash64(text) h", "*").collect()
    assert told(after) == Counter(tuple(r)[2:] for r in hashed if (r[0], r.h) not in bad)
    held = [k for k in range(240) if zlib.crc32(str(k).encode()) % 4 == 2]
    left = {r.doc_id for r in after.collect()}
    assert sum((k % 5 == 0) != (k not in left) for k in held) <= 2

    before, after = kept["near_dedup"]
    rows = [tuple(r) for r in before.collect()]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if group[i] != group[j] and near(rows[i][1], rows[j][1]):
                group = [group[j] if g == group[i] else g for g in group]
    classes = {}
    for g, row in zip(group, rows):
        classes.setdefault(g, []).append(row)
    found = [tuple(r) for r in after.collect()]
    assert len(found) == len(classes) < len(rows)
    for own in classes.values():
        (one,) = [r for r in found if r in own][:1]
        assert one[0] == min((r[0] for r in own if r[0] is not None), default=None)

    before, after = kept["decontamination"]
    items = [plain(r.text) for r in read("benchmark").collect()]
    leaked = lambda t: any(" ".join(i) in " ".join(plain(t)) for i in items)
    assert told(after) == Counter(tuple(r) for r in before.collect() if not leaked(r.text))
    assert told(after) != told(before)

    before, after = kept["mixing"]
    n_tokens = lambda t: len((t or "").split())
    taken, given = told(after), told(before)
    assert taken.keys() <= given.keys() and all(n <= MIX_EPOCHS * given[row] for row, n in taken.items())
    whole = sum(n_tokens(row[1]) * n for row, n in given.items())
    spent = sum(n_tokens(row[1]) * n for row, n in taken.items())
    assert 0.5 * MIX_PART * whole < spent <= MIX_PART * whole

    shards = stages["sharding"](spark, docs, folder).collect()
    sizes = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in shards) == Counter(
        (r.doc_id, sizes(r.text), zlib.crc32((r.text or "").encode())) for r in docs.collect()
    )
    slots = {}
    for r in shards:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))
    # The whole run makes the same decisions.
    assert Counter(map(tuple, corpus_pipeline.run(spark, folder).collect())) == Counter(map(tuple, shards))


def test_shards_are_near_equal_and_keep_equal_texts(spark):
    from floortally.llm import sharding

    rows = [(k, prose(k % 2000, 20 + k % 50)) for k in range(4000)] + [(None, None), (5, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharding.assign_shards(frame, 2).collect()
    bytes_of, shards_of = Counter(), {}
    for r in found:
        bytes_of[r.shard] += r.size
        shards_of.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    mean = sum(bytes_of.values()) / 2
    assert len(bytes_of) == 2 and max(abs(b - mean) for b in bytes_of.values()) <= mean / 100
    assert all(len(s) == 1 for s in shards_of.values())
