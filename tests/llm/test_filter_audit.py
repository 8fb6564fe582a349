"""Filter orders from decision diagrams against filters applied one after the other."""

import itertools
import random
import re
from collections import Counter

import duckdb
import pytest

from floortally.llm import filter_audit as A
from floortally.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_each_order_comes_up_once_one_swap_apart():
    for n in range(1, 6):
        order = list(range(n))
        seen = [tuple(order)]
        for level in A.adjacent_swaps(n):
            order[level], order[level + 1] = order[level + 1], order[level]
            seen.append(tuple(order))
        assert sorted(seen) == sorted(itertools.permutations(range(n)))


def test_swaps_keep_the_function_and_reduce_the_diagram():
    r = random.Random(3)
    for distinct in (2, 40):
        counts = {m: (r.randrange(distinct), 0, 0) for m in r.sample(range(32), 20)}
        diagram = A.Diagram(counts, "ABCDE")
        for level in [None, *A.adjacent_swaps(5)]:
            if level is not None:
                diagram.swap(level)
            fresh = A.Diagram({sum(1 << i for i, f in enumerate(diagram.order) if m >> "ABCDE".index(f) & 1): c for m, c in counts.items()}, "ABCDE")
            assert [len(x) for x in diagram.levels] == [len(x) for x in fresh.levels]
            assert [s[1:] for s in diagram.steps()] == [s[1:] for s in fresh.steps()]
            assert len(diagram.children) == sum(map(len, diagram.levels))


def brute(rows, quality, toxic):
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    fails = []
    for i, text, source in rows:
        text = text or ""
        words = WORD.findall(text)
        failing = {"A"} if len(words) < 50 else set()
        failing |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
        failing |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else set()
        failing |= {"D"} if set(text) & set("#$%&*|") else set()
        failing |= {"E"} if i is not None and least[text] < i else set()
        fails.append((source or "", failing, i in quality, i in toxic))
    result = []
    for part in {f[0] for f in fails}:
        own, walks = [f for f in fails if f[0] == part], []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                out = [f for f in left if name in f[1]]
                left = [f for f in left if name not in f[1]]
                redundant = sum(name in f[1] for f in own) - len(out)
                walks.append([part, "".join(order), step, len(left), len(out), redundant, sum(f[1] == {name} for f in own), sum(f[2] for f in out), sum(f[3] for f in out)])
        shares = Counter()
        for w in walks:
            shares[w[1][w[2] - 1]] += w[4]
        result += [(*w, shares[w[1][w[2] - 1]]) for w in walks]
    return sorted(result)


@pytest.fixture
def tables(spark, tmp_path):
    r = random.Random(7)
    texts = [" ".join(r.choice(["one", "Two", "THREE", "4", "five$", "six", "a", "é"]) + str(r.randrange(k)) for _ in range(n)) for k, n in [(2, 60), (90, 70), (90, 20), (300, 55), (5, 10), (1000, 49), (1000, 50)] for _ in range(3)]
    texts += [None, "", " \n", "Ab" * 20, "plain " * 50, "é" * 100 + " A"]
    rows = [(r.randrange(150), r.choice(texts), r.choice(["s1", "s2", "", None])) for _ in range(300)]
    rows += [(None, t, "s3") for t in texts] + [rows[0], rows[0], (-5, rows[0][1], "s3"), (400, " ".join(f"w{i}" for i in range(20000)), "s1")]
    made = [(i, t, s, "x", 1, 7) for i, t, s in rows]
    spark.createDataFrame(made, "doc_id long, text string, source string, part string, mask int, n int").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, r.randrange(2), r.randrange(2)) for i in range(0, 140, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (6, None, None), (9999, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    quality, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    return str(tmp_path), brute(rows, quality, toxic)


def test_query_equals_brute_force_and_sql(spark, tables):
    folder, expected = tables
    found = queries.op13_filter_audit(spark, folder)
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, found.collect())) == expected
    connection = duckdb.connect()
    for name in ("documents", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    assert sorted(connection.execute(queries.ORACLES["op13_filter_audit"]).fetchall()) == expected


def test_empty_tables(spark, tables):
    documents, labels = (spark.read.parquet(f"{tables[0]}/{n}.parquet") for n in ("documents", "labels"))
    assert A.filter_audit(documents.limit(0), labels).count() == 0
    assert {(r.good_lost, r.toxic_lost) for r in A.filter_audit(documents, labels.limit(0)).collect()} == {(0, 0)}
