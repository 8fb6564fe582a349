"""Runs by block convolution against brute force over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from floortally.llm import periodic_runs as P
from floortally.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(x):
    n, found = len(x), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)  # a smaller period of the same stretch came first
            i = j + 1
    return sorted(((a, b, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.fixture(scope="module")
def sequences():
    r, made = random.Random(1), []
    for _ in range(200):
        n, k = r.randrange(0, 400), r.choice([1, 2, 3, 5, 50])
        x = [r.randrange(k) for _ in range(n)]
        for _ in range(r.randrange(3)):
            if n > 60:
                a = r.randrange(n - 50)
                p, b = 1 + r.randrange((n - a) // 3), min(n, a + r.randrange(24, 300))
                x[a:b] = [x[a + (i - a) % p] for i in range(a, b)]
        made.append(x)
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    return [*made, b, [0] * 700, ([0] * 4 + [1]) * 60 + ([0] * 4 + [1, 2]) * 30 + [0] * 50]


def test_runs_equal_brute_force(sequences):
    expected = [brute_runs(x) for x in sequences]
    assert P.runs_of([np.array(x, np.int64) for x in sequences]) == expected
    assert sum(map(len, expected)) > 150 and max(q for runs in expected for *_, q in runs) > 60


def test_blocks_longer_than_a_pattern(sequences, monkeypatch):
    monkeypatch.setattr(P, "LONGEST_PATTERN", 16)
    assert P.runs_of([np.array(x, np.int64) for x in sequences]) == [brute_runs(x) for x in sequences]


@pytest.mark.parametrize("size", [16, 32, 64, 2048, 65536])
def test_transform_is_exact(size):
    r = np.random.default_rng(size)
    t = P.transform(size)
    x = r.integers(0, P.PRIME, (2, size))
    assert (t.inverse(t.forward(x.astype(float))) % P.PRIME == x).all()
    if size <= 64:
        y = r.integers(0, P.PRIME, size)
        spectrum = P.reduced(t.forward(x[:1].astype(float))[:, t.opposite] * t.forward(y[None].astype(float)))
        lags = [int(sum(int(x[0, j]) * int(y[(j + d) % size]) for j in range(size)) % P.PRIME) for d in range(size)]
        assert (t.inverse(spectrum)[0] % P.PRIME).tolist() == lags


def test_equal_codes_of_different_words_are_no_run():
    # Past 65537 distinct words codes repeat: the zero of the convolution is not believed but compared.
    x = np.concatenate([np.arange(65537), np.arange(65537, 65537 + 30)])
    x[:30], x[30:60], x[60:90] = np.arange(30), np.arange(65537, 65567), np.arange(30)
    assert P.runs_of([x]) == [[]]


def expected_row(doc_id, text):
    words = WORD.findall(text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for a, b, q in runs for i in range(a + q, b)}
    collapsed = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs)
    best = (None,) * 4
    if runs:
        a, b, q = min(runs, key=lambda r: (-(r[1] - r[0]) * 10**9 // r[2], r[0], r[2]))
        best = (a, b - a, q, 1000 * (b - a) // q)
    return doc_id, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed.encode()).hexdigest()


def test_query_equals_brute_force(spark, frame, tmp_path):
    r = random.Random(4)
    prose = lambda k, n: " ".join(f"w{r.randrange(k)}" for _ in range(n))
    rows = [(i, prose(r.choice([3, 40]), r.randrange(0, 160))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (None, "a b " * 40), (None, None), (203, "x\x0by\x1cz  " * 30), (204, "é€𝄞 ja\r\n" * 25)]
    rows += [(205, "same words here " * 20), (205, "same words here " * 20), (206, prose(2000, 3000) + " " + "a b c " * 400)]
    frame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op12_periodic_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    order = lambda row: str(row)
    assert sorted(map(tuple, found.collect()), key=order) == sorted((expected_row(*row) for row in rows), key=order)
    assert P.periodic_runs(frame([])).count() == 0
