"""Periodic runs against all periods tried one by one."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from rankloom.llm import periodic, queries


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(ws, least=24):
    """Every stretch with smallest period q that keeps it for max(least, 3q) words and no longer."""
    n, out = len(ws), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and ws[j] == ws[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 3 * q):
                stretch = ws[i:i + length]
                if not any(all(stretch[k] == stretch[k + p] for k in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def rewritten(doc_id, ws):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(ws)
    if h % 10 or not n:
        return ws
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return ws[:a] + [ws[a + (i - a) % p] for i in range(a, n)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    ws = rewritten(doc_id, words(text))
    runs = brute(ws)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            digest(" ".join(w for i, w in enumerate(ws) if i not in dropped)))


def test_query(spark, sf, documents):
    rows = [tuple(r) for r in queries.op12_periodic(spark, sf).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()]
    assert sorted(rows) == sorted(expected(r.doc_id, r.text) for r in documents.collect())
    assert sum(r[1] for r in rows) > 10


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_tangled_texts(seed):
    rng = random.Random(seed)
    for _ in range(60):
        ws = []
        while len(ws) < rng.randrange(1, 260):
            root = [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.choice([1, 2, 3, 5, 9, 14]))]
            ws += (root * rng.randrange(1, 40))[:rng.randrange(1, 90)]
        if rng.random() < 0.5:
            ws[rng.randrange(len(ws))] = 99
        codes = np.array(ws)
        assert periodic.text_runs(codes) == brute(ws)
        assert periodic.runs_of([w + 1 for w in ws], 6) == brute(ws, 6) == periodic.text_runs(codes, 6)


def test_extensions_of_a_tree():
    rng = random.Random(5)
    codes = [rng.randrange(1, 4) for _ in range(120)]
    leaves, between = periodic.SuffixTree(codes, 4).tour()
    assert leaves.tolist() == sorted(range(121), key=lambda i: codes[i:] + [0])
    ahead = periodic.Extensions(leaves, between)
    for _ in range(300):
        a, b = rng.sample(range(121), 2)
        n = 0
        while max(a, b) + n < 120 and codes[a + n] == codes[b + n]:
            n += 1
        assert ahead.lce(np.array([a]), np.array([b]))[0] == n
    turned = periodic.SuffixTree(codes, 4).tour(falling=True)[0]
    assert turned.tolist() == sorted(range(121), key=lambda i: [-c for c in codes[i:]] + [-9])


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (3, "a " * 24, 1), (3, "a " * 24, 1), (4, "a " * 23, 1), (None, "x y " * 40_000, 1), (5, " \t\n ", None),
         (6, "A a " * 12, 2), (7, "q " + "a b c d e f g h i j " * 3 + "z", 0)], "doc_id bigint, text string, runs int")
    rows = periodic.find_runs(docs).collect()
    found = {(r.doc_id, len(r.text or "")): ([tuple(x) for x in r.runs], r.collapsed.decode()) for r in rows}
    assert len(rows) == 9
    assert found[(1, 0)] == found[(2, 0)] == found[(5, 4)] == ([], "")
    assert found[(3, 48)] == ([(0, 24, 1)], "a") and found[(4, 46)] == ([], " ".join("a" * 23))
    assert found[(None, 160_000)] == ([(0, 80_000, 2)], "x y")
    assert found[(6, 48)] == ([(0, 24, 2)], "A a")
    assert found[(7, 63)] == ([(1, 30, 10)], "q a b c d e f g h i j z")
    assert periodic.find_runs(docs.limit(0)).collect() == []
