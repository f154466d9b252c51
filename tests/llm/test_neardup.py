"""Near-duplicates against all pairs compared in plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rankloom.llm import graph, neardup, queries


def shingles(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(ws) < 5:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)}


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x_, y_ = sorted((root(i), root(j)))
                parent[y_] = x_
    return {i: (len(sets[i]), root(i)) for i in ids}


def check(rows, got):
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_query(spark, sf, documents):
    got = queries.op2_neardup(spark, sf).collect()
    check([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()], got)


def test_groups_of_edited_copies(spark):
    """Copies, chains of edits and documents that share a passage with unlike ones."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(5000)]
    passage = rng.choices(words, k=12)
    rows = []
    for base in range(6):
        text = rng.choices(words, k=rng.choice([30, 80, 200]))
        for copy in range(40):
            edited = list(text)
            for _ in range(rng.choice([0, 1, 2, 4])):
                edited[rng.randrange(len(edited))] = rng.choice(words)
            rows.append(edited)
    rows += [passage + rng.choices(words, k=12) for _ in range(60)]
    rng.shuffle(rows)
    docs = [(i, " ".join(ws)) for i, ws in enumerate(rows)]
    got = neardup.link_documents(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    check(docs, got)


@pytest.mark.parametrize("block", [500, 40])
def test_lone_links_in_a_crowd(spark, monkeypatch, block):
    """Hundreds of copies that are each near to the original alone, and some near to a single copy."""
    monkeypatch.setattr(neardup, "BLOCK_NODES", block)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    texts = [base]
    for i in range(300):
        own = list(base)
        own[2 + (7 * i) % 56] = f"x{i}"
        texts.append(own)
    for i in range(0, 300, 10):  # a second edit, next to the first one or not
        own = list(texts[1 + i])
        own[(2 + (7 * i) % 56 + rng.choice([1, 1, 25])) % 60] = f"y{i}"
        texts.append(own)
    rng.shuffle(texts)
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    check(docs, neardup.link_documents(spark.createDataFrame(docs, "doc_id bigint, text string")).collect())


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(3, None, 1), (1, "", 1), (2, "a b", 1), (5, "A  B", 1), (9, "b a", 1), (7, "x " * 50000, 1), (8, "x x x x x x", 1),
         (None, "a b", 1), (4, " \t\n", None)], "doc_id bigint, text string, n_shingles int")
    got = {r.doc_id: r for r in neardup.link_documents(docs).collect()}
    assert {i: r.component_id for i, r in got.items()} == {
        3: 3, 1: 1, 2: 2, 5: 2, 9: 9, 7: 7, 8: 7, None: 2, 4: 4}
    assert got[3].n_shingles == got[1].n_shingles == got[4].n_shingles == 0 and got[7].n_shingles == 1
    assert not got[None].kept
    assert neardup.link_documents(docs.limit(0)).collect() == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 400), (400, 500), (7, 7)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 400: 400, 500: 400}
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert graph.components(none).count() == 0
