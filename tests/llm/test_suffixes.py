"""Repeated passages against all windows counted in plain Python."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from rankloom.llm import queries, suffixes


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(rows, size):
    """{(row, id): sorted words covered} by windows that another row has too."""
    seen = defaultdict(set)
    for i, (_, t) in enumerate(rows):
        ws = words(t)
        for k in range(len(ws) - size + 1):
            seen[tuple(ws[k:k + size])].add(i)
    out = {}
    for i, (doc, t) in enumerate(rows):
        ws, covered = words(t), set()
        for k in range(len(ws) - size + 1):
            if len(seen[tuple(ws[k:k + size])]) > 1:
                covered.update(range(k, k + size))
        if covered:
            out[doc] = covered
    return out


def covered(got):
    out = defaultdict(set)
    for r in got:
        assert r.n_words == r.end - r.start
        out[r.doc_id].update(range(r.start, r.end))
    return dict(out)


def test_query(spark, sf, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert covered(queries.op8_suffixes(spark, sf).collect()) == brute(rows, suffixes.MIN_WORDS)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_edited_copies_and_common_lines(spark, monkeypatch, seed):
    if seed % 2:  # ends of ranges in two levels, and rows of a key dealt over tasks
        monkeypatch.setattr(suffixes, "SORTED_ROWS", 40)
        monkeypatch.setattr(suffixes, "SPLIT_ROWS", 6)
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    line = rng.choices(vocabulary, k=14)
    texts = []
    for _ in range(5):
        text = rng.choices(vocabulary, k=120)
        for _ in range(12):
            own = list(text)
            for _ in range(rng.choice([0, 1, 2, 3])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(rng.choices(vocabulary, k=rng.randrange(30)) + own[rng.randrange(40):])
    texts += [rng.choices(vocabulary, k=20) + line + rng.choices(vocabulary, k=20) for _ in range(30)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = covered(suffixes.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string"),
                                             min_words=24, gram=5).collect())
    assert got == brute(rows, 24)


def test_overlapping_cuts_of_common_texts(spark):
    """Partners that reach furthest to either side are others than the ones that match longest."""
    texts = []
    for seed in range(12):  # each with words of its own
        rng = random.Random(100 + seed)
        vocabulary = [f"w{seed}x{i}" for i in range(rng.choice([40, 400]))]
        common = [rng.choices(vocabulary, k=200) for _ in range(4)]
        for _ in range(160):
            text = []
            for _ in range(rng.randrange(1, 3)):
                cut = rng.choice(common)
                at = rng.randrange(170)
                text += rng.choices(vocabulary, k=rng.randrange(8)) + cut[at:at + rng.randrange(10, 50)]
            texts.append((len(texts), " ".join(text)))
    got = covered(suffixes.repeated_passages(spark.createDataFrame(texts, "doc_id bigint, text string"), min_words=24, gram=5).collect())
    assert got == brute(texts, 24)


def test_minimisers_cover_every_window():
    grams = np.random.default_rng(1).integers(0, 20, 500).astype(np.uint64)
    places = suffixes.minimisers(grams, 7)
    assert set(places.tolist()) == {i + max(j for j in range(7) if grams[i + j] == grams[i:i + 7].min()) for i in range(494)}


def test_edge_cases(spark):
    long = " ".join(f"a{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (3, long, 1), (4, "X " + long.upper(), 1), (4, "other text", 1), (None, long, 1),
         (6, "z " * 30_000, 1), (7, long[:100], None)], "doc_id bigint, text string, start int")
    got = sorted((r.doc_id or 0, r.start, r.end, r.first_doc_id) for r in suffixes.repeated_passages(docs).collect())
    assert got == [(0, 0, 60, 3), (3, 0, 60, 3), (4, 1, 61, 3)]
    assert suffixes.repeated_passages(docs.limit(0)).collect() == []
    inside = suffixes.repeated_passages(docs.filter("doc_id = 6"), within=True).collect()
    assert [(r.start, r.end) for r in inside] == [(0, 30_000)]
