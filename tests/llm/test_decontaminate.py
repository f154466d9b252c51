"""Decontamination against windows looked up in plain Python."""

import random

from rankloom.llm import decontaminate as d


def brute(docs, items, window):
    words = lambda t: [w.decode() for w in d.words_of((t or "").encode())]
    wins = {}
    for name, t in items:
        ws = words(t)
        n = min(window, len(ws))
        for k in range(len(ws) - n + 1 if n else 0):
            if name is not None:
                wins.setdefault(tuple(ws[k:k + n]), set()).add(str(name))
    out = []
    for _, t in docs:
        ws, hit, found = words(t), set(), set()
        for n in {len(w) for w in wins}:
            for k in range(len(ws) - n + 1):
                if tuple(ws[k:k + n]) in wins:
                    hit.update(range(k, k + n))
                    found |= wins[tuple(ws[k:k + n])]
        out.append((len(ws), len(hit), sorted(found)))
    return out


def cases(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(8)] + ["É", "straße"]
    texts = lambda n, k: [" ".join(rng.choices(vocabulary, k=rng.randrange(k))) for _ in range(n)]
    items = list(enumerate(texts(12, 9))) + [(5, "w1 w2 w3 w4 w5 w6"), (None, "w1"), (7, None), (8, "...")]
    docs = [(i, t) for i, t in enumerate(texts(150, 60))] + [(3, None), (None, ""), (4, "W1, w2-w3")]
    return docs, items


def test_against_brute_force(spark, monkeypatch):
    docs, items = cases(11)
    left = spark.createDataFrame(docs, "doc_id bigint, text string")
    right = spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted(zip(map(repr, [i for i, _ in docs]), brute(docs, items, 4)))
    for portion, shard in ((d.PORTION_BYTES, d.SHARD_BYTES), (300, 2000)):
        monkeypatch.setattr(d, "PORTION_BYTES", portion)
        monkeypatch.setattr(d, "SHARD_BYTES", shard)
        rows = d.find_contamination(left, right, window=4).collect()
        assert sorted((repr(r.doc_id), (r.n_words, r.n_hit, r.items)) for r in rows) == want


def test_matches_are_the_longest(spark):
    item = " ".join(f"q{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"a b {item} c"), (2, " ".join(f"q{i}" for i in range(5, 20))), (3, "q1 q2 q3")],
                                 "doc_id bigint, text string")
    rows = d.find_contamination(docs, spark.createDataFrame([(9, item)], "item_id bigint, text string")).collect()
    assert [[(m.item, m.start, m.length) for m in r.matches] for r in rows] == [[("9", 2, 30)], [("9", 0, 15)], []]
    kept = d.remove_contaminated(docs, spark.createDataFrame([(9, item)], "item_id bigint, text string"))
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [3]


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, "x " * 30_000, 1), (2, "y", None)], "doc_id bigint, text string, n_hit int")
    items = spark.createDataFrame([(1, "x x x")], "item_id bigint, text string")
    rows = {r.doc_id: r.n_hit for r in d.find_contamination(docs, items).collect()}
    assert rows == {1: 30_000, 2: 0}
    assert {r.n_hit for r in d.find_contamination(docs, items.limit(0)).collect()} == {0}
    assert d.find_contamination(docs.limit(0), items).collect() == []
