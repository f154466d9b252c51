import math

import pytest
from pyspark.sql import functions as F

from rankloom import Model, evaluate_ranking, search

CASES = {
    Model("jm", 0.5): ([(1, 2.063693), (2, 1.056053), (3, 1.056053)], (2 / 3, 1, 0.833333),
                       [(3, 0.810930), (4, 0.693147)], (0.5, 1, 0.5)),
    Model("jm", 1.0): ([(1, 0), (2, 0), (3, 0)], (2 / 3, 1, 0.833333),
                       [(3, 0), (4, 0)], (0.5, 1, 0.5)),
    Model("dir", 0): ([(1, 0), (2, 0), (3, 0)], (2 / 3, 1, 0.833333),
                      [(3, 0), (4, 0)], (0.5, 1, 0.5)),
    Model("dir", 10): ([(1, 0.353341), (3, 0.223144), (2, 0.136132)], (2 / 3, 1, 1),
                       [(3, 0.068993), (4, 0)], (0.5, 1, 0.5)),
    Model("tfidf"): ([(1, 2.105860), (2, 1.068315), (3, 1.068315)], (2 / 3, 1, 0.833333),
                     [(3, 0.755413), (4, 0.675662)], (0.5, 1, 0.5)),
}


@pytest.mark.parametrize("model", CASES, ids=lambda m: f"{m.kind}-{m.param}")
def test_scores_and_metrics(micro, model):
    index, queries, qrels = micro
    first, first_metrics, second, second_metrics = CASES[model]
    ranking = search(index, queries, model, 3)
    rows = ranking.orderBy("query_id", "rank").collect()
    for query, expected in ((1, first), (2, second)):
        got = [(r.doc_id, r.score) for r in rows if r.query_id == query]
        assert [d for d, _ in got] == [d for d, _ in expected]
        assert [s for _, s in got] == pytest.approx([s for _, s in expected], abs=1e-6)
        assert [r.rank for r in rows if r.query_id == query] == list(range(1, len(expected) + 1))
    assert not [r for r in rows if r.query_id == 3]

    values = {r.query_id: (r.precision, r.recall, r.average_precision)
              for r in evaluate_ranking(ranking, queries, qrels, 3, "include").collect()}
    assert values[1] == pytest.approx(first_metrics, abs=1e-6)
    assert values[2] == pytest.approx(second_metrics, abs=1e-6)
    assert math.isnan(values[3][0]) and values[3][1] == 1 and math.isnan(values[3][2])
    skipped = evaluate_ranking(ranking, queries, qrels, 3, "skip")
    assert {r.query_id for r in skipped.collect()} == {1, 2}


def test_collection_statistics(micro):
    index, _, _ = micro
    assert (index.doc_count, index.total_terms) == (4, 14)
    stats = {r.term: (r.df, r.ctf) for r in index.term_stats.collect()}
    assert stats["alpha"] == (2, 3) and stats["beta"] == (2, 3) and stats["theta"] == (1, 1)
    assert index.docs.select(F.count_distinct("doc_key")).first()[0] == 4
