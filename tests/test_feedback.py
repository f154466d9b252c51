import random

import pytest

from rankloom import Model, build_index, feedback, search, with_contents

CUT = 4
MODEL = Model("jm", 0.4)


@pytest.fixture(scope="module")
def case(spark):
    rnd = random.Random(7)
    vocabulary = [f"w{i}" for i in range(12)]
    docs = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(2, 9)))) for i in range(40)]
    rounds = [(q, r, " ".join(rnd.choices(vocabulary, k=2))) for q in range(8) for r in (1, 2, 5, 9)]
    qrels = [(q, d) for q in range(8) for d in rnd.sample(range(40), 2 if q < 2 else 9)]
    return (build_index(spark.createDataFrame(docs, "doc_id bigint, contents string")),
            spark.createDataFrame(rounds, "query_id int, round int, text string"),
            spark.createDataFrame(qrels, "query_id int, doc_id bigint"), dict(docs), qrels)


def replay(ranking, qrels, residual):
    """One query at a time, as a person at a console would."""
    expected = {}
    for query in sorted({q for q, _ in ranking}):
        judged = {d for q, d in qrels if q == query}
        for round_ in sorted(r for q, r in ranking if q == query):
            if not judged:
                break
            ids = ranking[query, round_]
            hits = [i for i, d in enumerate(ids, 1) if d in judged]
            ap = sum((n + 1) / i for n, i in enumerate(hits)) / len(judged)
            first = (hits[0], ids[hits[0] - 1]) if hits else (None, None)
            expected[query, round_] = (len(judged), round(ap, 9), *first)
            if residual and hits:
                judged.discard(first[1])
    return expected


@pytest.mark.parametrize("residual", [False, True])
def test_rounds_against_replay(case, residual):
    index, rounds, qrels, _, judged = case
    ranking = {}
    for r in search(index, rounds, MODEL, CUT, ("query_id", "round")).orderBy("rank").collect():
        ranking.setdefault((r.query_id, r["round"]), []).append(r.doc_id)
    got = {(r.query_id, r["round"]): (r.n_relevant, round(r.value, 9), r.first_rank, r.first_doc_id)
           for r in feedback(index, rounds, qrels, MODEL, CUT, "MAP", residual).collect()}
    expected = replay(ranking, judged, residual)
    assert got == expected
    if residual:
        assert any(n < 9 for n, *_ in got.values())


def test_contents_of_the_first(case):
    index, rounds, qrels, texts, _ = case
    table = with_contents(index, feedback(index, rounds, qrels, MODEL, CUT, "P")).collect()
    assert len(table) == 32
    for r in table:
        assert r.first_contents == (texts[r.first_doc_id] if r.first_doc_id is not None else None)


def test_unjudged_query(case):
    index, rounds, qrels, _, _ = case
    some = qrels.filter("query_id <> 3")
    with pytest.raises(Exception, match="no relevant document"):
        feedback(index, rounds, some, MODEL, CUT, "R").collect()
    left = {r.query_id for r in feedback(index, rounds, some, MODEL, CUT, "R", on_empty="skip").collect()}
    assert left == set(range(8)) - {3}
