"""Query sets with very many matches: what is kept and written stays small, and the results the same."""

import pytest
from pyspark.sql import functions as F

from rankloom import Model, build_index, cluster, search
from rankloom.operators import search as search_ops
from rankloom.plans.tune import sweep_rankings
from rankloom.sources import index as index_module

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def given(spark):
    docs = [(i, " ".join(w for j, w in enumerate(WORDS) for _ in range((i * (j + 3) + i // 7) % (j + 2)))) for i in range(600)]
    asked = [(q, " ".join(WORDS[(q * 5 + j) % 12] for j in range(2 + q % 7))) for q in range(9)] + [(9, "nowhere"), (10, "beta beta")]
    return (build_index(spark.createDataFrame(docs, "doc_id bigint, contents string")),
            spark.createDataFrame(asked, "query_id int, text string"))


@pytest.mark.parametrize("pilot,held", [(50, 300_000_000), (0, 300_000)])
def test_portions_and_bounds_give_the_same(given, monkeypatch, pilot, held):
    index, queries = given
    models = (Model("jm", 1.0), Model("tfidf"))
    expected = [rows(search(index, queries, m, 10)) for m in models], rows(sweep_rankings(index, queries, "jm", 10))
    monkeypatch.setattr(search_ops, "FEW_MATCHES", 0)
    monkeypatch.setattr(search_ops, "PILOT_MATCHES", pilot)
    monkeypatch.setattr(search_ops, "HELD_BYTES", held)
    assert (len(search_ops.query_side(index, queries).slices(10, ("query_id",))) > 1) == (held == 300_000)
    assert [rows(search(index, queries, m, 10)) for m in models] == expected[0]
    assert rows(sweep_rankings(index, queries, "jm", 10)) == expected[1]


def test_only_terms_and_bounds_are_written(given, monkeypatch):
    index, queries = given
    written, materialise = [], cluster.materialise

    def counted(df, *more):
        out = materialise(df, *more)
        written.append(out.count())
        return out

    monkeypatch.setattr(cluster, "materialise", counted)
    monkeypatch.setattr(search_ops, "FEW_MATCHES", 0)
    monkeypatch.setattr(search_ops, "PILOT_MATCHES", 50)
    sweep_rankings(index, queries, "jm", 10).collect()
    terms = search_ops.query_side(index, queries).weighted.count()
    assert written and max(written) <= terms


def test_few_sums_become_rows(given, monkeypatch):
    index, queries = given
    monkeypatch.setattr(search_ops, "FEW_MATCHES", 0)
    monkeypatch.setattr(search_ops, "PILOT_MATCHES", 200)
    side, models = search_ops.query_side(index, queries), [Model("jm", 0.5)]
    summed = search_ops.scores(side, models).groupBy("query_id").agg(F.count("*").alias("n"))
    near = search_ops.contenders(side, models, 3).groupBy("query_id").agg(F.count("*").alias("n"))
    assert near.agg(F.sum("n")).first()[0] < summed.agg(F.sum("n")).first()[0] / 5


def test_a_bucket_holds_few_documents(monkeypatch, given):
    index, _ = given
    monkeypatch.setattr(index_module, "_text_bytes", lambda docs: 6 << 30)
    assert index_module._bucket_count(index.docs) >= 300
