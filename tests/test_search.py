import pytest
from pyspark.sql import functions as F

from rankloom import Model, cluster, evaluate_ranking, search, select_queries, show_ranking
from rankloom.operators import search as search_ops
from rankloom.plans import tune
from rankloom.plans.tune import sweep_rankings
from workload import queries as workload

SF = "/root/testdata/sf0.001"
MODEL = Model("dir", 2500.0)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def given(spark):
    return workload.index(spark, SF), workload.benchmark(spark, SF)


@pytest.mark.parametrize("piece", [1_000_000, 20])
def test_shuffled_query_side_gives_the_same(given, monkeypatch, piece):
    index, queries = given
    expected = rows(search(index, queries, MODEL, 10))
    monkeypatch.setattr(cluster, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(search_ops, "PIECE_POSTINGS", piece)
    spark = queries.sparkSession
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # only the split terms' numbers of pieces are broadcast
        side = search_ops.query_side(index, queries)
        text = plan(side.match())
        assert text.count("BroadcastHashJoin") == 1 and "piece" in text
        assert "SortMergeJoin [term" in text or "ShuffledHashJoin [term" in text
        assert rows(search(index, queries, MODEL, 10)) == expected
        asked, n = side.asked().count(), side.weighted.count()
        pieces = {r.term: r.pieces for r in side.split_terms().collect()}
        df = {r.term: r.df for r in side.weighted.collect()}
        assert n <= asked <= 2 * n
        assert pieces == {t: 1 + d // side.step for t, d in df.items() if d >= side.step}
        assert bool(pieces) == (piece == 20) and (not pieces or asked > n)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("model,pilot", [(Model("jm", 0.5), 60), (Model("jm", 1.0), 60), (MODEL, 0), (MODEL, 100_000), (Model("dir", 0), 60),
                                         (Model("tfidf"), 60)])
def test_bounded_ranking_gives_the_same(given, monkeypatch, model, pilot):
    index, queries = given
    expected = rows(search(index, queries, model, 10))
    monkeypatch.setattr(search_ops, "FEW_MATCHES", 0)
    monkeypatch.setattr(search_ops, "PILOT_MATCHES", pilot)
    assert rows(search(index, queries, model, 10)) == expected


def test_bounded_ranking_over_batches_and_keys(spark, tmp_path, monkeypatch):
    from rankloom import write_index
    docs = workload.documents(spark, SF)
    for part, mode in ((0, "create"), (1, "append"), (2, "append")):
        index = write_index(docs.filter(f"doc_id % 3 = {part}"), str(tmp_path / "i"), mode, buckets=1 + part)
    rounds = workload.rounds(spark, SF)
    expected = [rows(search(index, rounds, m, 7, ("query_id", "round"))) for m in (Model("tfidf"), Model("dir", 0))]
    monkeypatch.setattr(search_ops, "FEW_MATCHES", 0)
    assert [rows(search(index, rounds, m, 7, ("query_id", "round"))) for m in (Model("tfidf"), Model("dir", 0))] == expected


def test_spare_terms_are_not_summed(given, monkeypatch):
    """Of the matches of all terms, only those of the others, and of few documents, are left."""
    index, queries = given
    side = search_ops.query_side(index, queries)
    model = Model("jm", 0.5)
    terms, limits = search_ops.term_split(side, [model], 10, ("query_id",))
    every, spare = terms.agg(F.sum("df")).first()[0], terms.filter("spare").agg(F.sum("df")).first()[0]
    assert spare > every / 4
    best = {(r.query_id, r.doc_key): r for r in search(index, queries, model, 10).collect()}
    least = {r.query_id: r.t0 for r in limits.collect()}
    assert all(r.score >= least[q] for (q, _), r in best.items() if least.get(q) is not None)


@pytest.mark.parametrize("model", [Model("jm", 0.1), Model("jm", 0.9), Model("dir", 500), Model("dir", 0), Model("tfidf")])
def test_no_posting_scores_above_its_term_bound(given, model):
    index, queries = given
    extremes = index.term_stats.select("term", "max_tf", "min_len", "max_share")
    matched = search_ops.match(index, queries).join(extremes, "term")
    assert matched.filter(model.term_score() > model.bound() + 1e-9).count() == 0


def test_named_terms_give_the_same(given, monkeypatch):
    index, queries = given
    one = queries.filter("query_id = 3")
    expected = rows(search(index, one, MODEL, 10))
    assert "EqualTo(term" in plan(search(index, one, MODEL, 10))
    monkeypatch.setattr(search_ops, "PUSHED_TERMS", 0)
    assert rows(search(index, one, MODEL, 10)) == expected


def test_plan_moves_only_the_best_rows(given):
    index, queries = given
    text = plan(search(index, queries, MODEL, 10))
    assert text.count("_postings_") == 1  # few matches: one reading
    main = text[:text.index("BroadcastExchange")]
    assert main.count("Exchange hashpartitioning") == 1  # after the group limit
    assert main.index("Exchange hashpartitioning(query_id") < main.index("WindowGroupLimit", main.index("Exchange"))
    assert "BroadcastHashJoin" in main and "Bucketed: true" in text
    assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_sweep_plan(given):
    index, queries = given
    text = plan(sweep_rankings(index, queries, "jm", 10))
    assert text.count("_postings_") == 1  # one pass for all parameters
    main = text[:text.index("BroadcastExchange")]
    assert main.count("Exchange hashpartitioning") == 1
    assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("few", [0, 20_000_000])
def test_sweep_rankings_equal_single_rankings(given, monkeypatch, few):
    index, queries = given
    monkeypatch.setattr(search_ops, "FEW_MATCHES", few)
    swept = cluster.materialise(sweep_rankings(index, queries, "dir", 10))
    for param in (0.0, 2500.0):
        single = search(index, queries, Model("dir", param), 10)
        assert rows(swept.filter(f"param = {param}").select(single.columns)) == rows(single)


def test_text_is_tokenised_once(given):
    index, _ = given
    from rankloom.operators.terms import term_frequencies
    text = plan(term_frequencies(index.docs, ("doc_key",)))
    assert text.count("lower(contents") == 1 and "Exchange" not in text


@pytest.mark.parametrize("limit", [0, 1000])
def test_listing_fetches_the_same_texts(spark, given, monkeypatch, limit):
    index, queries = given
    monkeypatch.setattr(search_ops, "PUSHED_DOCS", limit)
    shown = show_ranking(index, search(index, queries, MODEL, 5), workload.judgements(spark, SF), 2)
    texts = {r.doc_id: r.contents for r in workload.documents(spark, SF).collect()}
    got = shown.collect()
    assert {r["rank"] for r in got} == {1, 2} and all(r.contents == texts[r.doc_id] for r in got)


def test_listing_over_batches_moves_no_text(spark, tmp_path, monkeypatch):
    from rankloom import write_index
    docs, queries = workload.documents(spark, SF), workload.benchmark(spark, SF)
    for part, mode in ((0, "create"), (1, "append")):
        index = write_index(docs.filter(f"doc_id % 2 = {part}"), str(tmp_path / "i"), mode, buckets=2 + part)
    monkeypatch.setattr(search_ops, "PUSHED_DOCS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = cluster.materialise(search(index, queries, MODEL, 5))
        listed = search_ops.stored_documents(index, ranked)
        # of the two sides of each batch's join only the ranking is dealt out
        assert plan(listed).count("Exchange hashpartitioning(doc_key") == 2 and plan(listed).count("ShuffledHashJoin") == 2
        texts = {r.doc_id: r.contents for r in docs.collect()}
        assert sorted((r.query_id, r.doc_id) for r in listed.collect()) == sorted((r.query_id, r.doc_id) for r in ranked.collect())
        assert all(r.contents == texts[r.doc_id] for r in listed.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("model", [Model("jm", 1.0), Model("dir", 0)])
def test_flat_models_rank_by_insertion(given, model):
    index, queries = given
    got = search(index, queries, model, 10).orderBy("query_id", "rank").collect()
    assert all(r.score == 0 for r in got)
    for query in {r.query_id for r in got}:
        ids = [r.doc_id for r in got if r.query_id == query]
        assert ids == sorted(ids)


def test_metric_bounds_and_recall_grows(spark, given):
    index, queries = given
    qrels = workload.labelled(spark, SF)
    ranking = search(index, queries, MODEL, 20)
    before = {}
    for cut in (1, 5, 20):
        table = {r.query_id: r for r in evaluate_ranking(ranking, queries, qrels, cut).collect()}
        for q, r in table.items():
            assert 0 <= r.precision <= 1 and 0 <= r.recall <= 1 and 0 <= r.average_precision <= 1
            assert r.recall >= before.get(q, 0)
            before[q] = r.recall


def test_select_queries(spark):
    q = spark.createDataFrame([(i, "x") for i in range(1, 6)], "query_id int, text string")
    ids = lambda which: sorted(r.query_id for r in select_queries(q, which).collect())
    assert ids("all") == [1, 2, 3, 4, 5] and ids("3") == [3] and ids("2-4") == [2, 3, 4]
    with pytest.raises(ValueError):
        select_queries(q, "x-2")


def test_judgements_by_brute_force(spark):
    texts = workload.documents(spark, SF).collect()
    expected = sorted((q.query_id, d.doc_id) for q in workload.benchmark(spark, SF).collect()
                      for d in texts if q.text in d.contents)
    assert rows(workload.verbatim_judgements(spark, SF)) == expected


def test_repeated_query_words_count(micro, spark):
    index, _, _ = micro
    q = spark.createDataFrame([(1, "alpha"), (2, "alpha Alpha")], "query_id int, text string")
    best = {r.query_id: r.score for r in search(index, q, Model("tfidf"), 1).collect()}
    assert best[2] == pytest.approx(2 * best[1], abs=2e-6)


def test_a_number_without_a_query_is_an_error(given):
    _, queries = given
    for which in ("99999", "99990-99999"):
        with pytest.raises(ValueError, match="no query"):
            select_queries(queries, which)


@pytest.mark.parametrize("broadcast", [None, 0])
def test_short_queries_keep_their_judgements(spark, tmp_path, monkeypatch, broadcast):
    docs = [(1, "alpha beta here"), (2, "gamma delta eps zeta"), (3, "xalpha betax"), (4, None), (5, ""), (6, "日本 🇪🇸🇫🇷 a.b"), (6, "Gamma. gammA")]
    asked = [(1, "alpha beta"), (2, "gamma"), (3, "gamma delta eps"), (4, "nowhere at all"), (5, "本"), (6, "🇸🇫"), (7, "."), (8, ""),
             (9, "a b"), (10, "mma"), (11, "ma g"), (12, None)]
    for name, rows_, schema in (("documents", docs, "doc_id bigint, text string"), ("benchmark", asked, "item_id bigint, text string")):
        spark.createDataFrame(rows_, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    if broadcast is not None:
        monkeypatch.setattr(cluster, "BROADCAST_BYTES", broadcast)
    found = workload.verbatim_judgements(spark, str(tmp_path))
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
    assert rows(found) == sorted((q, d) for q, t in asked for d, text in docs if t is not None and text is not None and t in text)
