import pytest
from pyspark.sql import functions as F

from rankloom import Model, open_index, search, write_index
from rankloom.sources import index as index_module

A = [(1, "alpha beta"), (2, "beta beta gamma")]
B = [(3, "gamma alpha"), (4, "delta")]


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, contents string")


def ranks(index, model=Model("jm", 0.5), k=10):
    queries = index.docs.sparkSession.createDataFrame(
        [(1, "alpha beta gamma"), (2, "delta")], "query_id int, text string")
    return [(r.query_id, r.rank, r.doc_id, r.score)
            for r in search(index, queries, model, k).orderBy("query_id", "rank").collect()]


def test_append_equals_one_create(spark, tmp_path):
    whole = write_index(docs(spark, A + B), str(tmp_path / "whole"))
    write_index(docs(spark, A), str(tmp_path / "parts"), "create", buckets=3)
    parts = write_index(docs(spark, B), str(tmp_path / "parts"), "append", buckets=7)
    assert [b.buckets for b in parts.batches] == [3, 7]
    assert (parts.doc_count, parts.total_terms) == (whole.doc_count, whole.total_terms)
    for model in (Model("jm", 0.5), Model("dir", 10), Model("tfidf")):
        assert ranks(parts, model) == ranks(whole, model)
    again = open_index(spark, str(tmp_path / "parts"))
    assert ranks(again) == ranks(whole)


def test_appending_the_same_documents_adds_them(spark, tmp_path):
    path = str(tmp_path / "i")
    write_index(docs(spark, A), path, "create_or_append")
    index = write_index(docs(spark, A), path, "create_or_append")
    assert index.doc_count == 4
    assert [d for q, _, d, _ in ranks(index) if q == 1] == [1, 1, 2, 2]
    assert index.docs.select("doc_key").distinct().count() == 4


def test_equal_ids_within_a_batch_stay_apart(spark, tmp_path):
    index = write_index(docs(spark, [(7, "alpha"), (7, "alpha alpha")]), str(tmp_path / "i"))
    assert index.doc_count == 2
    assert [d for _, _, d, _ in ranks(index)] == [7, 7]


def test_create_replaces(spark, tmp_path):
    path = str(tmp_path / "i")
    write_index(docs(spark, A), path)
    index = write_index(docs(spark, B), path, "create", buckets=2)
    assert sorted(r.doc_id for r in index.docs.collect()) == [3, 4]
    assert index.buckets == 2
    assert sorted(r.term for r in index.term_stats.collect()) == ["alpha", "delta", "gamma"]


def test_append_needs_an_index(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        write_index(docs(spark, A), str(tmp_path / "none"), "append")
    with pytest.raises(FileNotFoundError):
        open_index(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        write_index(docs(spark, A), str(tmp_path / "none"), "update")


def test_a_failed_batch_does_not_count(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "i")
    write_index(docs(spark, A), path)

    def fail(_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(index_module, "bounded_term_stats", fail)
        with pytest.raises(RuntimeError):
            write_index(docs(spark, B), path, "append")
    assert sorted(r.doc_id for r in open_index(spark, path).docs.collect()) == [1, 2]
    assert len(list((tmp_path / "i").glob("batch-*"))) == 1  # and nothing of it is left
    index = write_index(docs(spark, B), path, "append")
    assert sorted(r.doc_id for r in index.docs.collect()) == [1, 2, 3, 4]
    assert index.term_stats.agg(F.sum("ctf")).first()[0] == index.total_terms == 8


def test_an_append_reads_no_older_batch(spark, tmp_path):
    path = tmp_path / "i"
    write_index(docs(spark, A), str(path))
    # whatever reads the older texts or postings fails
    for kind in ("docs", "postings"):
        for file in path.glob(f"batch-*/{kind}/part-*"):
            file.write_bytes(b"not parquet")
    index = write_index(docs(spark, B), str(path), "append")
    assert (index.doc_count, len(index.batches)) == (4, 2)
    assert sorted(r.doc_id for r in index.batches[1].docs.collect()) == [3, 4]
    keys = {r.doc_key for r in index.batches[1].docs.collect()}
    assert min(keys) >= spark.read.parquet(f"{path}/collection_stats").filter("batch_id = 0").first().next_key


def test_a_file_left_by_a_lost_call_is_never_read(spark, tmp_path):
    path = tmp_path / "i"
    write_index(docs(spark, A), str(path))
    (path / "batch-000001-lost" / "docs").mkdir(parents=True)
    (path / "batch-000001-lost" / "docs" / "part-0.parquet").write_bytes(b"not parquet")
    index = write_index(docs(spark, B), str(path), "append")
    assert sorted(r.doc_id for r in index.docs.collect()) == [1, 2, 3, 4]
    files = index.docs.inputFiles() + index.postings.inputFiles() + index.term_stats.inputFiles()
    assert files and not any("000001-lost" in f for f in files)


def test_a_batch_is_summed_where_it_lies(spark, tmp_path):
    path = str(tmp_path / "i")
    write_index(docs(spark, A), path, "create", buckets=3)
    index = write_index(docs(spark, B), path, "append", buckets=5)
    queries = spark.createDataFrame([(1, "alpha beta gamma")], "query_id int, text string")
    text = search(index, queries, Model("jm", 0.5), 10)._jdf.queryExecution().executedPlan().toString()
    # the best rows of the batches meet in one exchange; nothing of a batch moves by document
    assert text[:text.index("Union")].count("Exchange hashpartitioning(query_id") == 1
    assert "doc_key" not in "".join(line for line in text.splitlines() if "Exchange hashpartitioning" in line)


def test_scratch_is_dropped(spark, tmp_path):
    from rankloom import build_index, cluster

    held = cluster._made.pop(spark.sparkContext.applicationId, [])  # what other tests still use
    index, table = build_index(docs(spark, A)), cluster.materialise(docs(spark, B))
    folders = [index.path, table.inputFiles()[0].rsplit("/", 1)[0]]
    exists = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(
        spark._jvm.org.apache.hadoop.fs.Path(p))
    assert all(map(exists, folders))
    cluster.drop_scratch(spark)
    assert not any(map(exists, folders)) and not spark.catalog.tableExists(
        index_module._table_name(f"{index.path}/{index.batches[0].folder}", "docs", index.buckets))
    cluster._made[spark.sparkContext.applicationId] = held


def test_documents_without_words(spark, tmp_path):
    index = write_index(docs(spark, [(1, ""), (2, None), (3, "... !"), (4, "delta")]), str(tmp_path / "i"))
    assert (index.doc_count, index.total_terms) == (1, 1)
    assert index.docs.count() == 4
    assert [d for _, _, d, _ in ranks(index)] == [4]


def test_empty_collection(spark, tmp_path):
    index = write_index(docs(spark, []), str(tmp_path / "i"))
    assert index.doc_count == 0 and ranks(index) == []


def test_buckets_follow_the_size_of_the_texts(spark, tmp_path, monkeypatch):
    rows = [(i, "alpha beta") for i in range(20)]
    monkeypatch.setattr(index_module, "BUCKET_BYTES", 20)
    index = write_index(docs(spark, rows), str(tmp_path / "i"))
    assert index.buckets == 10
    assert [d for q, _, d, _ in ranks(index) if q == 1] == list(range(10))


def test_compact_and_drop(spark, tmp_path):
    from rankloom import compact, drop_index

    docs = spark.createDataFrame([(i, f"alpha beta {'gamma ' * (i % 5)}") for i in range(40)], "doc_id bigint, contents string")
    small = write_index(docs.limit(0).unionByName(docs.filter("doc_id < 2")), str(tmp_path / "a"), "create", buckets=2)
    grown = write_index(docs.filter("doc_id >= 2"), str(tmp_path / "a"), "append")
    assert [b.buckets for b in grown.batches] == [2, 4] and small.buckets == 2
    wide = compact(grown, str(tmp_path / "b"), buckets=8)
    assert wide.buckets == 8
    summed = wide.postings.groupBy("doc_key").agg(F.sum("tf"))  # lies by document: nothing moves
    assert "Exchange" not in summed._jdf.queryExecution().executedPlan().toString()
    queries = spark.createDataFrame([(1, "gamma alpha")], "query_id int, text string")
    model = Model("jm", 0.5)
    ranked = [sorted(map(tuple, search(i, queries, model, 7).collect())) for i in (grown, wide)]
    assert ranked[0] == ranked[1] and len(ranked[0]) == 7
    once = write_index(docs, str(tmp_path / "c"), "create")
    assert (once.doc_count, once.total_terms) == (wide.doc_count, wide.total_terms)
    assert [r[-1] for r in sorted(map(tuple, search(once, queries, model, 7).collect()))] == [r[-1] for r in ranked[1]]
    tables = lambda: {t.name for t in spark.catalog.listTables() if t.name.startswith("rankloom_")}
    before = tables()
    drop_index(wide)
    assert len(before - tables()) == 2 and not (tmp_path / "b").exists()
