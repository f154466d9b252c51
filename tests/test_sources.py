import os

import pytest

from rankloom.sources import collection
from rankloom import read_corpus, read_qrels, read_queries, read_results, write_results


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_corpus(spark, tmp_path):
    path = put(tmp_path, "documents.txt",
               "1\nfirst line\nsecond line\n   /\n2\n\n   /\n   /\n3\n   /\n4\nwith / and /\n/\n   /\n5\nlast\n   /")
    assert rows(read_corpus(spark, path)) == [
        (1, "first line\nsecond line\n"), (2, "\n"), (3, ""), (4, "with / and /\n/\n"), (5, "last\n")]


def test_corpus_ends_with_newline_and_stray_terminator(spark, tmp_path):
    path = put(tmp_path, "documents.txt", "1\na\n   /\n2\nb\n   /\n   /\n")
    assert rows(read_corpus(spark, path)) == [(1, "a\n"), (2, "b\n")]


def test_last_record_without_terminator(spark, tmp_path):
    path = put(tmp_path, "documents.txt", "1\na\n   /\n2\nb")
    assert rows(read_corpus(spark, path)) == [(1, "a\n"), (2, "b\n")]


def test_file_split_over_tasks(spark, tmp_path):
    records = [(i, f"text of {i} " + "x" * (i % 97)) for i in range(3000)]
    path = put(tmp_path, "documents.txt", "".join(f"{i}\n{t}\n   /\n" for i, t in records))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4093b")
    try:
        df = read_corpus(spark, path)
        assert df.rdd.getNumPartitions() > 10
        assert rows(df) == [(i, t + "\n") for i, t in records]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("eol", ["\n", "\r\n"])
def test_both_line_endings_split_over_tasks(spark, tmp_path, eol):
    records = [(i, f"text of {i} " + "x" * (i % 97)) for i in range(2000)]
    path = tmp_path / "documents.txt"
    path.write_bytes("".join(f"{i}\n{t}\n   /\n" for i, t in records).replace("\n", eol).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4093b")
    try:
        df = read_corpus(spark, str(path))
        assert df.rdd.getNumPartitions() > 10
        assert rows(df) == [(i, t + "\n") for i, t in records]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_windows_queries_and_judgements(spark, tmp_path):
    for name, text in (("q", "1\r\nTWO\r\nWORDS\r\n/\r\n"), ("j", "1\r\n 10 20\r\n   /\r\n2\r\n7\r\n   /")):
        (tmp_path / name).write_bytes(text.encode())
    assert rows(read_queries(spark, str(tmp_path / "q"))) == [(1, "TWO WORDS")]
    assert rows(read_qrels(spark, str(tmp_path / "j"))) == [(1, 10), (1, 20), (2, 7)]


def test_mixed_endings_and_broken_headers_are_errors(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.txt").write_bytes(b"1\na\n   /\n")
    (folder / "b.txt").write_bytes(b"2\r\nb\r\n   /\r\n")
    with pytest.raises(ValueError, match="line endings"):
        read_corpus(spark, str(folder))
    (tmp_path / "one").write_bytes(b"1\r\na\r\n   /\n2\r\nb\r\n   /\r\n")
    with pytest.raises(Exception, match="line endings"):
        read_corpus(spark, str(tmp_path / "one")).count()
    (tmp_path / "two").write_bytes(b"1\na\n   /\n2\r\nb\r\n   /\r\n3\nc\n   /\n")
    with pytest.raises(Exception, match="line endings"):
        read_corpus(spark, str(tmp_path / "two")).count()
    (tmp_path / "last").write_bytes(b"1\na\n   /\n2\r\nb\r\n   /")
    with pytest.raises(Exception, match="line endings"):
        read_corpus(spark, str(tmp_path / "last")).count()
    broken = put(tmp_path, "documents.txt", "1\na\n   /\nx2\nb\n   /\n")
    with pytest.raises(Exception, match="begins with no number: x2"):
        read_corpus(spark, broken).count()


def test_heads_alone_tell_the_line_ending(spark, tmp_path, monkeypatch):
    """Compressed files, empty ones, names with blanks; texts are read by the records' reader only."""
    import gzip

    folder = tmp_path / "with blank"
    folder.mkdir()
    (folder / "a b.txt.gz").write_bytes(gzip.compress(b"1\r\na\r\n   /\r\n"))
    (folder / "empty.txt").write_bytes(b"")
    (folder / "c%20d.txt").write_bytes(b"2\r\nb " + b"x" * 10_000 + b"\r\n   /")
    asked = []
    real = collection.cluster.first_bytes
    monkeypatch.setattr(collection.cluster, "first_bytes", lambda s, name, size: asked.append(size) or real(s, name, size))
    got = rows(read_corpus(spark, str(folder)))
    assert got == [(1, "a\n"), (2, "b " + "x" * 10_000 + "\n")]
    assert len(asked) == 3 and set(asked) == {collection.HEAD_BYTES}


def test_queries(spark, tmp_path):
    path = put(tmp_path, "queries.txt", "1\nMEASUREMENT OF\nDIELECTRIC\n/\n2\nword\n/\n/\n")
    assert rows(read_queries(spark, path)) == [(1, "MEASUREMENT OF DIELECTRIC"), (2, "word")]


def test_judgements(spark, tmp_path):
    path = put(tmp_path, "judgements.txt", "1\n  10  20 30\n 40\n   /\n2\n   /\n3\n5\n   /\n")
    assert rows(read_qrels(spark, path)) == [(1, 10), (1, 20), (1, 30), (1, 40), (3, 5)]


def test_results_round_trip(spark, tmp_path):
    path = str(tmp_path / "run")
    df = spark.createDataFrame([(10, 0.25), (2, 1.0), (3, float("nan"))], "query_id int, value double")
    write_results(df, path)
    write_results(df.filter("query_id <> 3"), path)
    assert rows(read_results(spark, path)) == [(2, 1.0), (10, 0.25)]
    lines = []
    for name in sorted(f for f in os.listdir(path) if f.startswith("part-")):
        lines += (tmp_path / "run" / name).read_text().splitlines()
    assert lines == ["2, 1.0", "10, 0.25"]


def test_results_of_another_writer(spark, tmp_path):
    path = put(tmp_path, "run.txt", "1, 0.5\n2, 1.0E-4\n\n")
    assert rows(read_results(spark, path)) == [(1, 0.5), (2, pytest.approx(1e-4))]
