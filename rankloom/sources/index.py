"""A collection as tables that searches read.

Every batch has a folder of its own with ``docs`` and ``postings``, Parquet tables bucketed
by document into as many buckets as the batch needs, so that counting a document's words and
adding up its scores need no shuffle, and no term, however frequent, makes a task larger
than another. Postings are sorted by term and documents by key inside each bucket, so a
filter on few values reads few pages. ``term_stats`` holds a batch's statistics per term and
the extremes that bound what the term can add to a score.

One row per batch in ``collection_stats`` names its folder, its buckets, its totals and the
first document key that is free after it. So an append reads nothing of the older batches,
and a folder that no row names is never read.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom import cluster
from rankloom.operators.terms import bounded_term_stats, term_frequencies

MODES = ("create", "append", "create_or_append")
DOC_COLUMNS = "batch_id INT, doc_key BIGINT, doc_id BIGINT, contents STRING"
POSTING_COLUMNS = ("term STRING, batch_id INT, doc_key BIGINT, doc_id BIGINT, tf INT, "
                   "doc_len INT")
# Text per bucket when the number of buckets is left open, and the most that Spark allows. A task
# counts the words of a bucket in memory, and a search sums its documents' scores there.
BUCKET_BYTES = 16 * 1024 * 1024
MAX_BUCKETS = 100_000
# Compressed files hold about so many times their size in text.
FILE_BYTES_TO_TEXT = 2
STATS_COLUMNS = ("batch_id INT, folder STRING, buckets INT, doc_count BIGINT, total_terms BIGINT, "
                 "next_key BIGINT")


@dataclass(frozen=True)
class Batch:
    """The tables of one batch; no other batch has its document keys."""

    folder: str
    buckets: int
    docs: DataFrame
    postings: DataFrame


@dataclass(frozen=True)
class Index:
    """A4's two numbers, and the tables of all committed batches, apart and together."""

    path: str
    batches: tuple[Batch, ...]
    doc_count: int
    total_terms: int
    term_stats: DataFrame  # one row per term and batch; readers add them up

    @property
    def docs(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [b.docs for b in self.batches])

    @property
    def postings(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [b.postings for b in self.batches])

    @property
    def buckets(self) -> int:
        return sum(b.buckets for b in self.batches)


def _committed(spark: SparkSession, path: str) -> list:
    try:
        return spark.read.schema(STATS_COLUMNS).parquet(f"{path}/collection_stats").orderBy("batch_id").collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def _commit(spark: SparkSession, path: str, row: tuple, mode: str) -> None:
    spark.createDataFrame([row], STATS_COLUMNS).coalesce(1).write.mode(mode).parquet(f"{path}/collection_stats")


def _table_name(folder: str, kind: str, buckets: int) -> str:
    return f"rankloom_{kind}_{hashlib.md5(f'{folder}/{kind}'.encode()).hexdigest()}_{buckets}"


def _table(spark: SparkSession, folder: str, kind: str, columns: str, sort: str,
           buckets: int) -> str:
    """Names the Parquet folder as a bucketed table of the session's catalog."""
    location = f"{folder}/{kind}"
    name = _table_name(folder, kind, buckets)
    quoted = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"CLUSTERED BY (doc_key) SORTED BY ({sort}) INTO {buckets} BUCKETS "
              f"LOCATION '{quoted}'")
    spark.catalog.refreshTable(name)
    return name


def _tables(spark: SparkSession, folder: str, buckets: int) -> tuple[str, str]:
    return (_table(spark, folder, "docs", DOC_COLUMNS, "doc_key", buckets),
            _table(spark, folder, "postings", POSTING_COLUMNS, "term", buckets))


def _drop_batch(spark: SparkSession, folder: str, buckets: int) -> None:
    for kind in ("docs", "postings"):
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(folder, kind, buckets)}")
    cluster.remove_folder(spark, folder)


def _text_bytes(docs: DataFrame) -> int:
    """Bytes of text: told by the input files' sizes, or counted where there are no files."""
    if size := cluster.input_bytes(docs):
        return FILE_BYTES_TO_TEXT * size
    return docs.agg(F.sum(F.octet_length("contents"))).first()[0] or 0


def _bucket_count(docs: DataFrame) -> int:
    size = _text_bytes(docs)
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MAX_BUCKETS, max(least, -(-size // BUCKET_BYTES)))


def write_index(docs: DataFrame, path: str, mode: str = "create",
                buckets: int | None = None) -> Index:
    """Adds ``docs(doc_id, contents)`` as one batch and opens the result.

    ``create`` replaces what is at ``path``, ``append`` needs an index there,
    ``create_or_append`` does whichever fits. Documents are only ever added: one
    appended twice counts twice. ``buckets`` is how many tasks read the batch; by
    default it follows the size of its texts. A batch counts once its row in
    ``collection_stats`` is written, as the last step, so a failed call leaves the index
    as it was, and its files are removed. One writer at a time.

    ``docs`` should come straight from files: a scan gives the same rows in the same
    order when a lost task is done again, and so the same keys. Write the outcome of
    a join or an aggregation to a table first.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    spark = docs.sparkSession
    committed = _committed(spark, path)
    if mode == "append" and not committed:
        raise FileNotFoundError(f"no index to append to at {path}")
    adding = bool(committed) and mode != "create"
    buckets = buckets or _bucket_count(docs)
    batch = committed[-1].batch_id + 1 if adding else 0
    first_key = max(r.next_key for r in committed) if adding else 0
    # keys apart from those of any other batch: the number is free, the order is the scan's
    keyed = docs.select(F.lit(batch).alias("batch_id"),
                        (F.monotonically_increasing_id() + first_key).alias("doc_key"),
                        F.col("doc_id").cast("bigint").alias("doc_id"), "contents")
    name = f"batch-{batch:06d}-{uuid.uuid4().hex}"
    with _Cleared(spark, f"{path}/{name}", buckets):
        row = _write_batch(keyed, f"{path}/{name}", buckets)
        _commit(spark, path, (batch, name, buckets, *row), "append" if adding else "overwrite")
    if not adding:
        for old in committed:
            _drop_batch(spark, f"{path}/{old.folder}", old.buckets)
    return open_index(spark, path)


class _Cleared:
    """Takes a batch's tables and files away again if it is not completed."""

    def __init__(self, *batch):
        self.batch = batch

    def __enter__(self):
        return self

    def __exit__(self, kind, *_):
        if kind is not None:
            _drop_batch(*self.batch)


def _write_batch(keyed: DataFrame, folder: str, buckets: int) -> tuple[int, int, int]:
    """Writes a batch's tables; the documents with a word, the words, and the first free key."""
    spark = keyed.sparkSession
    docs_table, postings_table = _tables(spark, folder, buckets)
    # The one shuffle: texts by a key that no two documents share, hence no skew.
    keyed.repartition(buckets, "doc_key").write.insertInto(docs_table)
    stored = spark.table(docs_table)
    (term_frequencies(stored, ("batch_id", "doc_key", "doc_id"))
     .select("term", "batch_id", "doc_key", "doc_id", "tf", "doc_len")
     .write.insertInto(postings_table))
    return _write_stats(spark, folder, spark.table(postings_table), stored)


def _write_stats(spark: SparkSession, folder: str, postings: DataFrame, docs: DataFrame) -> tuple[int, int, int]:
    bounded_term_stats(postings).sortWithinPartitions("term").write.parquet(f"{folder}/term_stats")
    total = spark.read.parquet(f"{folder}/term_stats").agg(F.sum("ctf")).first()[0]
    # documents with a word, from the postings: they lie by document, so nothing moves
    holding = postings.select("doc_key").distinct().count()
    last = docs.agg(F.max("doc_key")).first()[0]
    return holding, total or 0, 0 if last is None else last + 1


def open_index(spark: SparkSession, path: str) -> Index:
    """Registers the tables in the session's catalog and reads the statistics."""
    committed = _committed(spark, path)
    if not committed:
        raise FileNotFoundError(f"no index at {path}")
    batches = []
    for r in committed:
        docs, postings = _tables(spark, f"{path}/{r.folder}", r.buckets)
        batches.append(Batch(r.folder, r.buckets, spark.table(docs), spark.table(postings)))
    return Index(
        path=path, batches=tuple(batches), doc_count=sum(r.doc_count for r in committed),
        total_terms=sum(r.total_terms for r in committed),
        term_stats=spark.read.parquet(*(f"{path}/{r.folder}/term_stats" for r in committed)))


def compact(index: Index, path: str, buckets: int | None = None) -> Index:
    """A new index at ``path`` with the documents of all batches in one folder.

    For an index of very many batches, each of which is a stage of its own in a search. Documents
    keep their batch number and key, and so their order among equals.
    """
    spark = index.docs.sparkSession
    if _committed(spark, path):
        raise FileExistsError(f"there is an index at {path}")
    buckets = buckets or _bucket_count(index.docs)
    name = f"batch-compact-{uuid.uuid4().hex}"
    last = max(r.batch_id for r in _committed(spark, index.path))
    with _Cleared(spark, f"{path}/{name}", buckets):
        tables = _tables(spark, f"{path}/{name}", buckets)
        for rows, table in zip((index.docs, index.postings), tables):
            rows.select(*spark.table(table).columns).repartition(buckets, "doc_key").write.insertInto(table)
        row = _write_stats(spark, f"{path}/{name}", spark.table(tables[1]), spark.table(tables[0]))
        _commit(spark, path, (last, name, buckets, *row), "overwrite")
    return open_index(spark, path)


def drop_index(index: Index) -> None:
    """Takes the index's tables out of the catalog and deletes its folder."""
    spark = index.docs.sparkSession
    for batch in index.batches:
        _drop_batch(spark, f"{index.path}/{batch.folder}", batch.buckets)
    cluster.remove_folder(spark, index.path)


def build_index(docs: DataFrame, buckets: int | None = None) -> Index:
    """An index in a fresh scratch folder; ``cluster.drop_scratch`` removes it with the others."""
    index = write_index(docs, cluster.fresh_folder(docs.sparkSession), "create", buckets)
    cluster.at_drop(docs.sparkSession, lambda: drop_index(index))
    return index
