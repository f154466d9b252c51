"""A corpus pipeline: five stages over ``documents``, each one operator of ``rankloom.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns of
``docs``, whatever others there are besides those of ``documents``: an operator sees only the id
and the text, so that no column can be mistaken for one of its results. An empty table gives
an empty one in every stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom import cluster
from rankloom.llm import bpe, decontaminate, neardup, pii, toxicity
from rankloom.llm.common import fold_of
from rankloom.llm.queries import table, vocabulary_path


def _packed(docs: DataFrame) -> DataFrame:
    """Id and text for an operator, and the rest of the row beside them; a text goes to the workers once."""
    return docs.select("doc_id", "text", F.struct(*(c for c in docs.columns if c != "text")).alias("row"))


def _unpacked(packed: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` again, some of them ``changed``."""
    same = {c: F.col("text") if c == "text" else F.col("row").getField(c) for c in docs.columns}
    return packed.select(*(column.alias(c) for c, column in (same | changed).items()))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below one half.

    A null or empty text stays, and so does everything where no labels of both kinds can be
    learnt from; rows alike in text stay or go together, whatever their ids.
    """
    held_out = fold_of(F.col("doc_id"), 5) == 0
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    return _unpacked(toxicity.score(_packed(docs), model).filter("predicted = 0"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id.

    A text without words is nobody's copy. A row without an id stays unless a document with its
    set of shingles stays; rows that repeat an id stay or go together.
    """
    kept = neardup.link_documents(docs).filter("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_kept_id")), "left_semi")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    A null text has none and stays; ids play no part; an empty benchmark takes nothing away.
    """
    return _unpacked(decontaminate.remove_contaminated(_packed(docs), table(spark, sf_dir, "benchmark")), docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; ``n_chars`` follows the new text.

    No row goes. A text without such data, a null one too, stays as it is, with its ``n_chars``;
    repeated rows are masked alike.
    """
    found = pii.find(_packed(docs), pii.train(docs))
    done = found.select("row", "text", "spans", pii.masked(F.col("text"), F.col("spans")).alias("masked"))
    none = F.size("spans") == 0
    n_chars = F.char_length("masked").cast(docs.schema["n_chars"].dataType)
    return _unpacked(done, docs, text=F.when(none, F.col("text")).otherwise(F.col("masked")),
                     n_chars=F.when(none, F.col("row.n_chars")).otherwise(n_chars))


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text in place of it, their number, and a digest of what they decode to.

    A null or empty text has no ids; every row is encoded by itself; only ``doc_id``, ``lang`` and
    ``source`` are kept of the others.
    """
    done = bpe.encode_documents(docs, vocabulary_path(), decoded=True)
    return done.select("doc_id", "lang", "source", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids",
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_copies), ("decontamination", drop_benchmark),
          ("personal_data", mask_personal_data), ("bpe", encode_text)]

# Learned scores, MinHash and merges are not SQL; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        docs = done if i == len(STAGES) - 1 else cluster.materialise(done)
    return docs
