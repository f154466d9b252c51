"""The plain-text layout of a test collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom import cluster

# The line that ends a record.
DOCUMENT_END = "   /"
QUERY_END = "/"
JUDGEMENT_END = "   /"


# A record's number and its line ending stand within this many bytes.
HEAD_BYTES = 4096


def _line_end(spark: SparkSession, path: str) -> str:
    """The line ending of a collection, told by the first line of each file; a mixture is an error.

    Only the heads of the files are looked at. That a file goes on as it begins is checked where its
    records are read.
    """
    def ending(file: str) -> str | None:
        head = cluster.first_bytes(spark, file, HEAD_BYTES)
        at = head.find(b"\n")
        return None if at < 0 else "\r\n" if head[:at].endswith(b"\r") else "\n"

    found = set(cluster.of_files(spark.read.text(path).inputFiles(), ending)) - {None}
    if len(found) > 1:
        raise ValueError(f"{path} mixes two kinds of line endings")
    return found.pop() if found else "\n"


def _records(spark: SparkSession, path: str, end: str) -> DataFrame:
    """``(number, body)`` of every record, with plain line feeds in the body.

    The reader splits at the closing line itself, so a large file is read by many tasks.
    A record whose first line is no number is an error; stray closing lines are not.
    """
    eol = _line_end(spark, path)
    raw = spark.read.option("lineSep", f"{eol}{end}{eol}").text(path)
    # closing lines that belong to no record stick to the next or to the last one
    plain = F.regexp_replace("value", "\r(?=\n|\\z)", "") if eol == "\r\n" else F.col("value")
    text = F.regexp_replace(plain, rf"\A(?:{end}\n)+", "")
    text = F.regexp_replace(text, rf"(?:\A|\n){end}\n?\z", "")
    lines = F.split(text, "\n", 2)
    split = raw.select(text.alias("text"), lines[0].alias("number"), F.get(lines, F.lit(1)).alias("body"))
    # the other ending closes a record inside this one, or ends its first line
    mixed = F.contains(F.col("text"), F.lit(f"\n{end}\n")) | F.contains(F.col("text"), F.lit(f"\n{end}\r\n")) | F.endswith(
        F.col("number"), F.lit("\r"))
    headed = (F.when(mixed, F.raise_error(F.lit("a file mixes two kinds of line endings")).cast("boolean"))
              .when(F.col("number").rlike(r"\A-?\d+\z"), True).when(F.trim(F.translate("text", "\n\r\t", "   ")) == "", False)
              .otherwise(F.raise_error(F.concat(F.lit("a record begins with no number: "), F.substring("number", 1, 80)))
                         .cast("boolean")))
    return split.filter(headed).select("number", "body")


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, contents)``; every text line keeps its line feed."""
    return _records(spark, path, DOCUMENT_END).select(
        F.col("number").cast("bigint").alias("doc_id"),
        F.when(F.col("body").isNull(), "")
        .otherwise(F.concat("body", F.lit("\n"))).alias("contents"))


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """``(query_id, text)``, the lines joined with blanks."""
    return _records(spark, path, QUERY_END).select(
        F.col("number").cast("int").alias("query_id"),
        F.trim(F.translate("body", "\n", " ")).alias("text"))


def read_qrels(spark: SparkSession, path: str) -> DataFrame:
    """S3: ``(query_id, doc_id)``, one row per judgement."""
    ids = F.regexp_extract_all("body", F.lit(r"-?\d+"), F.lit(0)).cast("array<bigint>")
    return _records(spark, path, JUDGEMENT_END).select(
        F.col("number").cast("int").alias("query_id"), F.explode(ids).alias("doc_id"))
