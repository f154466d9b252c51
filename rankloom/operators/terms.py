"""A1-A4 over a document table, P2 and P3 over a query table."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import quantised_length, tokens


def exploded_tokens(table: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """One row per word, with the word count of its text as ``n_tokens``."""
    words = table.select(*keys, tokens(text).alias("words"))
    # The outer form drops nothing by itself: the plain explode would be guarded by
    # an inferred filter that runs the word pattern over every text again.
    return (words.select(*keys, F.size("words").alias("n_tokens"),
                         F.explode_outer("words").alias("term"))
            .filter(F.col("term").isNotNull()))


def term_frequencies(docs: DataFrame, keys: Sequence[str] = ("doc_id",),
                     text: str = "contents") -> DataFrame:
    """A1: ``(keys, doc_len, term) -> tf``.

    Needs no shuffle when ``docs`` is already spread by one of ``keys``, as an
    index's document table is; else words are counted before they are moved.
    """
    words = exploded_tokens(docs, keys, text)
    counted = words.groupBy(*keys, "n_tokens", "term").agg(F.count("*").cast("int").alias("tf"))
    return counted.select(*keys, quantised_length(F.col("n_tokens")).alias("doc_len"), "term", "tf")


def doc_lengths(docs: DataFrame, keys: Sequence[str] = ("doc_id",),
                text: str = "contents") -> DataFrame:
    """A2: exact and quantised length of every document."""
    sized = docs.select(*keys, F.size(tokens(text)).alias("n_tokens"))
    return sized.withColumn("doc_len", quantised_length(F.col("n_tokens")))


def term_stats(postings: DataFrame) -> DataFrame:
    """A3: documents holding each term, and its occurrences."""
    return postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("ctf"))


def bounded_term_stats(postings: DataFrame) -> DataFrame:
    """A3 with the extremes of a term's postings, from which models bound what it can score."""
    return postings.groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("ctf"), F.max("tf").alias("max_tf"),
        F.min("doc_len").alias("min_len"), F.max(F.col("tf") / F.col("doc_len")).alias("max_share"))


def collection_stats(lengths: DataFrame) -> DataFrame:
    """A4: one row from A2's table."""
    return lengths.agg(F.count_if(F.col("n_tokens") > 0).alias("doc_count"),
                       F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("total_terms"))


def query_terms(queries: DataFrame, keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """``(keys, term) -> qtf``; a repeated word counts as often as it occurs."""
    words = exploded_tokens(queries, keys, "text")
    return words.groupBy(*keys, "term").agg(F.count("*").cast("int").alias("qtf"))


def select_queries(queries: DataFrame, which: str) -> DataFrame:
    """``"all"``, one number as ``"5"``, or an inclusive range as ``"1-20"``.

    A number or range without any query is an error.
    """
    if which == "all":
        return queries
    parts = re.fullmatch(r"(\d+)(?:-(\d+))?", which)
    if not parts:
        raise ValueError(f"queries must be all, N or A-B, not {which!r}")
    first = int(parts[1])
    chosen = queries.filter(F.col("query_id").between(first, int(parts[2] or first)))
    if chosen.isEmpty():
        raise ValueError(f"there is no query {which}")
    return chosen
