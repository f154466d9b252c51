"""Rounds of manual relevance feedback, all ranked in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom import cluster
from rankloom.functions.models import Model
from rankloom.operators.metrics import first_relevant, metric_column, metrics, relevant_counts
from rankloom.operators.search import flag_relevant, search, stored_documents
from rankloom.sources.index import Index

KEYS = ("query_id", "round")


def taken_documents(flagged: DataFrame) -> DataFrame:
    """``(query_id, doc_id, taken_round)``: the first relevant document of every round, each once.

    A round takes its best-ranked relevant document that no earlier round took, so
    the rounds of a query are folded in order. A round brings at most its cut of hits.
    """
    hits = (flagged.filter("relevant").groupBy(*KEYS)
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))),
                             lambda h: h["doc_id"]).alias("hits"))
            .groupBy("query_id")
            .agg(F.array_sort(F.collect_list(F.struct("round", "hits"))).alias("rounds")))
    none = F.array().cast("array<struct<taken_round:int,doc_id:bigint>>")

    def take(taken, this):
        left = F.array_except(this["hits"], F.transform(taken, lambda t: t["doc_id"]))
        entry = F.struct(this["round"].alias("taken_round"),
                         F.try_element_at(left, F.lit(1)).alias("doc_id"))
        return F.when(F.size(left) > 0, F.concat(taken, F.array(entry))).otherwise(taken)

    return hits.select("query_id", F.inline(F.aggregate("rounds", none, take))).select(
        "query_id", "doc_id", "taken_round")


def feedback(index: Index, rounds: DataFrame, qrels: DataFrame, model: Model, cut: int,
             metric: str, residual: bool = False, on_empty: str = "error") -> DataFrame:
    """the metric and first relevant document of every round of every query.

    ``rounds(query_id, round, text)`` holds the original query and its reformulations.
    With ``residual`` (F2) the first relevant document of a round leaves the judged set
    of the later ones, though not their rankings; a query ends when its set is empty.
    A query without any judgement is an error by default, or left out (``skip``).
    """
    column = metric_column(metric)
    if on_empty not in ("error", "skip"):
        raise ValueError(f"on_empty must be error or skip, not {on_empty!r}")
    rounds = rounds.withColumn("round", F.col("round").cast("int"))
    ranking = search(index, rounds, model, cut, KEYS)
    # at most cut rows per round, read by both the fold and the metrics
    flagged = cluster.materialise(flag_relevant(ranking, qrels))
    asked = rounds.select(*KEYS).distinct()
    judged = asked.join(relevant_counts(qrels), "query_id", "left" if on_empty == "error" else "inner")
    if on_empty == "error":
        judged = judged.withColumn("n_relevant", F.coalesce("n_relevant", F.raise_error(F.concat(
            F.lit("no relevant document for query "), "query_id")).cast("bigint")))
    if residual:
        taken = taken_documents(flagged)
        flagged = (flagged.join(taken, ["query_id", "doc_id"], "left")
                   .withColumn("relevant", F.col("relevant") & (
                       F.col("taken_round").isNull() | (F.col("taken_round") >= F.col("round"))))
                   .drop("taken_round"))
        earlier = (asked.join(taken, "query_id").filter(F.col("taken_round") < F.col("round"))
                   .groupBy(*KEYS).agg(F.count("*").alias("n_taken")))
        judged = (judged.join(earlier, list(KEYS), "left").fillna(0, ["n_taken"])
                  .select(*KEYS, (F.col("n_relevant") - F.col("n_taken")).alias("n_relevant"))
                  .filter(F.col("n_relevant") > 0))
    judged = judged.select(*KEYS, "n_relevant")
    values = metrics(judged, flagged, judged, KEYS, "skip")
    return values.select(*KEYS, "n_relevant", F.col(column).alias("value")).join(
        first_relevant(judged, flagged, KEYS), list(KEYS))


def with_contents(index: Index, rounds: DataFrame) -> DataFrame:
    """Adds the text of every round's first relevant document."""
    rounds = cluster.materialise(rounds)
    shown = rounds.filter(F.col("first_doc_key").isNotNull()).select(
        *KEYS, F.col("first_doc_key").alias("doc_key"))
    texts = stored_documents(index, shown).select(*KEYS, F.col("contents").alias("first_contents"))
    return rounds.join(texts, list(KEYS), "left")
