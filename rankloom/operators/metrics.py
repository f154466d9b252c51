"""E1-E4, A6 and T2 over a flagged ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.numbers import not_a_number

METRICS = {"P": "precision", "R": "recall", "MAP": "average_precision"}
ON_EMPTY = ("skip", "include", "error")


def metric_column(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"metric must be P, R or MAP, not {metric!r}")
    return METRICS[metric]


def relevant_counts(qrels: DataFrame) -> DataFrame:
    return (qrels.select("query_id", "doc_id").distinct()
            .groupBy("query_id").agg(F.count("*").alias("n_relevant")))


def metrics(asked: DataFrame, flagged: DataFrame, counts: DataFrame,
            keys: Sequence[str] = ("query_id",), on_empty: str = "skip") -> DataFrame:
    """Precision, recall and average precision per ``keys``, in one pass.

    ``asked`` lists every key to report, so a query that retrieved nothing stays;
    ``counts`` holds the size of the judged set per key or per query. ``on_empty``
    says what to do with a key without judgements: skip it, include it, or fail.
    """
    if on_empty not in ON_EMPTY:
        raise ValueError(f"on_empty must be one of {ON_EMPTY}, not {on_empty!r}")
    upto = Window.partitionBy(*keys).orderBy("rank").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    hit = F.col("relevant").cast("int")
    per_key = (flagged.withColumn("so_far", F.sum(hit).over(upto))
               .groupBy(*keys).agg(
                   F.count("*").alias("n_retrieved"), F.sum(hit).alias("n_hits"),
                   F.sum(F.when(F.col("relevant"), F.col("so_far") / F.col("rank")))
                   .alias("precisions")))
    count_keys = [k for k in keys if k in counts.columns]
    table = (asked.select(*keys)
             .join(counts, count_keys, "inner" if on_empty == "skip" else "left")
             .join(per_key, list(keys), "left")
             .fillna(0, ["n_relevant", "n_retrieved", "n_hits"]).fillna(0.0, ["precisions"]))
    if on_empty == "skip":
        table = table.filter(F.col("n_relevant") > 0)
    if on_empty == "error":
        # a filter, as a column that nobody selects would be optimised away
        table = table.filter(F.when(F.col("n_relevant") > 0, True).otherwise(F.raise_error(
            F.concat(F.lit("no relevant document for query "), "query_id")).cast("boolean")))
    hits, judged = F.col("n_hits"), F.col("n_relevant")
    return table.select(
        *keys, "n_retrieved", "n_hits", "n_relevant",
        F.when(F.col("n_retrieved") > 0, hits / F.col("n_retrieved"))
        .otherwise(not_a_number()).alias("precision"),
        F.when(judged > 0, hits / judged).otherwise(F.lit(1.0)).alias("recall"),
        F.when(judged > 0, F.col("precisions") / judged)
        .otherwise(not_a_number()).alias("average_precision"))


def mean_value(values: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of ``value``; an empty query set is an error."""
    if keys:
        return values.groupBy(*keys).agg(F.avg("value").alias("mean"))
    whole = values.agg(F.count("*").alias("n"), F.avg("value").alias("mean"))
    return whole.select(
        F.when(F.col("n") == 0, F.raise_error("no query to average over").cast("double"))
        .otherwise(F.col("mean")).alias("mean"))


def first_relevant(asked: DataFrame, flagged: DataFrame,
                   keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """The best-ranked relevant document per key, or nulls when there is none."""
    fields = ("rank", "score", "doc_id", "batch_id", "doc_key")
    best = (flagged.filter("relevant").groupBy(*keys)
            .agg(F.min_by(F.struct(*fields), "rank").alias("best")))
    return (asked.select(*keys).join(best, list(keys), "left")
            .select(*keys, *(F.col(f"best.{f}").alias(f"first_{f}") for f in fields)))
