"""E5: rank a query set and score it against judgements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.models import Model
from rankloom.operators.metrics import metric_column, metrics, relevant_counts
from rankloom.operators.search import flag_relevant, search
from rankloom.sources.index import Index


def evaluate_ranking(ranking: DataFrame, queries: DataFrame, qrels: DataFrame, cut: int,
                     on_empty: str = "skip") -> DataFrame:
    """All three metrics of the best ``cut`` documents per query."""
    flagged = flag_relevant(ranking.filter(F.col("rank") <= cut), qrels)
    return metrics(queries, flagged, relevant_counts(qrels), on_empty=on_empty)


def evaluate(index: Index, queries: DataFrame, qrels: DataFrame, model: Model, cut: int,
             metric: str, on_empty: str = "skip") -> DataFrame:
    """``(query_id, value)``; A6's ``mean_value`` of it is the run's figure."""
    column = metric_column(metric)
    table = evaluate_ranking(search(index, queries, model, cut), queries, qrels, cut, on_empty)
    return table.select("query_id", F.col(column).alias("value"))
