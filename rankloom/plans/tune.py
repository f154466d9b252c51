"""Choose a smoothing parameter on training queries, report it on test queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom import cluster
from rankloom.functions.models import Model
from rankloom.functions.numbers import places
from rankloom.operators.metrics import metric_column, metrics, mean_value, relevant_counts
from rankloom.operators.search import flag_relevant, query_side, scored_rows, top_k
from rankloom.operators.terms import select_queries
from rankloom.plans.evaluate import evaluate
from rankloom.sources.index import Index

# The parameters a sweep tries.
SWEEPS = {
    "jm": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
    "dir": [0.0, 500.0, 1000.0, 1500.0, 2000.0, 2500.0, 3000.0, 3500.0, 4000.0, 4500.0, 5000.0],
}
LABELS = {"jm": "lambda", "dir": "mu"}
# The more varied key first: sorting compares it first.
KEYS = ("query_id", "param")


def _params(kind: str) -> list[float]:
    if kind not in SWEEPS:
        raise ValueError(f"a sweep is over jm or dir, not {kind!r}")
    return SWEEPS[kind]


def sweep_rankings(index: Index, queries: DataFrame, kind: str, k: int) -> DataFrame:
    """The ranking of every query under every parameter, from one pass over the matches.

    A document's scores under all parameters are summed side by side; only the sums,
    not the matches, are laid out as one row per parameter, and of many matches only the
    sums that some ranking can hold.
    """
    params = _params(kind)
    rows = scored_rows(query_side(index, queries), [Model(kind, p) for p in params], params, k, KEYS[:1])
    return top_k(rows.withColumnRenamed("label", "param"), k, KEYS)


def sweep(index: Index, queries: DataFrame, qrels: DataFrame, kind: str, cut: int,
          metric: str) -> DataFrame:
    """``(param, query_id, value)``; queries without judgements are included."""
    column = metric_column(metric)
    asked = queries.select("query_id", F.explode(F.array(*map(F.lit, _params(kind)))).alias("param"))
    flagged = flag_relevant(sweep_rankings(index, queries, kind, cut), qrels)
    table = metrics(asked, flagged, relevant_counts(qrels), KEYS, "include")
    return table.select("param", "query_id", F.col(column).alias("value"))


def best_param(swept: DataFrame) -> DataFrame:
    """The parameter with the highest mean, the first of equals; no row if no mean is positive."""
    means = mean_value(swept, ["param"]).filter(~F.isnan("mean") & (F.col("mean") > 0))
    # equal values may be summed in another order: compare without the last bits
    return (means.withColumn("mean", places(F.col("mean"), 9))
            .orderBy(F.desc("mean"), "param").limit(1))


def sweep_table(swept: DataFrame, kind: str) -> DataFrame:
    """A row per query and a column per parameter, then the means in the row ``mean``."""
    params = _params(kind)
    wide = swept.groupBy("query_id").pivot("param", params).agg(F.first("value"))
    names = [f"{LABELS[kind]}_{p:g}".replace(".", "_") for p in params]
    wide = wide.toDF("query_id", *names)
    return (wide.rollup("query_id").agg(*(F.avg(n).alias(n) for n in names))
            .select(F.coalesce(F.col("query_id").cast("string"), F.lit("mean")).alias("query"),
                    *names))


@dataclass(frozen=True)
class TrainTest:
    best: float
    swept: DataFrame
    results: DataFrame


def train_test(index: Index, queries: DataFrame, qrels: DataFrame, kind: str, cut: int,
               metric: str, train: str, test: str) -> TrainTest:
    """Tune on the range ``train``, evaluate the best parameter on the range ``test``."""
    swept = cluster.materialise(
        sweep(index, select_queries(queries, train), qrels, kind, cut, metric))
    best = best_param(swept).collect()
    if not best:
        raise ValueError("no parameter has a positive mean on the training queries")
    results = evaluate(index, select_queries(queries, test), qrels, Model(kind, best[0].param),
                       cut, metric, on_empty="include")
    return TrainTest(best[0].param, swept, results)


def test_report(outcome: TrainTest) -> DataFrame:
    """Best parameter, value per test query, and the row ``mean``."""
    return outcome.results.rollup("query_id").agg(F.avg("value").alias("value")).select(
        F.lit(outcome.best).alias("best_param"),
        F.coalesce(F.col("query_id").cast("string"), F.lit("mean")).alias("query"), "value")
