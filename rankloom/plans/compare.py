"""Whether two runs differ significantly, for any number of pairs at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.numbers import normal_below, places, student_two_sided

TESTS = ("t", "wilcoxon")
# Sizes of differences that are ranked together; differences keep nine places.
BIN = 1e-4


def paired(run_a: DataFrame, run_b: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by, query_id, a, b)``; a query that is not in either run once is an error."""
    keys = [*by, "query_id"]
    sides = [run.select(*keys, F.lit(side).alias("side"), "value") for side, run in (("a", run_a), ("b", run_b))]
    lines = sides[0].unionByName(sides[1])

    def of(side: str) -> list:
        own = F.col("side") == side
        return [F.count_if(own).alias(f"n_{side}"), F.max(F.when(own, F.col("value"))).alias(side)]

    both = lines.groupBy(*keys).agg(*of("a"), *of("b"))
    wrong = (F.when((F.col("n_a") == 0) | (F.col("n_b") == 0), F.lit("only one run has query "))
             .otherwise(F.lit("a run repeats query ")))
    complete = (F.col("n_a") == 1) & (F.col("n_b") == 1)
    # a filter, as an unused column would be optimised away
    return both.filter(F.when(complete, True).otherwise(F.raise_error(
        F.concat(wrong, F.col("query_id").cast("string"))).cast("boolean"))).select(*keys, "a", "b")


def _enough(pairs: DataFrame, least: int) -> DataFrame:
    short = F.raise_error(F.lit(f"a test needs at least {least} paired values")).cast("bigint")
    return pairs.withColumn("n", F.when(F.col("n") < least, short).otherwise(F.col("n")))


def paired_t(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Q1: ``(by, n, statistic, p_value)``; p is null when every difference is 0."""
    d = F.col("a") - F.col("b")
    sums = pairs.groupBy(*by).agg(F.count("*").alias("n"), F.avg(d).alias("mean"),
                                  F.min(d).alias("low"), F.max(d).alias("high"),
                                  F.var_samp(d).alias("variance"))
    sums = _enough(sums, 2)
    error = F.sqrt(F.col("variance") / F.col("n"))
    t = (F.when(F.col("low") < F.col("high"), F.col("mean") / error)
         .when(F.col("mean") == 0, F.lit(None))
         .otherwise(F.signum("mean") * F.lit(float("inf"))))
    return (sums.select(*by, "n", t.alias("statistic"))
            .withColumn("p_value", student_two_sided(F.col("statistic"), F.col("n") - 1)))


def wilcoxon(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Q2: ``(by, n, statistic, p_value)`` by the normal approximation.

    Zero differences keep their rank and count to the negative side. Pairs are first
    counted per size of difference. Sizes fall into bins, each ranked by itself and from where
    the bins below it end: a bin holds at most ``BIN`` / 1e-9 sizes however many pairs there are, and
    measures between 0 and 1 fill at most 1 / ``BIN`` bins. All of it is one job.
    """
    d = places(F.col("b") - F.col("a"), 9)
    sizes = (pairs.select(*by, d.alias("d"))
             .groupBy(*by, F.abs("d").alias("size"))
             .agg(F.count("*").alias("n"), F.count_if(F.col("d") > 0).alias("n_up"))
             .withColumn("bin", F.when(F.isnan("size"), F.lit((1 << 63) - 1)).otherwise(F.floor(F.col("size") / BIN))))
    counts = sizes.groupBy(*by, "bin").agg(F.sum("n").alias("n_bin"))
    before = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, "bin", F.coalesce(F.sum("n_bin").over(before), F.lit(0)).alias("start"))
    upto = Window.partitionBy(*by, "bin").orderBy("size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # equal sizes share the mean of the ranks they fill
    ranked = (sizes.withColumn("inside", F.sum("n").over(upto)).join(starts, [*by, "bin"])
              .withColumn("rank", F.col("start") + F.col("inside") - (F.col("n") - 1) / 2.0))
    sums = ranked.groupBy(*by).agg(F.sum("n").alias("n"),
                                   F.sum(F.col("n_up") * F.col("rank")).alias("up"))
    n = F.col("n").cast("double")
    low = F.least(F.col("up"), n * (n + 1.0) / 2.0 - F.col("up"))
    z = (low - n * (n + 1.0) / 4.0 - 0.5) / F.sqrt(n * (n + 1.0) * (2.0 * n + 1.0) / 24.0)
    return (_enough(sums.fillna(0, ["n"]), 1)
            .select(*by, "n", low.alias("statistic"), (2.0 * normal_below(z)).alias("p_value")))


def compare(run_a: DataFrame, run_b: DataFrame, test: str, alpha: float,
            by: Sequence[str] = ()) -> DataFrame:
    """Q3: the test's row per pair of runs, with ``significant`` when p is at most ``alpha``."""
    if test not in TESTS:
        raise ValueError(f"test must be t or wilcoxon, not {test!r}")
    if alpha is None or alpha < 0:
        raise ValueError("alpha must be 0 or more")
    outcome = (paired_t if test == "t" else wilcoxon)(paired(run_a, run_b, by), by)
    return outcome.withColumn(
        "significant", F.coalesce(F.col("p_value") <= F.lit(alpha), F.lit(False)))
