import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom import compare
from rankloom.functions.numbers import normal_below, places, student_two_sided

A = [0.5, 0.4, 0.3, 0.9, 0.2]
B = [0.6, 0.4, 0.1, 0.5, 0.3]


def run(spark, values):
    return spark.createDataFrame(list(enumerate(values, 1)), "query_id int, value double")


def test_known_values(spark):
    a, b = run(spark, A), run(spark, B)
    t = compare(a, b, "t", 0.05).first()
    assert (t.n, t.statistic, t.p_value) == (5, pytest.approx(0.8251369970), pytest.approx(0.4556595400))
    w = compare(a, b, "wilcoxon", 0.5).first()
    assert (w.n, w.statistic, w.p_value) == (5, 5, pytest.approx(0.4184922334))
    assert not t.significant and w.significant


def t_tail(t, nu):
    grid = np.linspace(0, math.atan(abs(t) / math.sqrt(nu)), 20001)
    whole = np.linspace(0, math.pi / 2, 200001)
    return 1 - np.trapezoid(np.cos(grid) ** (nu - 1), grid) / np.trapezoid(np.cos(whole) ** (nu - 1), whole)


def test_student_against_integration(spark):
    cases = [(t, nu) for t in (0.0, 0.3, 1.0, 2.5, 6.0) for nu in (1, 2, 3, 4, 5, 39, 40, 1001)]
    got = spark.createDataFrame(cases, "t double, nu bigint").select(
        "t", "nu", student_two_sided(F.col("t"), F.col("nu")).alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(t_tail(r.t, r.nu), abs=1e-7)


def log_tail(t, nu):
    """log P(|T| >= t) by integrating the density from t on, scaled by its value at t."""
    density = math.lgamma((nu + 1) / 2) - math.lgamma(nu / 2) - 0.5 * math.log(nu * math.pi)
    start = -(nu + 1) / 2 * math.log1p(t * t / nu)
    u = np.linspace(-40, 8, 400_001)  # x = t + e^u
    x = t + np.exp(u)
    inside = np.exp(-(nu + 1) / 2 * np.log1p(x * x / nu) - start + u)
    return math.log(2) + density + start + math.log(np.trapezoid(inside, u))


def test_small_values_are_kept(spark):
    cases = [(t, nu) for t in (3.0, 10.0, 20.0, 30.0) for nu in (5, 100, 1000)] + [(21.0, 10 ** 4), (5.0, 10 ** 4)]
    got = spark.createDataFrame(cases, "t double, nu bigint").select(
        "t", "nu", student_two_sided(F.col("t"), F.col("nu")).alias("p")).collect()
    for r in got:
        assert math.log(r.p) == pytest.approx(log_tail(r.t, r.nu), abs=2e-8), (r.t, r.nu)


def test_many_degrees_of_freedom_come_near_the_normal(spark):
    got = spark.createDataFrame([(t, nu) for t in (0.5, 1.0, 2.0, 6.0) for nu in (10 ** 6, 10 ** 7)],
                                "t double, nu bigint").select(
        "t", "nu", student_two_sided(F.col("t"), F.col("nu")).alias("p")).collect()
    for r in got:
        x = r.t  # first term of the expansion around the normal tail
        near = math.erfc(x / math.sqrt(2)) + 2 * (x ** 3 + x) / (4 * r.nu) * math.exp(-x * x / 2) / math.sqrt(2 * math.pi)
        assert r.p == pytest.approx(near, rel=1e-9)


def test_normal(spark):
    xs = [-30.0, -8.0, -5.0, -3.0, -2.9999, -1.96, -0.5, 0.0, 0.5, 2.0, 3.5, 9.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(
        "x", normal_below(F.col("x")).alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(0.5 * math.erfc(-r.x / math.sqrt(2)), rel=1e-9, abs=1e-300)


def wilcoxon_plain(a, b):
    d = [round(y - x, 9) for x, y in zip(a, b)]
    order = sorted(abs(x) for x in d)
    rank = {v: sum(i for i, x in enumerate(order, 1) if x == v) / order.count(v) for v in order}
    n, up = len(d), sum(rank[abs(x)] for x in d if x > 0)
    low = min(up, n * (n + 1) / 2 - up)
    z = (low - n * (n + 1) / 4 - 0.5) / math.sqrt(n * (n + 1) * (2 * n + 1) / 24)
    return low, math.erfc(-z / math.sqrt(2))


def test_many_pairs_at_once(spark):
    rng = np.random.default_rng(3)
    data = {p: (rng.integers(0, 6, 30 + p) / 10, rng.integers(0, 7, 30 + p) / 10) for p in range(5)}
    table = lambda i: spark.createDataFrame(
        [(p, q, float(v)) for p, runs in data.items() for q, v in enumerate(runs[i])],
        "pair_id int, query_id int, value double")
    got = {r.pair_id: r for r in compare(table(0), table(1), "wilcoxon", 0.05, ["pair_id"]).collect()}
    for p, (a, b) in data.items():
        low, p_value = wilcoxon_plain(a, b)
        assert got[p].statistic == pytest.approx(low) and got[p].p_value == pytest.approx(p_value)
    ts = {r.pair_id: r for r in compare(table(0), table(1), "t", 0.05, ["pair_id"]).collect()}
    for p, (a, b) in data.items():
        d = a - b
        t = d.mean() / math.sqrt(d.var(ddof=1) / len(d))
        assert ts[p].statistic == pytest.approx(t)
        assert ts[p].p_value == pytest.approx(t_tail(t, len(d) - 1), abs=1e-6)


def test_one_pair_is_ranked_in_many_tasks(spark):
    rng = np.random.default_rng(4)
    a, b = rng.random(3000), rng.random(3000)
    got = compare(run(spark, a.tolist()), run(spark, b.tolist()), "wilcoxon", 0.05).first()
    d = np.round(b - a, 9)
    ranks = np.argsort(np.argsort(np.abs(d))) + 1
    up = float(ranks[d > 0].sum())
    assert got.statistic == pytest.approx(min(up, 3000 * 3001 / 2 - up))


def test_equal_and_shifted_runs(spark):
    a = run(spark, [0.5, 0.25, 0.75])
    same = compare(a, a, "t", 0.05).first()
    assert same.p_value is None and not same.significant
    shifted = compare(a, run(spark, [0.75, 0.5, 1.0]), "t", 0.05).first()
    assert shifted.statistic == float("-inf") and shifted.p_value == 0 and shifted.significant


def test_misuse(spark):
    a, b = run(spark, A), run(spark, B)
    for test, alpha in (("t", -1), ("sign", 0.05), ("t", None)):
        with pytest.raises(ValueError):
            compare(a, b, test, alpha)
    with pytest.raises(Exception, match="only one run has query"):
        compare(a, run(spark, B[:4]), "t", 0.05).collect()
    twice = a.unionByName(a.filter("query_id = 2"))
    for x, y in ((twice, b), (b, twice), (twice, twice)):
        for test in ("t", "wilcoxon"):
            with pytest.raises(Exception, match="a run repeats query 2"):
                compare(x, y, test, 0.05).count()
    with pytest.raises(Exception, match="at least"):
        compare(run(spark, A[:1]), run(spark, B[:1]), "t", 0.05).collect()
    with pytest.raises(Exception, match="at least"):
        compare(run(spark, []), run(spark, []), "wilcoxon", 0.05).collect()


def test_places(spark):
    row = spark.createDataFrame([(1.0000005, float("nan"), -0.4)], "a double, b double, c double").select(
        places(F.col("a")).alias("a"), places(F.col("b")).alias("b"), places(F.col("c"), 0).alias("c")).first()
    assert row.a == pytest.approx(1.000001, abs=1e-9) or row.a == 1.0
    assert math.isnan(row.b) and row.c == 0
