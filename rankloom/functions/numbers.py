"""Rounding that two engines agree on, and the two distributions behind the tests."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def places(value: Column, digits: int = 6) -> Column:
    """Half-up rounding through a whole number, so equal results are equal bits. NaN stays NaN."""
    scale = 10.0 ** digits
    rounded = F.floor(value * F.lit(scale) + 0.5) / F.lit(scale)
    return F.when(F.isnan(value), F.lit(float("nan"))).otherwise(rounded)


def not_a_number() -> Column:
    return F.lit(float("nan"))


def _fold(upto: Column, start: Column, step) -> Column:
    """Sum of a series whose next element is ``step(element, k)`` for k = 1 .. ``upto``."""
    first = F.struct(start.alias("term"), start.alias("total"))
    steps = F.when(upto < 1, F.array().cast("array<bigint>")).otherwise(
        F.sequence(F.lit(1).cast("bigint"), upto.cast("bigint")))

    def add(state, k):
        term = step(state["term"], k.cast("double"))
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    return F.aggregate(steps, first, add)["total"]


def normal_below(z: Column) -> Column:
    """Standard normal distribution function."""
    x = F.abs(z)
    density = F.exp(-x * x / 2.0) / F.lit(math.sqrt(2.0 * math.pi))
    # near the middle: power series; in the tail: continued fraction, which keeps small values exact
    middle = 0.5 - density * _fold(F.lit(60), x, lambda term, k: term * x * x / (2.0 * k + 1.0))
    fraction = F.aggregate(F.sequence(F.lit(120), F.lit(1), F.lit(-1)), F.lit(0.0),
                           lambda acc, k: k.cast("double") / (x + acc))
    upper = F.when(x < 3.0, middle).otherwise(density / (x + fraction))
    return F.when(z > 0, 1.0 - upper).otherwise(upper)


# Steps by which the argument of the gamma ratio is raised before its series is used.
GAMMA_STEPS = 24


def _log_gamma_ratio(z: Column) -> Column:
    """log(gamma(z) / gamma(z + 1/2)) by its asymptotic series, far enough up."""
    raised = sum((F.log1p(0.5 / (z + float(k))) for k in range(GAMMA_STEPS)), F.lit(0.0))
    y = z + float(GAMMA_STEPS)
    series = 1.0 / (8.0 * y) - 1.0 / (192.0 * y * y * y) + 1.0 / (640.0 * F.pow(y, F.lit(5.0)))
    return raised - 0.5 * F.log(y) + series


def _beta_fraction(x: Column, a: Column, b: Column, steps: Column) -> Column:
    """The continued fraction of the incomplete beta function, from its end."""
    def back(acc, k):
        m = F.floor(k / 2).cast("double")
        even = m * (b - m) * x / ((a + 2.0 * m - 1.0) * (a + 2.0 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2.0 * m) * (a + 2.0 * m + 1.0))
        return 1.0 + F.when(k % 2 == 0, even).otherwise(odd) / acc

    return 1.0 / F.aggregate(F.sequence(steps, F.lit(1), F.lit(-1)), F.lit(1.0), back)


def student_two_sided(t: Column, freedom: Column) -> Column:
    """P(|T| >= |t|): the incomplete beta function at nu / (nu + t^2), by continued fraction.

    Its side that converges is evaluated; for large |t| that is the tail itself, so small
    values are not differences of large ones.
    """
    nu = freedom.cast("double")
    half, other = nu / 2.0, F.lit(0.5)
    r = t * t / nu
    x, rest = 1.0 / (1.0 + r), r / (1.0 + r)
    steps = (100 + 8 * F.ceil(F.sqrt(nu))).cast("int")
    # x^a (1-x)^b / beta(a, b), as a logarithm
    front = -half * F.log1p(r) + 0.5 * F.log(rest) - (_log_gamma_ratio(half) + 0.5 * math.log(math.pi))
    tail = F.exp(front) / half * _beta_fraction(x, half, other, steps)
    middle = 1.0 - F.exp(front) / 0.5 * _beta_fraction(rest, other, half, steps)
    direct = x < (half + 1.0) / (half + 2.5)
    # no t, no p; an endless t leaves nothing outside
    return (F.when(t.isNull(), F.lit(None).cast("double"))
            .when(F.abs(t) == float("inf"), F.lit(0.0)).when(t == 0, F.lit(1.0))
            .when(direct, tail).otherwise(middle))
