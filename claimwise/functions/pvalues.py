"""Tail probabilities of the F distribution.

Applied to result tables with one row per feature, never to data rows. Spark
has no incomplete beta function, hence the Arrow-batched helper; the method is
the usual continued fraction evaluated by Lentz's algorithm.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType

# Executors need not have this package installed: the helper travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _beta_fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 20000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            factor = c * d
            value *= factor
        if abs(factor - 1.0) < 1e-15:
            return value
    raise ArithmeticError(f"continued fraction has not settled for a={a}, b={b}, x={x}")


def upper_gamma(b: float, y: float) -> float:
    """Regularised upper incomplete gamma function Q(b, y)."""
    if y <= 0:
        return 1.0
    front = math.exp(b * math.log(y) - y - math.lgamma(b))
    if y < b + 1:
        term = total = 1.0 / b
        for m in range(1, 100_000):
            term *= y / (b + m)
            total += term
            if term < total * 1e-17:
                return 1.0 - front * total
    else:
        tiny = 1e-300
        d = 1.0 / (y + 1 - b)
        c, value = 1.0 / tiny, d
        for m in range(1, 100_000):
            step = -m * (m - b)
            d = step * d + y + 2 * m + 1 - b
            c = y + 2 * m + 1 - b + step / c
            d, c = 1.0 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            value *= c * d
            if abs(c * d - 1.0) < 1e-15:
                return front * value
    raise ArithmeticError(f"incomplete gamma function has not settled for b={b}, y={y}")


def _log_inverse_beta(a: float, b: float) -> float:
    """log of 1 / B(a, b), without cancellation when one argument is large."""
    small, large = min(a, b), max(a, b)
    if large < 1e4:
        return math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    growth = (small * math.log(large) + (large + small - 0.5) * math.log1p(small / large) - small
              + (1.0 / (large + small) - 1.0 / large) / 12.0)
    return growth - math.lgamma(small)


def incomplete_beta(a: float, b: float, odds: float) -> float:
    """Regularised incomplete beta function I_x(a, b) at x = 1 / (1 + odds)."""
    if math.isinf(odds):
        return 0.0
    if odds <= 0.0:
        return 1.0
    if a > 1e6 * max(1.0, b):
        # with N = a + (b - 1) / 2 the relative error is of the order of b^3 / N^2
        return upper_gamma(b, (a + (b - 1.0) / 2.0) * math.log1p(odds))
    x, rest = 1.0 / (1.0 + odds), odds / (1.0 + odds)
    front = math.exp(_log_inverse_beta(a, b) - a * math.log1p(odds) + b * math.log(rest))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, rest) / b


def f_tail(f: float | None, d1: float | None, d2: float | None) -> float | None:
    """P(F >= f) with (d1, d2) degrees of freedom; missing when undefined."""
    if f is None or d1 is None or d2 is None or math.isnan(f) or math.isnan(d1) or math.isnan(d2):
        return None
    if d1 <= 0 or d2 <= 0:
        return None
    return incomplete_beta(d2 / 2.0, d1 / 2.0, d1 * f / d2)


@F.pandas_udf(DoubleType())
def _f_tail(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([f_tail(*row) for row in zip(f, d1, d2)], dtype="float64")


def f_survival(f: Column, d1: Column, d2: Column) -> Column:
    """Upper tail of the F distribution as a column."""
    p = _f_tail(f.cast("double"), d1.cast("double"), d2.cast("double"))
    return F.when(~F.isnan(p), p)


def correlation_p(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation by the t statistic with n - 2 degrees."""
    freedom = n.cast("double") - 2.0
    f = F.when(F.abs(r) >= 1.0, F.lit(float("inf"))).otherwise(r * r * freedom / (1.0 - r * r))
    return f_survival(f, F.lit(1.0), freedom)
