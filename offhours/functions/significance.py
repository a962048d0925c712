"""Two-sided p-value of a t statistic.

Spark has no t distribution. The frames this runs on hold one row per grid
point, and rows are independent, so a small vectorised helper is enough.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    result = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = 1.0
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            step = c * d
            result *= step
        if abs(step - 1.0) < 1e-15:
            break
    return result


def _beta_ratio(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0 or x >= 1.0:
        return min(max(x, 0.0), 1.0)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def two_sided_p(t: float, freedom: float) -> float | None:
    if t is None or freedom is None or math.isnan(t) or not freedom > 0:
        return None
    if math.isinf(t):
        return 0.0
    return _beta_ratio(freedom / 2.0, 0.5, freedom / (freedom + t * t))


def p_value(t: Column | str, freedom: Column | str) -> Column:
    """Two-sided p-value of ``t`` at ``freedom`` degrees of freedom."""

    @F.pandas_udf("double")
    def vectorised(t: pd.Series, freedom: pd.Series) -> pd.Series:
        return pd.Series([two_sided_p(a, b) for a, b in zip(t, freedom)], dtype="float64")

    return vectorised(t, freedom)
