"""Student t probabilities for the handful of rows a test ends with.

Spark has no t distribution. The incomplete beta function is evaluated with its
continued fraction, on result rows only (one or two), through a pandas UDF.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

# Send these functions to the executors whole: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, modified Lentz evaluation."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    value = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return value
    raise ArithmeticError("incomplete beta did not converge")


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta function."""
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    front = math.exp(log_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


# From here on the normal tail with two correction terms is exact to 1e-14; the beta
# function would lose digits in differences of huge logarithms.
MANY = 1e5


def two_sided_p(t: float, df: float) -> float:
    """Chance of a value at least as far from 0 as ``t``."""
    if df >= MANY:
        t = abs(t)
        bell = math.exp(-0.5 * t * t) / math.sqrt(2.0 * math.pi)
        first = t * (t * t + 1.0) / (4.0 * df)
        second = t * (3.0 * t**6 - 7.0 * t**4 - 5.0 * t * t - 3.0) / (96.0 * df * df)
        return min(1.0, max(0.0, math.erfc(t / math.sqrt(2.0)) + 2.0 * bell * (first + second)))
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def critical_value(confidence: float, df: float) -> float:
    """The t whose two-sided tail is ``1 - confidence``, by bisection."""
    low, high = 0.0, 1.0
    while two_sided_p(high, df) > 1.0 - confidence:
        high *= 2.0
    for _ in range(200):
        middle = (low + high) / 2.0
        if middle in (low, high):
            break
        if two_sided_p(middle, df) > 1.0 - confidence:
            low = middle
        else:
            high = middle
    return (low + high) / 2.0


def _defined(*values: float) -> bool:
    return all(v is not None and math.isfinite(v) for v in values)


@pandas_udf(DoubleType())
def t_two_sided_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(
        [two_sided_p(a, b) if _defined(a, b) and b > 0 else None for a, b in zip(t, df)],
        dtype="float64",
    )


@pandas_udf(DoubleType())
def t_critical(confidence: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(
        [critical_value(a, b) if _defined(a, b) and b > 0 else None for a, b in zip(confidence, df)],
        dtype="float64",
    )
