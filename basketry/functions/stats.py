"""Tail probabilities for one-row test results."""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Workers get these functions with the job and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def normal_upper_tail(z: float) -> float:
    """P(Z > z) for a standard normal Z."""
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function, run to convergence."""
    tiny = 1e-300
    c, d, value, m = 1.0, 0.0, 1.0, 0
    while True:
        if m == 0:
            terms = (1.0, -(a + b) * x / (a + 1.0))
        else:
            terms = (m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0)))
        change = 1.0
        for term in terms[1 if m == 0 else 0:]:
            d = 1.0 + term * d
            c = 1.0 + term / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            change *= c * d
            value *= c * d
        m += 1
        if abs(change - 1.0) < 1e-16:
            return 1.0 / value


def _stirling_rest(z: float) -> float:
    """lgamma(z) without the leading terms of Stirling's series, for z of 30 or more."""
    return (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * z * z)) / (z * z)) / (z * z)) / z


def _lgamma_step(a: float, b: float) -> float:
    """lgamma(a + b) - lgamma(a) without the loss of digits of large a."""
    if a < 30.0:
        return math.lgamma(a + b) - math.lgamma(a)
    return ((a + b - 0.5) * math.log1p(b / a) + b * math.log(a) - b
            + _stirling_rest(a + b) - _stirling_rest(a))


def incomplete_beta(a: float, b: float, x: float, rest: float | None = None) -> float:
    """The regularised incomplete beta function; `rest` is 1 - x where known more exactly."""
    rest = 1.0 - x if rest is None else rest
    if x <= 0.0:
        return 0.0
    if rest <= 0.0:
        return 1.0
    log_x = math.log(x) if x < 0.5 else math.log1p(-rest)
    log_rest = math.log(rest) if rest < 0.5 else math.log1p(-x)
    log_front = _lgamma_step(a, b) - math.lgamma(b) + a * log_x + b * log_rest
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(log_front) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(log_front) * _beta_fraction(b, a, rest) / b


def t_two_sided(t: float, dof: float) -> float:
    """P(|T| > |t|) for Student's t with `dof` degrees of freedom."""
    return incomplete_beta(dof / 2.0, 0.5, dof / (dof + t * t), t * t / (dof + t * t))


@F.pandas_udf(T.DoubleType())
def normal_upper_tail_col(z: pd.Series) -> pd.Series:
    return z.map(normal_upper_tail, na_action="ignore").astype("float64")


@F.pandas_udf(T.DoubleType())
def t_two_sided_col(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([
        None if pd.isna(a) or pd.isna(b) else t_two_sided(a, b) for a, b in zip(t, dof)
    ], dtype="float64")
