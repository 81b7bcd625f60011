"""Two distribution functions Spark has no built-in for, vectorised over Arrow batches.

They are evaluated on one row per group, after all aggregation.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

# Executors need not have this package installed: ship the functions themselves.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def chi2_tail(x: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(X > x) for a chi-squared X with a whole number of degrees of freedom.

    Even: a Poisson sum. Odd: a normal tail plus the half-integer terms.
    """
    x, df = np.broadcast_arrays(np.asarray(x, dtype=float), np.asarray(df, dtype=float))
    half = x / 2
    odd = df % 2 == 1
    root = np.sqrt(np.where(half > 0, half, 0.0))
    erfc = np.frompyfunc(math.erfc, 1, 1)
    total = np.where(odd, erfc(np.where(np.isnan(root), 0.0, root)).astype(float), np.exp(-half))
    start = np.where(odd, 0.5, 1.0)
    term = np.where(odd, np.exp(-half) * root / math.gamma(1.5), np.exp(-half) * half)
    top = int(np.nanmax(df)) if df.size and not np.all(np.isnan(df)) else 0
    for step in range(top // 2 + 1):
        power = start + step
        total = total + np.where(power < df / 2, term, 0.0)
        term = term * half / (power + 1)
    return np.where(np.isnan(x) | np.isnan(df) | (df < 1), np.nan, np.where(x <= 0, 1.0, np.minimum(total, 1.0)))


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 400):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + numerator * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + numerator / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
        if np.all(np.abs(d * c - 1) < 1e-15):
            break
    return h


def _beta_regularised(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    log_gamma = np.frompyfunc(math.lgamma, 1, 1)
    log_beta = (log_gamma(a) + log_gamma(b) - log_gamma(a + b)).astype(float)
    with np.errstate(divide="ignore"):
        front = np.exp(a * np.log(x) + b * np.log1p(-x) - log_beta)
    direct = x < (a + 1) / (a + b + 2)
    near = front * _beta_fraction(a, b, np.where(direct, x, 0.0)) / a
    far = 1 - front * _beta_fraction(b, a, np.where(direct, 0.0, 1 - x)) / b
    return np.where(direct, near, far)


def t_quantile(p: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Quantile of Student's t for p in (0.5, 1), by bisection on the exact tail."""
    p, df = np.broadcast_arrays(np.asarray(p, dtype=float), np.asarray(df, dtype=float))
    bad = ~((p > 0.5) & (p < 1) & (df >= 1))
    p, df = np.where(bad, 0.75, p), np.where(bad, 1.0, df)
    low, high = np.zeros(p.shape), np.ones(p.shape)

    def cdf(t: np.ndarray) -> np.ndarray:
        return 1 - 0.5 * _beta_regularised(df / 2, np.full(p.shape, 0.5), df / (df + t * t))

    while np.any(grow := cdf(high) < p):
        high = np.where(grow, high * 2, high)
    for _ in range(200):
        middle = (low + high) / 2
        under = cdf(middle) < p
        low, high = np.where(under, middle, low), np.where(under, high, middle)
    return np.where(bad, np.nan, (low + high) / 2)


@F.pandas_udf(T.DoubleType())
def chi2_tail_udf(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(chi2_tail(x.to_numpy(float), df.to_numpy(float)))


@F.pandas_udf(T.DoubleType())
def t_quantile_udf(p: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_quantile(p.to_numpy(float), df.to_numpy(float)))
