"""Tail probabilities of the two test statistics, applied to one-row results.

Spark has no incomplete gamma or beta function. The statistics are aggregated by Spark;
only the finished row of a test reaches these functions.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The functions travel to the executors as code, which then need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TINY = 1e-300
_MOST_TERMS = 10_000_000


def _continued_fraction(first: float, term, tolerance: float = 1e-15) -> float:
    """first + a1/(b1 + a2/(b2 + ...)) by the modified Lentz method; (a, b) of the k-th term is term(k)."""
    value = first or _TINY
    c, d = value, 0.0
    for k in range(1, _MOST_TERMS):
        a, b = term(k)
        d = b + a * d or _TINY
        c = b + a / c or _TINY
        d = 1.0 / d
        value *= c * d
        if abs(c * d - 1.0) < tolerance:
            return value
    raise ArithmeticError(f"no convergence within {_MOST_TERMS} terms")


def _stirling_rest(a: float) -> float:
    """lgamma(a) - ((a - 1/2) log a - a + log(2 pi) / 2), for a of 10 or more."""
    w = 1.0 / (a * a)
    return (1 / 12 - w * (1 / 360 - w * (1 / 1260 - w * (1 / 1680 - w / 1188)))) / a


def _gamma_density(shape: float, x: float) -> float:
    """x^shape e^-x / Gamma(shape), without the difference of large logarithms."""
    if shape < 10:
        return math.exp(shape * math.log(x) - x - math.lgamma(shape))
    away = (x - shape) / shape
    return math.sqrt(shape / (2 * math.pi)) * math.exp(-shape * (away - math.log1p(away)) - _stirling_rest(shape))


def _log_beta(a: float, b: float) -> float:
    large, small = max(a, b), min(a, b)
    if large < 10:
        return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    rise = (large - 0.5) * math.log1p(small / large) + small * math.log(large + small) - small
    return math.lgamma(small) - rise - _stirling_rest(large + small) + _stirling_rest(large)


def gamma_tail(shape: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(shape, x)."""
    if x <= 0:
        return 1.0
    scale = _gamma_density(shape, x)
    if x < shape + 1:
        term = total = 1.0 / shape
        step = shape
        while abs(term) > abs(total) * 1e-16:
            step += 1
            term *= x / step
            total += term
        return 1.0 - total * scale
    return scale / _continued_fraction(x + 1 - shape, lambda k: (-k * (k - shape), x + 2 * k + 1 - shape))


def beta_share(a: float, b: float, x: float, rest: float | None = None) -> float:
    """Regularised incomplete beta function I_x(a, b); `rest` is 1 - x where that is known more exactly."""
    rest = 1.0 - x if rest is None else rest
    if x <= 0 or rest <= 0:
        return 0.0 if x <= 0 else 1.0
    # Very close to 1 the fraction's first denominators would be differences of nearly equal numbers.
    if x > (a + 1) / (a + b + 2) or rest < 1e-6 and a * rest < 5:
        return 1.0 - _beta_fraction(b, a, rest, x)
    return _beta_fraction(a, b, x, rest)


def _beta_fraction(a: float, b: float, x: float, rest: float) -> float:
    def term(k: int) -> tuple[float, float]:
        m = k // 2
        if k % 2:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    log_x, log_rest = (math.log(p) if p < 0.5 else math.log1p(-q) for p, q in ((x, rest), (rest, x)))
    front = math.exp(a * log_x + b * log_rest - _log_beta(a, b))
    return front / (a * _continued_fraction(1.0, term))


def chi_square_tail(statistic: float, dof: float) -> float:
    return gamma_tail(dof / 2.0, statistic / 2.0)


def correlation_tail(r: float, dof: float) -> float:
    """Two-sided probability of a correlation at least this far from zero."""
    return beta_share(dof / 2.0, 0.5, max(0.0, 1.0 - r * r), min(1.0, r * r))


def _pairwise(function):
    def apply(first: pd.Series, dof: pd.Series) -> pd.Series:
        known = first.notna() & dof.notna()
        return pd.Series(
            [function(float(x), float(n)) if ok else None for x, n, ok in zip(first, dof, known)],
            dtype="float64",
        )

    return apply


@F.pandas_udf(T.DoubleType())
def chi_square_p(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return _pairwise(chi_square_tail)(statistic, dof)


@F.pandas_udf(T.DoubleType())
def correlation_p(r: pd.Series, dof: pd.Series) -> pd.Series:
    return _pairwise(correlation_tail)(r, dof)
