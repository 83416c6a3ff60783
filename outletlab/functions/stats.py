"""Chi-square survival function (regularised upper incomplete gamma).

Applied once per feature, on the small per-feature result of a distributed
aggregation, through an Arrow-batched pandas UDF. No iteration is capped: up
to LARGE_SHAPE the power series and the continued fraction run until they have
converged, which takes a few times sqrt(shape) steps; beyond it a uniform
asymptotic expansion is used, whose error falls with the shape (below 1e-9 at
LARGE_SHAPE).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

_EPS = 1e-15
_TINY = 1e-300
LARGE_SHAPE = 5_000.0

# Taylor coefficients of the first two terms of the uniform
# expansion of the incomplete gamma function (in powers of eta).
_C0 = (-1 / 3, 1 / 12, -2 / 135, 1 / 864, 1 / 2835, -139 / 777600, 1 / 25515)
_C1 = (-1 / 540, -1 / 288, 1 / 378, -77 / 77760, 1 / 4860)


def _lower_series(a: float, x: float) -> float:
    """Regularised lower incomplete gamma P(a, x) by its power series, for
    x < a + 1: the terms shrink at every step."""
    term = total = 1.0 / a
    ap = a
    while term > total * _EPS:
        ap += 1.0
        term *= x / ap
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _upper_fraction(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x) by its continued fraction
    (modified Lentz), which converges for x >= a + 1."""
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    i, delta = 0, 0.0
    while abs(delta - 1.0) > _EPS:
        i += 1
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = _TINY if abs(d) < _TINY else d
        c = b + an / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        delta = d * c
        h *= delta
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def _upper_uniform(a: float, x: float) -> float:
    """Q(a, x) for a large shape, uniformly in x / a."""
    m = (x - a) / a
    if abs(m) < 1e-2:  # m - log(1 + m) without cancellation
        half_square = sum((-1) ** k * m ** k / k for k in range(2, 12))
    else:
        half_square = m - math.log1p(m)
    eta = math.copysign(math.sqrt(2.0 * half_square), m)
    decay = -a * half_square
    rest = 0.0
    if decay > -700:  # else below the smallest double
        c0 = sum(c * eta ** k for k, c in enumerate(_C0))
        c1 = sum(c * eta ** k for k, c in enumerate(_C1))
        rest = math.exp(decay) / math.sqrt(2.0 * math.pi * a) * (c0 + c1 / a)
    return min(1.0, max(0.0, 0.5 * math.erfc(eta * math.sqrt(a / 2.0)) + rest))


def chi2_sf_scalar(stat: float, dof: float) -> float:
    """P(X >= stat) for X ~ chi-square(dof); 1.0 when dof is 0."""
    if stat is None or dof is None or math.isnan(stat) or math.isnan(dof):
        return float("nan")
    if dof <= 0 or stat <= 0:
        return 1.0
    if math.isinf(stat):
        return 0.0
    a, x = dof / 2.0, stat / 2.0
    if a > LARGE_SHAPE:
        return _upper_uniform(a, x)
    if x < a + 1.0:
        return max(0.0, 1.0 - _lower_series(a, x))
    return _upper_fraction(a, x)


@pandas_udf(DoubleType())
def chi2_sf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(np.fromiter((chi2_sf_scalar(s, d) for s, d in zip(stat, dof)),
                                 dtype="float64", count=len(stat)))
