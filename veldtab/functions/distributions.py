"""Tail probabilities as column expressions; evaluated on a few rows per test, not per input row."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Terms kept in the alternating Kolmogorov series; below LAMBDA_ONE the tail is 1 to 12 digits.
KS_TERMS = 100
LAMBDA_ONE = 0.2
FRACTION_DEPTH = 80
#: Fixed value: up to so many values on the larger side the p-value is exact.
EXACT_VALUES = 10_000


def ks_exact(d: float, n: int, m: int) -> float:
    """Chance that the distance of two samples of n and m values from one continuous law is at least d.

    Every merged order of the two samples is a lattice path to (n, m), all equally likely. Along the diagonals i + j = s, the share of
    paths to (i, j) that have been at distance d or more is 1 beyond the band |i/n - j/m| < d, and inside it the mean of the
    two points before, weighted i : j. Only the band is computed, and as nothing is subtracted small tails keep their digits.
    """
    if n > m:
        n, m = m, n
    unit = math.gcd(n, m)
    h = round(d * n * m / unit) * unit
    if h <= 0:
        return 1.0
    if h > n * m:
        return 0.0
    left, both = np.ones(n + 2), n + m  # left[i + 1] is the share at (i, s - i); points off the grid have no weight
    left[1] = 0.0
    weight = np.arange(n + 1, dtype=float)
    before = (0, 0)
    for s in range(1, both + 1):
        low = max(0, s - m, (s * n - h) // both + 1)
        high = min(n, s, -((-s * n - h) // both) - 1)
        if low > high:
            return 1.0
        i = weight[low:high + 1]
        inside = (i * left[low:high + 1] + (s - i) * left[low + 1:high + 2]) / s
        left[before[0] + 1:low + 1] = 1.0
        left[low + 1:high + 2] = inside
        left[high + 2:before[1] + 2] = 1.0
        before = low, high
    return float(left[n + 1])


@F.pandas_udf(DoubleType())
def _ks_exact(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    some = lambda x, a, b: ks_exact(x, int(a), int(b)) if x == x and min(a, b) > 0 and max(a, b) <= EXACT_VALUES else None
    return pd.Series([some(*row) for row in zip(d, n, m)], dtype=float)


def ks_pvalue(d: Column, n_ref: Column, n_new: Column) -> Column:
    """Two-sided p-value of the two-sample Kolmogorov-Smirnov distance: exact up to ``EXACT_VALUES`` a side, asymptotic beyond.

    One row is one test, so the exact law is counted in batches of tests, spread like the rows.
    """
    exact = _ks_exact(d.cast("double"), n_ref.cast("double"), n_new.cast("double"))
    return F.when(F.greatest(n_ref, n_new) <= EXACT_VALUES, exact).otherwise(ks_asymptotic(d, n_ref, n_new))


def ks_asymptotic(d: Column, n_ref: Column, n_new: Column) -> Column:
    """The limit of the p-value for many values."""
    lam = d * F.sqrt(n_ref.cast("double") * n_new / (n_ref + n_new))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(-2.0 * k * k * lam * lam))
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series))
    return F.when(lam < LAMBDA_ONE, F.lit(1.0)).otherwise(bounded)


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0."""
    h = x * x
    # Below 2: one minus the all-positive series of erf; above: continued fraction from its tail.
    step = F.aggregate(
        F.sequence(F.lit(1), F.lit(60)), F.struct(x.alias("term"), x.alias("total")),
        lambda acc, k: F.struct(
            (acc["term"] * h * 2.0 / (2 * k + 1)).alias("term"),
            (acc["total"] + acc["term"] * h * 2.0 / (2 * k + 1)).alias("total")),
        lambda acc: 1.0 - acc["total"] * F.exp(-h) * (2.0 / math.sqrt(math.pi)))
    tail = F.aggregate(
        F.sequence(F.lit(FRACTION_DEPTH), F.lit(1), F.lit(-1)), x,
        lambda acc, k: x + (k / 2.0) / acc,
        lambda acc: F.exp(-h) / (acc * math.sqrt(math.pi)))
    return F.when(x < 2.0, step).otherwise(tail)


def log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function for z > 0: Stirling's series ten steps up, and the product on the way back."""
    up = z + 10.0
    series = (up - 0.5) * F.log(up) - up + 0.5 * math.log(2 * math.pi) + 1 / (12 * up) - 1 / (360 * F.pow(up, F.lit(3))) + 1 / (1260 * F.pow(up, F.lit(5)))
    back = F.aggregate(F.sequence(F.lit(0), F.lit(9)), F.lit(0.0), lambda acc, i: acc + F.log(z + i))
    return series - back


def chi2_sf(stat: Column, df: Column) -> Column:
    """Upper tail of the chi-squared distribution, for every number of degrees of freedom alike.

    The regularised incomplete gamma function: its series below the mean, its continued fraction above. Both
    need a number of steps that grows with the square root of the degrees of freedom.
    """
    a, x = df.cast("double") / 2.0, stat.cast("double") / 2.0
    scale = a * F.log(x) - x - log_gamma(a)
    steps = (F.lit(120) + F.ceil(12 * F.sqrt(a))).cast("int")
    below = F.aggregate(
        F.sequence(F.lit(1), steps), F.struct((1 / a).alias("term"), (1 / a).alias("total")),
        lambda acc, n: F.struct((acc["term"] * x / (a + n)).alias("term"), (acc["total"] + acc["term"] * x / (a + n)).alias("total")),
        lambda acc: 1.0 - acc["total"] * F.exp(scale))
    above = F.aggregate(
        F.sequence(steps, F.lit(1), F.lit(-1)), F.lit(0.0),
        lambda acc, n: n * (n - a) / (x + 2 * n + 1 - a - acc),
        lambda acc: F.exp(scale) / (x + 1 - a - acc))
    tail = F.when(x < a + 1, below).otherwise(above)
    return F.when(stat <= 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))
