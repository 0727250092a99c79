"""Aggregate expressions whose definition must match pandas or scikit-learn."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unbiased_skewness(c: Column) -> Column:
    """Skewness with the small-sample correction; null under three values."""
    n = F.count(c).cast("double")
    factor = F.sqrt(n * (n - 1)) / (n - 2)
    return F.when(F.count(c) >= 3, F.skewness(c) * factor)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient with 0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def pick_significant(c: Column, digits: int = 4) -> Column:
    """Round to a number of significant digits."""
    mag = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(c))))
    return F.when(c == 0, F.lit(0.0)).otherwise(F.rint(c * mag) / mag)


def entropy(probabilities: Column) -> Column:
    return -F.aggregate(probabilities, F.lit(0.0),
                        lambda acc, p: acc + p * F.log(F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-12))))


def argmax(values: Column) -> Column:
    """Zero-based position of the first largest element."""
    return F.array_position(values, F.array_max(values)).cast("int") - 1
