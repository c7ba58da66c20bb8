"""Statistics with the bias corrections the results are defined with."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_skewness(c: Column) -> Column:
    """Adjusted Fisher-Pearson skewness; needs three values."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(c: Column) -> Column:
    """Bias-corrected excess kurtosis; needs four values."""
    n = F.count(c).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))


def z_value(level: float) -> float:
    """Two-sided normal quantile of a confidence level."""
    return NormalDist().inv_cdf(0.5 + level / 2)
