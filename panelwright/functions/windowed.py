"""Column builders for one value column inside a ``Frame``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwright.operators.layout import Frame


def lagged(v: Column, k: int, f: Frame) -> Column:
    return F.lag(v, k).over(f.ordered)


def pct_change(v: Column, k: int, f: Frame) -> Column:
    """Change over ``k`` rows in percent; NULL where the base is zero."""
    base = lagged(v, k, f)
    return F.try_divide(v - base, base) * 100


def second_difference(v: Column, f: Frame) -> Column:
    return v - 2 * lagged(v, 1, f) + lagged(v, 2, f)


def rolling_mean(v: Column, w: int, f: Frame) -> Column:
    return F.avg(v).over(f.trailing(w))


def rolling_std(v: Column, w: int, f: Frame) -> Column:
    return F.stddev_samp(v).over(f.trailing(w))


def rolling_min(v: Column, w: int, f: Frame) -> Column:
    return F.min(v).over(f.trailing(w))


def rolling_max(v: Column, w: int, f: Frame) -> Column:
    return F.max(v).over(f.trailing(w))


def full_window(value: Column, v: Column, w: int, f: Frame) -> Column:
    """``value`` only where all ``w`` rows of the window are there and not NULL."""
    return F.when(F.count(v).over(f.trailing(w)) == w, value)


def running_count(v: Column, f: Frame) -> Column:
    return F.count(v).over(f.running())


def trend_slope(v: Column, count: Column, w: int, f: Frame) -> Column:
    """Least-squares slope over the non-NULL values of the last ``w`` rows.

    ``count`` is a running count of the non-NULL values: its differences equal
    those of positions counted inside the window, and a slope ignores shifts.
    """
    return F.regr_slope(v, count).over(f.trailing(w))


def position_in_range(v: Column, lo: Column, hi: Column) -> Column:
    return F.when(hi - lo == 0, F.lit(0.5)).otherwise((v - lo) / (hi - lo))


def zscore(v: Column, mean: Column, sd: Column) -> Column:
    """NULL while the deviation is undefined, 0 where it is zero."""
    return F.when(sd.isNull(), F.lit(None)).when(sd == 0, F.lit(0.0)).otherwise((v - mean) / sd)
