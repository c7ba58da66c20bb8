"""Seasonal profile, additive decomposition, trailing comparisons, sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions import windowed as w
from panelwright.operators.layout import Frame, join_on, over_series, settled
from panelwright.spec import SeriesSpec


def seasonal_profile(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return (
        df.groupBy(*spec.keys, F.month(spec.time).alias("month"))
        .agg(*[F.avg(v).alias(f"{v}_mean") for v in spec.values])
    )


def decompose(df: DataFrame, spec: SeriesSpec, period: int = 12, **layout) -> DataFrame:
    """Additive trend, seasonal and residual columns of the (single) value.

    NULLs are left out first. The trend is the centred moving average over one
    period (two half-weighted ends when the period is even) and is NULL where
    the window leaves the series; the seasonal part is the mean detrended value
    of each phase, centred to zero. Series shorter than two periods get NULLs.
    """
    keys = list(spec.keys)
    (v,) = spec.values
    half = period // 2
    known = df.where(F.col(v).isNotNull())

    def build(f: Frame):
        c = F.col(v)
        if period % 2 == 0:
            left, right = f.between(-half, half - 1), f.between(-half + 1, half)
            total = (F.sum(c).over(left) + F.sum(c).over(right)) / (2 * period)
        else:
            total = F.sum(c).over(f.between(-half, half)) / period
        reach = F.count(c).over(f.between(-half, half))
        return {"trend": F.when(reach == 2 * half + 1, total)}

    trended = over_series(known, spec, build, before=half, after=half, pos_as="_p", **layout)
    phased = trended.withColumn("_phase", F.pmod(F.col("_p") - 1, F.lit(period)))
    phases = phased.groupBy(*keys, "_phase").agg(
        F.avg(F.col(v) - F.col("trend")).alias("_mean"), F.count(F.lit(1)).alias("_n")
    )
    whole = Window.partitionBy(*keys)  # at most ``period`` rows per key
    centred = phases.select(
        *keys,
        "_phase",
        F.when(F.sum("_n").over(whole) >= 2 * period, F.col("_mean") - F.avg("_mean").over(whole)).alias("seasonal"),
    )
    centred = centred if spec.bounded else settled(centred, "phases")
    out = join_on(phased, centred, [*keys, "_phase"])
    enough = F.col("seasonal").isNotNull()
    return out.select(
        *df.columns,
        F.when(enough, F.col("trend")).alias("trend"),
        "seasonal",
        (F.col(v) - F.col("trend") - F.col("seasonal")).alias("residual"),
    )


def sequences(df: DataFrame, spec: SeriesSpec, length: int = 12, **layout) -> DataFrame:
    """The ``length`` values before each row as an array; rows without a full history go."""
    (v,) = spec.values

    def build(f: Frame):
        return {"sequence": F.collect_list(v).over(f.between(-length, -1))}

    return over_series(df, spec, build, before=length, **layout).where(F.size("sequence") == length)


def tail(df: DataFrame, spec: SeriesSpec, n: int) -> DataFrame:
    """Last ``n`` rows of each series.

    For an unbounded series each block first keeps its own last rows, and only
    those are ranked again.
    """
    keys = list(spec.keys)
    back = [F.col(c).desc() for c in spec.order]
    if not spec.bounded:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spec.order), F.lit(1024)))
        rank = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*back))
        df = salted.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank", "_salt")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*back))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def trailing_comparison(df: DataFrame, spec: SeriesSpec, n: int = 12) -> DataFrame:
    """Mean of the last ``n`` values against the ``n`` before them, per key.

    Series of at least ``n`` but fewer than ``2n`` values compare with their
    first ``n``; shorter ones get NULLs.
    """
    (v,) = spec.values
    keys = list(spec.keys)
    known = df.where(F.col(v).isNotNull())
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in spec.order])
    last = tail(known, spec, 2 * n).withColumn("_back", F.row_number().over(newest))
    size = F.count(F.lit(1))
    # of s < 2n rows the first n are those with the n highest backward ranks
    recent = F.avg(F.when(F.col("_back") <= n, F.col(v)))
    sized = last.withColumn("_size", size.over(Window.partitionBy(*keys)))
    before = F.avg(F.when(F.col("_back") > F.col("_size") - n, F.col(v)))
    out = sized.groupBy(*keys).agg(
        F.when(size >= n, recent).alias("recent_avg"), F.when(size >= n, before).alias("previous_avg")
    )
    gap = F.col("recent_avg") - F.col("previous_avg")
    return out.withColumns(
        {
            "trend_direction": F.when(gap > 0, "increasing").when(gap.isNotNull(), "decreasing"),
            "trend_magnitude": F.abs(gap),
        }
    )


def with_steps(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Adds ``{v}_step``, the change from the row before."""
    (v,) = spec.values
    return over_series(df, spec, lambda f: {f"{v}_step": F.col(v) - w.lagged(F.col(v), 1, f)}, before=1)


def trajectory_aggs(spec: SeriesSpec) -> list[Column]:
    (v,) = spec.values
    at, step = F.struct(*spec.order), F.col(f"{v}_step")
    first, last = F.min_by(v, at), F.max_by(v, at)
    trend = F.when(last > first, "increasing").when(F.count(F.lit(1)) > 1, "decreasing").otherwise("stable")
    return [
        first.alias("initial_value"),
        last.alias("final_value"),
        trend.alias("overall_trend"),
        F.coalesce(F.stddev_pop(step), F.lit(0.0)).alias("step_volatility"),
        F.coalesce(F.max(F.abs(step)), F.lit(0.0)).alias("max_jump"),
    ]


def trajectory(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """First and last value, direction, deviation and largest size of the steps, per key."""
    (v,) = spec.values
    return with_steps(df.select(*spec.keys, *spec.order, v), spec).groupBy(*spec.keys).agg(*trajectory_aggs(spec))
