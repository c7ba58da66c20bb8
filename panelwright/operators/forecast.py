"""Future periods, baseline forecasts and first-order autoregression per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.windowed import lagged
from panelwright.operators.layout import POS, join_on, number_rows, over_series
from panelwright.spec import SeriesSpec

HORIZON = 12


def future_calendar(df: DataFrame, spec: SeriesSpec, horizon: int = HORIZON) -> DataFrame:
    """(keys, step, t): the ``horizon`` period starts after each key's last row."""
    months = spec.months_per_period
    last = df.groupBy(*spec.keys).agg(F.max(spec.time).cast("date").alias("_last"))
    unit = {1: "MM", 3: "QUARTER", 12: "YEAR"}[months]
    return last.select(
        *spec.keys, F.trunc("_last", unit).alias("_last"), F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    ).select(*spec.keys, "step", F.add_months("_last", F.col("step") * months).alias(spec.time))


def naive_fit(train: DataFrame, spec: SeriesSpec) -> DataFrame:
    """(keys, last_value, mean_value) of the known training values."""
    (v,) = spec.values
    known = train.where(F.col(v).isNotNull())
    return known.groupBy(*spec.keys).agg(
        F.max_by(v, F.struct(*spec.order)).alias("last_value"), F.avg(v).alias("mean_value")
    )


def ar1_fit(train: DataFrame, spec: SeriesSpec, **layout) -> DataFrame:
    """(keys, phi, intercept, sigma2, n): least squares of each value on the one before."""
    (v,) = spec.values
    lag = over_series(train, spec, lambda f: {"y1": lagged(F.col(v), 1, f)}, before=1, **layout)
    y, x = F.col(v), F.col("y1")
    rss = F.regr_syy(y, x) - F.regr_slope(y, x) * F.regr_sxy(y, x)
    return lag.groupBy(*spec.keys).agg(
        F.regr_slope(y, x).alias("phi"),
        F.regr_intercept(y, x).alias("intercept"),
        F.try_divide(rss, F.regr_count(y, x) - 2).alias("sigma2"),
        F.regr_count(y, x).alias("n"),
    )


def ar1_path(start: Column, phi: Column, intercept: Column, steps: Column) -> Column:
    """Value ``steps`` periods ahead: the sum of the geometric series that stepping makes."""
    power = F.pow(phi, steps)
    carried = F.when(phi == 1, intercept * steps).otherwise(intercept * (1 - power) / F.nullif(1 - phi, F.lit(0.0)))
    return power * start + carried


def baseline_forecasts(grid: DataFrame, train: DataFrame, spec: SeriesSpec) -> DataFrame:
    """(grid columns, model, prediction) of the last value, the mean and AR(1).

    ``grid`` has the keys and ``step``, the number of periods after the last
    training row.
    """
    fits = join_on(naive_fit(train, spec), ar1_fit(train, spec), spec.keys)
    at = join_on(grid, fits, spec.keys)
    ar1 = ar1_path(F.col("last_value"), F.col("phi"), F.col("intercept"), F.col("step"))
    models = {"random_walk": F.col("last_value"), "historic_mean": F.col("mean_value"), "ar1": ar1}
    rows = [F.struct(F.lit(m).alias("model"), p.alias("prediction")) for m, p in models.items()]
    return at.select(*grid.columns, F.inline(F.array(*rows)))


def test_grid(split: DataFrame, spec: SeriesSpec, carry: Sequence[str] = ()) -> DataFrame:
    """Test rows of a chronological split with ``step``, counted from the last training row."""
    test = split.where(F.col("part") == "test").select(*spec.keys, *spec.order, *spec.values, *carry)
    return number_rows(test, spec).withColumn("step", F.col(POS).cast("int")).drop(POS)
