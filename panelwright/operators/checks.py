"""Sanity checks of forecasts, as one row per key and check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What counts as a reasonable forecast.
MIN_RATE, MAX_RATE = -10.0, 20.0
MAX_STD = 5.0
MAX_JUMP = 3.0
MAX_WIDTH = 10.0
MIN_GAP_DAYS, MAX_GAP_DAYS = 25, 35


def forecast_checks(df: DataFrame, by: Sequence[str], time: str = "t", position: str | None = None) -> DataFrame:
    """(by, check, severity, passed).

    ``position`` is the column that holds the order rows were produced in;
    only with it can dates be out of order. Forecasts are short, so a group's
    rows fit one window.
    """
    order = position or time
    p, w = F.col("prediction"), Window.partitionBy(*by).orderBy(order)
    gap = F.datediff(F.col(time), F.lag(time).over(w))
    rows = df.withColumns({"_step": F.abs(p - F.lag(p).over(w)), "_gap": gap, "_width": F.col("upper") - F.col("lower")})
    invalid = p.isNull() | F.isnan(p) | (F.abs(p) == float("inf"))
    out = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(invalid).alias("_invalid"),
        F.count_if((p < MIN_RATE) | (p > MAX_RATE)).alias("_out"),
        F.stddev_pop(p).alias("_std"),
        F.max("_step").alias("_jump"),
        F.count_if(~((F.col("lower") <= p) & (p <= F.col("upper")))).alias("_outside"),
        F.avg("_width").alias("_mean_width"),
        F.count_if(F.col("_gap") < 0).alias("_backwards"),
        F.count_if((F.col("_gap") < MIN_GAP_DAYS) | (F.col("_gap") > MAX_GAP_DAYS)).alias("_irregular"),
    )

    def check(name: str, severity: str, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check"), F.lit(severity).alias("severity"), F.coalesce(passed, F.lit(False)).alias("passed")
        )

    checks = [
        check("no_invalid_values", "error", F.col("_invalid") == 0),
        check("reasonable_range", "warning", F.col("_out") == 0),
        check("reasonable_volatility", "warning", F.col("_std") <= MAX_STD),
        check("no_extreme_jumps", "warning", F.coalesce(F.col("_jump") <= MAX_JUMP, F.col("_n") == 1)),
        check("valid_confidence_intervals", "error", F.col("_outside") == 0),
        check("reasonable_ci_width", "warning", F.col("_mean_width") <= MAX_WIDTH),
        check("chronological_dates", "error", F.col("_backwards") == 0),
        check("regular_date_gaps", "warning", F.col("_irregular") == 0),
    ]
    return out.select(*by, F.inline(F.array(*checks)))


# Irregular gaps only warn; they are not among the counted checks.
UNCOUNTED = ("regular_date_gaps",)


def check_summary(checks: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, total, passed, pass rate, warnings, errors, valid); only errors make a forecast invalid."""
    counted = ~F.col("check").isin(*UNCOUNTED)
    failed = ~F.col("passed")
    total, passed = F.count_if(counted), F.count_if(counted & F.col("passed"))
    return checks.groupBy(*by).agg(
        total.alias("total_checks"),
        passed.alias("passed_checks"),
        F.try_divide(passed.cast("double"), total).alias("pass_rate"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("warnings"),
        F.count_if(failed & (F.col("severity") == "error")).alias("errors"),
        (F.count_if(failed & (F.col("severity") == "error")) == 0).alias("valid"),
    )
