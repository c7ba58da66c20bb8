"""Forecast metrics, model comparison and routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.layout import join_on

METRICS = ("mae", "rmse", "mape")


def forecast_metrics(df: DataFrame, by: Sequence[str], actual: str = "value", predicted: str = "prediction") -> DataFrame:
    """MAE, RMSE and MAPE (percent) per group; zero actuals have no percentage error."""
    error = F.col(actual) - F.col(predicted)
    return df.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(error, F.col(actual)))) * 100).alias("mape"),
        F.count(error).alias("n_test"),
    )


def evaluate(metrics: DataFrame) -> DataFrame:
    """Adds ``status``: a model without its metrics failed and cannot be selected."""
    return metrics.withColumn(
        "status", F.when(F.col("mae").isNotNull() & F.col("rmse").isNotNull(), "success").otherwise("failed")
    )


def _best(metric: str):
    """Model with the smallest metric; equal scores go to the first name."""
    return F.min(F.when(F.col(metric).isNotNull(), F.struct(F.col(metric).alias("s"), F.col("model").alias("m"))))


def best_model(metrics: DataFrame, keys: Sequence[str], metric: str = "mae") -> DataFrame:
    """(keys, model, best_score, candidates) among the successful models."""
    ok = evaluate(metrics).where(F.col("status") == "success")
    out = ok.groupBy(*keys).agg(_best(metric).alias("_b"), F.count(F.lit(1)).alias("candidates"))
    return out.where(F.col("_b").isNotNull()).select(
        *keys, F.col("_b.m").alias("model"), F.col("_b.s").alias("best_score"), "candidates"
    )


def best_per_metric(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, metric, model, score): the winner of every metric."""
    ok = evaluate(metrics).where(F.col("status") == "success")
    out = ok.groupBy(*keys).agg(*[_best(m).alias(m) for m in METRICS])
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m)["m"].alias("model"), F.col(m)["s"].alias("score")) for m in METRICS]
    return out.select(*keys, F.inline(F.array(*rows)))


def route(forecasts: DataFrame, best: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Forecast rows of each key's selected model."""
    return join_on(forecasts, best.select(*keys, "model"), [*keys, "model"], "left_semi")
