"""Rule-based reading of a series and its forecast, as codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.operators.layout import join_on
from panelwright.operators.profile import bucket_aggs, historical_statistics, prediction_aggs
from panelwright.operators.scoring import best_model
from panelwright.operators.seasonal import trailing_comparison, trajectory_aggs, with_steps
from panelwright.spec import SeriesSpec

# Limits of the rules.
HIGH_MAX = 4.0
VOLATILE, UNEASY, UNSTABLE = 0.5, 0.2, 0.3
WIDE_INTERVAL = 2.0


def regime(mean: Column) -> Column:
    return (
        F.when(mean < 0, "deflation")
        .when(mean < 1, "very_low")
        .when(mean <= 2, "low_stable")
        .when(mean <= 4, "moderate")
        .when(mean.isNotNull(), "high")
    )


def classify_regimes(df: DataFrame) -> DataFrame:
    """From ``hist_mean`` and ``pred_mean``: both regimes and whether they differ."""
    past, ahead = regime(F.col("hist_mean")), regime(F.col("pred_mean"))
    return df.withColumns({"historical_regime": past, "predicted_regime": ahead, "regime_change": past != ahead})


def outlook(df: DataFrame) -> DataFrame:
    """From ``pred_mean``, ``overall_trend`` and ``step_volatility``."""
    mean, trend, vol = F.col("pred_mean"), F.col("overall_trend"), F.col("step_volatility")
    rising = (trend == "increasing") & (mean > 3)
    falling = (trend == "decreasing") & (mean < 1)
    steady = (mean >= 1) & (mean <= 2)

    def by_case(a, b, c, d):
        return F.when(rising, a).when(falling, b).when(steady, c).otherwise(d)

    return df.withColumns(
        {
            "outlook": by_case("rising_pressure", "deflation_risk", "price_stability", "moderate_inflation"),
            "risk_level": by_case("high", "moderate_high", "low", "moderate"),
            "volatility_assessment": F.when(vol > VOLATILE, "high").when(vol > UNEASY, "moderate").otherwise("low"),
            "stability": F.when(vol < UNSTABLE, "stable").otherwise("unstable"),
        }
    )


def _codes(*rules: Column) -> Column:
    return F.array_compact(F.array(*rules))


def _policy() -> Column:
    mean, trend = F.col("pred_mean"), F.col("overall_trend")
    return _codes(
        F.when(mean < 1, "expansive_policy").when(mean > 3, "restrictive_policy").otherwise("neutral_policy"),
        F.when(trend == "increasing", "watch_inflation").when(trend == "decreasing", "watch_deflation"),
        F.when(F.col("step_volatility") > VOLATILE, "high_uncertainty"),
    )


def policy_implications(df: DataFrame) -> DataFrame:
    return df.withColumn("policy_implications", _policy())


def risk_flags(df: DataFrame) -> DataFrame:
    """From ``pred_mean``, ``pred_min``, ``pred_max``, trend, volatility and ``mean_width``."""
    trend = F.col("overall_trend")
    return df.withColumns(
        {
            "upside_risks": _codes(
                F.when(F.col("pred_max") > HIGH_MAX, "high_inflation_periods"),
                F.when(trend == "increasing", "accelerating_trend"),
            ),
            "downside_risks": _codes(
                F.when(F.col("pred_min") < 0, "deflation_periods"),
                F.when(F.col("pred_mean") < 1, "persistently_low"),
            ),
            "structural_risks": _codes(
                F.when(F.col("step_volatility") > VOLATILE, "structural_uncertainty"),
                F.when(F.col("mean_width") > WIDE_INTERVAL, "wide_intervals"),
            ),
        }
    )


def model_reliability(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Grade of each key's model with the smallest MAE."""
    best = best_model(metrics, keys).select(*keys, "model")
    scored = join_on(metrics, best, [*keys, "model"], "left_semi")
    mae, mape = F.col("mae"), F.coalesce(F.col("mape"), F.lit(0.0))
    grade = (
        F.when((mae < 0.5) & (mape < 10), "excellent")
        .when((mae < 1.0) & (mape < 20), "good")
        .when((mae < 2.0) & (mape < 30), "moderate")
        .otherwise("limited")
    )
    return scored.select(*keys, F.col("model").alias("best_model"), "mae", "rmse", "mape", grade.alias("reliability"))


def conclusions(df: DataFrame) -> DataFrame:
    """Codes of what the numbers say; needs the columns of ``classify_regimes`` and ``outlook``."""
    trend = F.col("overall_trend")
    return df.withColumn(
        "conclusions",
        _codes(
            F.when(F.col("hist_mean") > 0, "positive_history"),
            F.lit("forecast_mean"),
            F.when(trend == "increasing", "increasing_forecast")
            .when(trend == "decreasing", "decreasing_forecast")
            .otherwise("stable_forecast"),
            F.when(F.col("regime_change"), "regime_change"),
            F.concat(F.lit("risk_"), F.col("risk_level")),
        ),
    )


def recommendations(df: DataFrame) -> DataFrame:
    """Policy codes first, then monitoring and risk measures."""
    extra = _codes(
        F.when(F.col("volatility_assessment") == "high", "monitor_often"),
        F.when(F.col("mean_width") > WIDE_INTERVAL, "read_with_caution"),
        F.when(F.size("upside_risks") > 0, "prepare_for_inflation"),
        F.when(F.size("downside_risks") > 0, "consider_stimulus"),
    )
    return df.withColumn("recommendations", F.concat(F.col("policy_implications"), extra))


def rule_inputs(history: DataFrame, forecast: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per key with everything the rules look at."""
    keys = list(spec.keys)
    ahead = SeriesSpec(spec.keys, spec.time, ("prediction",), spec.freq)
    rows = forecast.select(*keys, *ahead.order, "prediction", "lower", "upper")
    stats = with_steps(rows, ahead).groupBy(*keys).agg(
        *prediction_aggs(ahead), *bucket_aggs(), *trajectory_aggs(ahead)
    )
    short = {"mean_prediction": "pred_mean", "min_prediction": "pred_min", "max_prediction": "pred_max", "std_prediction": "pred_std"}
    past = historical_statistics(history, spec, "hist_", regimes=True)
    out = join_on(past, stats.drop("start_date", "end_date").withColumnsRenamed(short), keys)
    return join_on(out, trailing_comparison(history, spec), keys)


def analyse(history: DataFrame, forecast: DataFrame, metrics: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Statistics, regimes, outlook, policy, risks, reliability and conclusions per key."""
    rules = rule_inputs(history, forecast, spec)
    for step in (classify_regimes, outlook, policy_implications, risk_flags, conclusions, recommendations):
        rules = step(rules)
    graded = model_reliability(metrics, spec.keys)
    return join_on(rules, graded, spec.keys, "left")
