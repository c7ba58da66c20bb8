"""Intervals, forecast checks, rule-based analysis and whole pipelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.operators import analysis, checks, intervals, profile
from panelwright.plans import panels as p
from panelwright.plans import pipeline
from panelwright.plans.catalog import query
from panelwright.plans.catalog.cleaning import _LINEAR, _points
from panelwright.plans.catalog.windowing import matrix_cells, matrix_sql
from panelwright.plans.panels import Z95, rounded, with_ctes
from panelwright.session import cut_lineage, scratch_path
from panelwright.sources import sinks

_K = "k, CAST(t AS VARCHAR) AS t"
_BAND = "round(lower, 6) + 0.0 AS lower, round(upper, 6) + 0.0 AS upper"


def _out(df: DataFrame, *columns: str, **places: int) -> DataFrame:
    cols = [F.col(c).cast("string").alias(c) if c == "t" else F.col(c) for c in columns]
    return df.select(*cols, *[rounded(F.col(c), n).alias(c) for c, n in places.items()])


def _joined(codes: Column) -> Column:
    return F.array_join(codes, ",")


# --- intervals ------------------------------------------------------------------------------


def _with_rmse(spark: SparkSession, sf: str) -> DataFrame:
    prices = p.written_prices(spark, sf)
    return p.with_rmse(prices, p.backtest(prices)[1])


@query("interval_normal", with_ctes(f"SELECT {_K}, model, {_BAND} FROM banded", "banded"))
def interval_normal(spark: SparkSession, sf: str) -> DataFrame:
    return _out(intervals.normal_interval(_with_rmse(spark, sf)), "k", "t", "model", lower=6, upper=6)


_SD = "CASE WHEN count(*) OVER g > 1 THEN stddev_pop(prediction) OVER g ELSE {one} END"
_SPREAD = f"""SELECT {_K}, model, round(prediction - {Z95} * sd, 6) + 0.0 AS lower, round(prediction + {Z95} * sd, 6) + 0.0 AS upper
    FROM (SELECT *, {_SD.format(one="0.1")} AS sd FROM forecasts WINDOW g AS (PARTITION BY k, model))"""


@query("interval_spread", with_ctes(_SPREAD, "forecasts"))
def interval_spread(spark: SparkSession, sf: str) -> DataFrame:
    df = intervals.spread_interval(p.forecasts(p.written_prices(spark, sf)), ["k", "model"])
    return _out(df, "k", "t", "model", lower=6, upper=6)


@query("interval_dispersion", with_ctes(_SPREAD, "forecasts"))
def interval_dispersion(spark: SparkSession, sf: str) -> DataFrame:
    df = intervals.add_interval(_with_rmse(spark, sf), ["k", "model"], "bootstrap")
    return _out(df, "k", "t", "model", lower=6, upper=6)


@query("interval_dispersion_single", with_ctes(f"SELECT {_K}, model, {_BAND} FROM banded", "banded"))
def interval_dispersion_single(spark: SparkSession, sf: str) -> DataFrame:
    """One forecast per group: the RMSE stands in for the spread."""
    df = intervals.dispersion_interval(_with_rmse(spark, sf), ["k", "model", "t"])
    return _out(df, "k", "t", "model", lower=6, upper=6)


@query(
    "interval_dispatch",
    with_ctes(
        f"""SELECT {_K}, model, round(CASE model WHEN 'random_walk' THEN prediction - 1 WHEN 'historic_mean' THEN prediction - {Z95} * sd
              ELSE lower END, 6) + 0.0 AS lower,
            round(CASE model WHEN 'random_walk' THEN prediction + 1 WHEN 'historic_mean' THEN prediction + {Z95} * sd
              ELSE upper END, 6) + 0.0 AS upper
            FROM (SELECT *, stddev_pop(prediction) OVER (PARTITION BY k, model) AS sd FROM banded)""",
        "banded",
    ),
)
def interval_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    """'auto' keeps an ARIMA interval, widens a forest by its spread and others by their RMSE."""
    kind = F.when(F.col("model") == "random_walk", "ARIMA").when(F.col("model") == "historic_mean", "RandomForest")
    own = {"lower": F.col("prediction") - 1, "upper": F.col("prediction") + 1, "model_type": kind.otherwise("LSTM")}
    df = intervals.add_interval(_with_rmse(spark, sf).withColumns(own), ["k", "model"], "auto")
    return _out(df, "k", "t", "model", lower=6, upper=6)


# --- checks ------------------------------------------------------------------------------------

_CHECKED = """SELECT k, model, count(*) AS n, count(*) FILTER (prediction IS NULL OR isnan(prediction) OR isinf(prediction)) AS bad,
    count(*) FILTER (prediction < -10 OR prediction > 20) AS out, stddev_pop(prediction) AS sd, max(step_size) AS jump,
    count(*) FILTER (NOT (lower <= prediction AND prediction <= upper)) AS outside, avg(upper - lower) AS width,
    count(*) FILTER (gap < 0) AS backwards, count(*) FILTER (gap < 25 OR gap > 35) AS irregular
    FROM (SELECT *, abs(prediction - lag(prediction) OVER w) AS step_size, date_diff('day', lag(t) OVER w, t) AS gap
          FROM banded WINDOW w AS (PARTITION BY k, model ORDER BY t)) GROUP BY k, model"""
_CHECKS = " UNION ALL ".join(
    f"SELECT k, model, '{name}' AS \"check\", '{severity}' AS severity, coalesce({passed}, false) AS passed FROM checked"
    for name, severity, passed in (
        ("no_invalid_values", "error", "bad = 0"),
        ("reasonable_range", "warning", "out = 0"),
        ("reasonable_volatility", "warning", "sd <= 5"),
        ("no_extreme_jumps", "warning", "coalesce(jump <= 3, n = 1)"),
        ("valid_confidence_intervals", "error", "outside = 0"),
        ("reasonable_ci_width", "warning", "width <= 10"),
        ("chronological_dates", "error", "backwards = 0"),
        ("regular_date_gaps", "warning", "irregular = 0"),
    )
)


def _checks(spark: SparkSession, sf: str) -> DataFrame:
    return checks.forecast_checks(intervals.normal_interval(_with_rmse(spark, sf)), ["k", "model"])


@query("forecast_checks", with_ctes(_CHECKS, "banded", checked=_CHECKED))
def forecast_checks(spark: SparkSession, sf: str) -> DataFrame:
    return _checks(spark, sf)


@query(
    "check_summary",
    with_ctes(
        """SELECT k, model, count(*) FILTER ("check" <> 'regular_date_gaps') AS total_checks,
             count(*) FILTER ("check" <> 'regular_date_gaps' AND passed) AS passed_checks,
             round(count(*) FILTER ("check" <> 'regular_date_gaps' AND passed) / 7.0, 6) + 0.0 AS pass_rate,
             count(*) FILTER (NOT passed AND severity = 'warning') AS warnings,
             count(*) FILTER (NOT passed AND severity = 'error') AS errors,
             count(*) FILTER (NOT passed AND severity = 'error') = 0 AS valid
           FROM checks GROUP BY k, model""",
        "banded",
        checked=_CHECKED,
        checks=_CHECKS,
    ),
)
def check_summary(spark: SparkSession, sf: str) -> DataFrame:
    df = checks.check_summary(_checks(spark, sf), ["k", "model"])
    return df.withColumn("pass_rate", rounded(F.col("pass_rate"), 6))


# --- forecast profiles and chart tables -----------------------------------------------------------


def _chosen(prices: DataFrame) -> DataFrame:
    return p.chosen_forecast(prices)[0].select("k", "t", "prediction", "lower", "upper", "model")


@query(
    "prediction_statistics",
    with_ctes(
        """SELECT k, count(*) AS prediction_count, CAST(min(t) AS VARCHAR) AS start_date, CAST(max(t) AS VARCHAR) AS end_date,
             round(avg(prediction), 6) + 0.0 AS mean_prediction, round(median(prediction), 6) + 0.0 AS median_prediction,
             round(stddev_pop(prediction), 6) + 0.0 AS std_prediction, round(min(prediction), 6) + 0.0 AS min_prediction,
             round(max(prediction), 6) + 0.0 AS max_prediction, round(avg(upper - lower), 6) + 0.0 AS mean_width
           FROM chosen GROUP BY k""",
        "chosen",
    ),
)
def prediction_statistics(spark: SparkSession, sf: str) -> DataFrame:
    df = profile.prediction_statistics(_chosen(p.written_prices(spark, sf)), p.RATE)
    df = df.withColumns({c: F.col(c).cast("string") for c in ("start_date", "end_date")})
    names = ("mean_prediction", "median_prediction", "std_prediction", "min_prediction", "max_prediction", "mean_width")
    return _out(df, "k", "prediction_count", "start_date", "end_date", **{n: 6 for n in names})


@query(
    "prediction_buckets",
    with_ctes(
        """SELECT k, count(*) FILTER (prediction > 3) AS high_inflation_months,
             count(*) FILTER (prediction BETWEEN 1 AND 3) AS moderate_inflation_months,
             count(*) FILTER (prediction >= 0 AND prediction < 1) AS low_inflation_months,
             count(*) FILTER (prediction < 0) AS deflation_months FROM chosen GROUP BY k""",
        "chosen",
    ),
)
def prediction_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return profile.prediction_buckets(_chosen(p.written_prices(spark, sf)), p.RATE)


@query(
    "history_and_forecast",
    with_ctes(
        f"""SELECT {_K}, 'history' AS series, round(rate, 6) + 0.0 AS value, CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper
            FROM prices UNION ALL SELECT {_K}, 'forecast', round(prediction, 6) + 0.0, {_BAND} FROM chosen""",
        "chosen",
    ),
)
def history_and_forecast(spark: SparkSession, sf: str) -> DataFrame:
    prices = p.written_prices(spark, sf)
    df = profile.history_and_forecast(prices, _chosen(prices), p.RATE)
    return _out(df, "k", "t", "series", value=6, lower=6, upper=6)


@query(
    "interval_widths",
    with_ctes(
        f"""SELECT {_K}, round(upper - lower, 6) + 0.0 AS width, round(avg(upper - lower) OVER (PARTITION BY k), 6) + 0.0 AS mean_width
            FROM chosen""",
        "chosen",
    ),
)
def interval_widths(spark: SparkSession, sf: str) -> DataFrame:
    return _out(profile.interval_widths(_chosen(p.written_prices(spark, sf)), p.RATE), "k", "t", width=6, mean_width=6)


# --- rules -------------------------------------------------------------------------------------------

_RULES = {
    "past": "SELECT k, avg(rate) AS hist_mean FROM prices GROUP BY k",
    "steps": """SELECT *, prediction - lag(prediction) OVER (PARTITION BY k ORDER BY t) AS jump FROM chosen""",
    "rules": """SELECT k, hist_mean, avg(prediction) AS pred_mean, min(prediction) AS pred_min, max(prediction) AS pred_max,
        avg(upper - lower) AS mean_width, coalesce(stddev_pop(jump), 0) AS step_volatility,
        CASE WHEN max_by(prediction, t) > min_by(prediction, t) THEN 'increasing' WHEN count(*) > 1 THEN 'decreasing'
             ELSE 'stable' END AS overall_trend
        FROM steps JOIN past USING (k) GROUP BY k, hist_mean""",
}


def _regime(x: str) -> str:
    return (
        f"CASE WHEN {x} < 0 THEN 'deflation' WHEN {x} < 1 THEN 'very_low' WHEN {x} <= 2 THEN 'low_stable' "
        f"WHEN {x} <= 4 THEN 'moderate' WHEN {x} IS NOT NULL THEN 'high' END"
    )


_RISK = """CASE WHEN overall_trend = 'increasing' AND pred_mean > 3 THEN 'high'
    WHEN overall_trend = 'decreasing' AND pred_mean < 1 THEN 'moderate_high' WHEN pred_mean BETWEEN 1 AND 2 THEN 'low'
    ELSE 'moderate' END"""
_OUTLOOK = """CASE WHEN overall_trend = 'increasing' AND pred_mean > 3 THEN 'rising_pressure'
    WHEN overall_trend = 'decreasing' AND pred_mean < 1 THEN 'deflation_risk' WHEN pred_mean BETWEEN 1 AND 2 THEN 'price_stability'
    ELSE 'moderate_inflation' END"""


def _list(*codes: str) -> str:
    return f"array_to_string(list_filter([{', '.join(f'CASE {c} END' for c in codes)}], lambda x: x IS NOT NULL), ',')"


_POLICY = _list(
    "WHEN pred_mean < 1 THEN 'expansive_policy' WHEN pred_mean > 3 THEN 'restrictive_policy' ELSE 'neutral_policy'",
    "WHEN overall_trend = 'increasing' THEN 'watch_inflation' WHEN overall_trend = 'decreasing' THEN 'watch_deflation'",
    "WHEN step_volatility > 0.5 THEN 'high_uncertainty'",
)
_UP = _list("WHEN pred_max > 4 THEN 'high_inflation_periods'", "WHEN overall_trend = 'increasing' THEN 'accelerating_trend'")
_DOWN = _list("WHEN pred_min < 0 THEN 'deflation_periods'", "WHEN pred_mean < 1 THEN 'persistently_low'")
_STRUCTURAL = _list("WHEN step_volatility > 0.5 THEN 'structural_uncertainty'", "WHEN mean_width > 2 THEN 'wide_intervals'")
_CONCLUSIONS = _list(
    "WHEN hist_mean > 0 THEN 'positive_history'",
    "WHEN true THEN 'forecast_mean'",
    "overall_trend WHEN 'increasing' THEN 'increasing_forecast' WHEN 'decreasing' THEN 'decreasing_forecast' ELSE 'stable_forecast'",
    f"WHEN {_regime('hist_mean')} <> {_regime('pred_mean')} THEN 'regime_change'",
    f"WHEN true THEN 'risk_' || {_RISK}",
)
_RECOMMENDATIONS = _list(
    "WHEN pred_mean < 1 THEN 'expansive_policy' WHEN pred_mean > 3 THEN 'restrictive_policy' ELSE 'neutral_policy'",
    "WHEN overall_trend = 'increasing' THEN 'watch_inflation' WHEN overall_trend = 'decreasing' THEN 'watch_deflation'",
    "WHEN step_volatility > 0.5 THEN 'high_uncertainty'",
    "WHEN step_volatility > 0.5 THEN 'monitor_often'",
    "WHEN mean_width > 2 THEN 'read_with_caution'",
    "WHEN pred_max > 4 OR overall_trend = 'increasing' THEN 'prepare_for_inflation'",
    "WHEN pred_min < 0 OR pred_mean < 1 THEN 'consider_stimulus'",
)


def _rules(spark: SparkSession, sf: str) -> DataFrame:
    """The rules read history and forecast several times, so both are written once."""
    prices = p.written_prices(spark, sf)
    return analysis.rule_inputs(prices, cut_lineage(_chosen(prices), "forecast"), p.RATE)


def _rule_sql(cells: str) -> str:
    return with_ctes(f"SELECT k, {cells} FROM rules", "chosen", **_RULES)


@query(
    "regimes",
    _rule_sql(
        f"{_regime('hist_mean')} AS historical_regime, {_regime('pred_mean')} AS predicted_regime, "
        f"{_regime('hist_mean')} <> {_regime('pred_mean')} AS regime_change"
    ),
)
def regimes(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.classify_regimes(_rules(spark, sf)).select(
        "k", "historical_regime", "predicted_regime", "regime_change"
    )


@query(
    "outlook",
    _rule_sql(
        f"{_OUTLOOK} AS outlook, {_RISK} AS risk_level, CASE WHEN step_volatility > 0.5 THEN 'high' WHEN step_volatility > 0.2 "
        "THEN 'moderate' ELSE 'low' END AS volatility_assessment, CASE WHEN step_volatility < 0.3 THEN 'stable' ELSE 'unstable' END "
        "AS stability"
    ),
)
def outlook(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.outlook(_rules(spark, sf)).select(
        "k", "outlook", "risk_level", "volatility_assessment", "stability"
    )


@query("policy_implications", _rule_sql(f"{_POLICY} AS policy_implications"))
def policy_implications(spark: SparkSession, sf: str) -> DataFrame:
    df = analysis.policy_implications(_rules(spark, sf))
    return df.select("k", _joined(F.col("policy_implications")).alias("policy_implications"))


@query("risk_flags", _rule_sql(f"{_UP} AS upside_risks, {_DOWN} AS downside_risks, {_STRUCTURAL} AS structural_risks"))
def risk_flags(spark: SparkSession, sf: str) -> DataFrame:
    df = analysis.risk_flags(_rules(spark, sf))
    return df.select("k", *[_joined(F.col(c)).alias(c) for c in ("upside_risks", "downside_risks", "structural_risks")])


_GRADE = """CASE WHEN mae < 0.5 AND mape < 10 THEN 'excellent' WHEN mae < 1 AND mape < 20 THEN 'good'
    WHEN mae < 2 AND mape < 30 THEN 'moderate' ELSE 'limited' END"""


@query(
    "model_reliability",
    with_ctes(
        f"""SELECT k, model AS best_model, round(mae, 6) + 0.0 AS mae, round(rmse, 6) + 0.0 AS rmse, round(mape, 4) + 0.0 AS mape,
              {_GRADE} AS reliability FROM metrics JOIN best USING (k, model)""",
        "best",
    ),
)
def model_reliability(spark: SparkSession, sf: str) -> DataFrame:
    df = analysis.model_reliability(p.backtest(p.written_prices(spark, sf))[1], ["k"])
    return _out(df, "k", "best_model", "reliability", mae=6, rmse=6, mape=4)


@query(
    "conclusions", _rule_sql(f"{_CONCLUSIONS} AS conclusions, {_RECOMMENDATIONS} AS recommendations")
)
def conclusions(spark: SparkSession, sf: str) -> DataFrame:
    df = _rules(spark, sf)
    for step in (
        analysis.classify_regimes, analysis.outlook, analysis.policy_implications, analysis.risk_flags,
        analysis.conclusions, analysis.recommendations,
    ):
        df = step(df)
    return df.select("k", *[_joined(F.col(c)).alias(c) for c in ("conclusions", "recommendations")])


@query(
    "analysis",
    with_ctes(
        f"""SELECT k, {_regime('hist_mean')} AS historical_regime, {_regime('pred_mean')} AS predicted_regime, {_OUTLOOK} AS outlook,
              {_RECOMMENDATIONS} AS recommendations, {_GRADE} AS reliability, round(pred_mean, 6) + 0.0 AS pred_mean,
              round(hist_mean, 6) + 0.0 AS hist_mean
            FROM rules JOIN best USING (k) JOIN metrics USING (k, model)""",
        "chosen",
        **_RULES,
    ),
)
def analyse(spark: SparkSession, sf: str) -> DataFrame:
    """The whole analysis of every key, written as JSON and read back."""
    history = p.written_prices(spark, sf)
    forecast, metrics = p.chosen_forecast(history)
    metrics = cut_lineage(metrics, "metrics")
    path = scratch_path(spark, "analysis")
    forecast = cut_lineage(forecast.drop("step"), "forecast")
    sinks.write_analysis(analysis.analyse(history, forecast, metrics, p.RATE), path)
    schema = """k string, historical_regime string, predicted_regime string, outlook string, recommendations array<string>,
        reliability string, pred_mean double, hist_mean double"""
    df = spark.read.schema(schema).json(path).withColumn("recommendations", _joined(F.col("recommendations")))
    return _out(
        df, "k", "historical_regime", "predicted_regime", "outlook", "recommendations", "reliability",
        pred_mean=6, hist_mean=6,
    )


# --- pipelines --------------------------------------------------------------------------------------------


@query(
    "bootstrap_scores",
    with_ctes(
        """SELECT k, model, metric, round(score, 8) + 0.0 AS value, true AS ordered FROM (FROM (
             SELECT k, model, mae, rmse, bias FROM metrics JOIN (SELECT k, model, avg(rate - prediction) AS bias FROM tested GROUP BY k, model) USING (k, model))
             UNPIVOT (score FOR metric IN (mae, rmse, bias)))""",
        "metrics",
    ),
)
def bootstrap_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every model's scores in the backtest with their bootstrap intervals, which hold the score of the rows themselves."""
    tested = p.backtest(p.written_prices(spark, sf))[0].withColumn("error", F.col("rate") - F.col("prediction"))
    df = intervals.bootstrap_scores(tested, ["k", "model"], ["t"], "error", level=0.999)
    return _out(df.withColumn("ordered", (F.col("lower") <= F.col("value")) & (F.col("value") <= F.col("upper"))), "k", "model", "metric", "ordered", value=8)


@query(
    "clean_pipeline",
    with_ctes(
        f"""SELECT {_K}, round(value, 6) + 0.0 AS value, round((value - lag(value) OVER w) / nullif(lag(value) OVER w, 0) * 100, 6)
              + 0.0 AS value_monthly_rate, round((value - lag(value, 12) OVER w) / nullif(lag(value, 12) OVER w, 0) * 100, 6)
              + 0.0 AS value_annual_rate FROM filled WINDOW w AS (PARTITION BY k ORDER BY t)""",
        "gaps",
        **_points("gaps", "k", "t"),
        filled=f"SELECT k, t, {_LINEAR.format(end=', nv')} AS value FROM points",
    ),
)
def clean_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    df = pipeline.clean(p.gap_panel(spark, sf), p.NATION).panel
    return _out(df, "k", "t", value=6, value_monthly_rate=6, value_annual_rate=6)


@query("feature_pipeline", with_ctes(matrix_sql("panel"), "panel"))
def feature_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Every feature column of every nation and month."""
    return matrix_cells(pipeline.build_features(p.nation_panel(spark, sf).select("k", "t", "value"), p.NATION))


@query("train_pipeline")
def train_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of six models per series; those that cannot be fitted are listed as failed."""
    return pipeline.train(p.price_panel(spark, sf), p.RATE).metrics


@query(
    "forecast_pipeline",
    with_ctes(f"SELECT {_K}, model, round(prediction, 6) + 0.0 AS prediction, {_BAND} FROM chosen", "chosen"),
)
def forecast_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """The winner of the backtest carried twelve months ahead, with its interval."""
    prices = p.written_prices(spark, sf)
    df = pipeline.forecast(prices, p.RATE, p.backtest(prices)[1]).forecast
    return _out(df, "k", "t", "model", prediction=6, lower=6, upper=6)


_TYPES = ", ".join(f"'{m}'" for m in pipeline.MODELS)


@query(
    "forecast_winners",
    with_ctes(
        f"""SELECT k, [{_TYPES}][1 + (row_number() OVER (ORDER BY k) - 1) % 6] AS model, 12 AS steps,
              CAST(CAST(last + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS first_t, CAST(CAST(last + INTERVAL 12 MONTH AS DATE) AS VARCHAR) AS last_t,
              true AS ordered FROM (SELECT k, date_trunc('month', max(t)) AS last FROM panel GROUP BY k)""",
        "panel",
    ),
)
def forecast_winners(spark: SparkSession, sf: str) -> DataFrame:
    """Every model type wins for some nations: each is carried ahead by its own type, twelve ordered intervals each."""
    panel = p.nation_panel(spark, sf).select("k", "t", "value")
    ranked = panel.select("k").distinct().withColumn("_r", F.row_number().over(Window.orderBy("k")) - 1)
    models = F.posexplode(F.array(*[F.lit(m) for m in pipeline.MODELS])).alias("_i", "model")
    scored = ranked.select("k", "_r", models).withColumn("mae", F.when(F.col("_i") == F.col("_r") % 6, 1.0).otherwise(2.0))
    metrics = scored.select("k", "model", "mae", F.col("mae").alias("rmse"), F.col("mae").alias("mape"), F.lit("success").alias("status"))
    df = pipeline.forecast(panel, p.NATION, metrics).forecast
    inside = F.every((F.col("lower") <= F.col("prediction")) & (F.col("prediction") <= F.col("upper")))
    t = F.col("t").cast("date").cast("string")
    return df.groupBy("k", "model").agg(
        F.count(F.lit(1)).cast("int").alias("steps"), F.min(t).alias("first_t"), F.max(t).alias("last_t"), inside.alias("ordered")
    )


@query("end_to_end")
def end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Clean, train, forecast and analyse the yearly rate of the order value of every nation."""
    return pipeline.run(p.gap_panel(spark, sf), p.NATION)["analysis"]
