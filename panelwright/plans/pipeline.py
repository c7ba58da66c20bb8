"""The operators composed: clean, features, train, forecast, analyse, end to end."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators import autoregressive as ar
from panelwright.operators import features as fe
from panelwright.operators import fill, quality, scoring, sequence, trees
from panelwright.operators.analysis import analyse
from panelwright.operators.checks import check_summary, forecast_checks
from panelwright.operators.dataset import chrono_split
from panelwright.operators.forecast import HORIZON, baseline_forecasts, future_calendar, test_grid
from panelwright.operators.intervals import normal_interval
from panelwright.operators.layout import join_on
from panelwright.session import cut_lineage
from panelwright.spec import SeriesSpec


@dataclass(frozen=True)
class Cleaned:
    panel: DataFrame
    outliers: DataFrame
    counts: DataFrame


def clean(panel: DataFrame, spec: SeriesSpec) -> Cleaned:
    """Missing periods and values filled, rates added, outliers listed (never removed)."""
    if panel.isEmpty():
        raise ValueError("the panel is empty")
    regular = fill.regularise(panel, spec) if spec.bounded else panel
    rated = fe.inflation_rates(fill.interpolate(regular, spec), spec)
    return Cleaned(rated, quality.outlier_rows(rated, spec), quality.outlier_counts(rated, spec))


def build_features(panel: DataFrame, spec: SeriesSpec) -> DataFrame:
    return fe.feature_matrix(panel, spec)


def feature_names(features: DataFrame, spec: SeriesSpec, target: str) -> list[str]:
    """Numeric columns that hold nothing of the target's own period."""
    taken = {*spec.keys, *spec.order, *spec.values, target}
    past = [f"{v}_lag_{k}" for v in spec.values for k in fe.LAGS]
    calendar = ["month", "quarter", "month_sin", "month_cos", "quarter_sin", "quarter_cos", *fe.SEASON_MONTHS]
    return [c for c in (*past, *calendar) if c in features.columns and c not in taken]


def _forest_rows(rows: DataFrame, spec: SeriesSpec) -> tuple[DataFrame, list[str]]:
    """The rows with what a forest may learn from, and the names of these columns."""
    (v,) = spec.values
    lagged = fe.lags(rows, spec).transform(fe.calendar_parts, spec.time).transform(fe.cyclical, spec.time)
    lagged = lagged.transform(fe.season_flags, spec.time)
    names = feature_names(lagged, spec, v)
    return fill.prepare_matrix(lagged, replace(spec, values=(*names, v)), v), names


MODELS = ("random_walk", "historic_mean", "ar1", "arima", "random_forest", "sequence")


@dataclass(frozen=True)
class Trained:
    """``tested``: test rows with each model's prediction; ``metrics``: scores per key and model."""

    tested: DataFrame
    metrics: DataFrame
    best: DataFrame


def train(panel: DataFrame, spec: SeriesSpec, forest_params: dict | None = None) -> Trained:
    """All models fitted on the oldest rows of each key and scored on the rest.

    A key a model cannot be fitted for gets a row of status 'failed' for it.
    ``panel`` has no NULLs in the (single) value.
    """
    keys, (v,) = list(spec.keys), spec.values
    split = chrono_split(panel.select(*keys, *spec.order, v), spec)
    split = cut_lineage(split, "split")
    fit_rows = split.where(F.col("part") == "train").drop("part")
    grid = test_grid(split, spec)
    columns = [*keys, *spec.order, v, "model", "prediction"]

    tested = baseline_forecasts(grid, fit_rows, spec).select(*columns)
    models, rows = ar.arima_fit(fit_rows, spec)
    steps = grid.agg(F.max("step")).first()[0] or 1
    ahead = ar.arima_forecast(models, rows, spec, horizon=int(steps))
    tested = tested.unionByName(
        join_on(grid, ahead, [*keys, "step"]).withColumn("model", F.lit("arima")).select(*columns)
    )

    matrix, names = _forest_rows(split, spec)
    forest = trees.fit_forest(matrix.where(F.col("part") == "train"), names, v, **(forest_params or {}))
    scored = trees.score(forest, matrix.where(F.col("part") == "test"))
    tested = tested.unionByName(scored.withColumn("model", F.lit("random_forest")).select(*columns))

    seq_rows, stats = sequence.training_sequences(split, spec)
    seq_model = sequence.fit_sequence_model(seq_rows, spec)
    seq = sequence.score_test(seq_model, seq_rows, stats, spec)
    tested = tested.unionByName(seq.withColumn("model", F.lit("sequence")).select(*columns))

    tested = cut_lineage(tested, "tested")
    scores = scoring.forecast_metrics(tested, [*keys, "model"], v)
    every = F.explode(F.array(*[F.lit(m) for m in MODELS])).alias("model")
    everyone = split.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(*keys, every)
    metrics = scoring.evaluate(join_on(everyone, scores, [*keys, "model"], "left"))
    return Trained(tested, metrics, scoring.best_model(metrics, keys))


@dataclass(frozen=True)
class Forecasted:
    forecast: DataFrame
    checks: DataFrame
    summary: DataFrame


def forecast(panel: DataFrame, spec: SeriesSpec, metrics: DataFrame, horizon: int = HORIZON, forest_params: dict | None = None) -> Forecasted:
    """The best model of each key, of whatever type, carried ``horizon`` periods ahead.

    Only types that win for some key are fitted again, on all known rows. A forest scores the last ``horizon`` rows of a
    key for the periods ahead and takes its interval from its trees; a sequence model feeds its predictions back.
    """
    keys, (v,) = list(spec.keys), spec.values
    known = cut_lineage(panel.select(*keys, *spec.order, v).where(F.col(v).isNotNull()), "known")
    calendar = cut_lineage(future_calendar(known, spec, horizon), "calendar")
    best = cut_lineage(scoring.best_model(metrics, keys), "best")
    winners = {r["model"] for r in best.select("model").distinct().collect()}  # at most one name per type
    columns = [*keys, spec.time, "prediction", "lower", "upper", "model", "level"]
    errors = metrics.select(*keys, "model", "rmse")

    def banded(predictions: DataFrame) -> DataFrame:
        return normal_interval(join_on(predictions, errors, [*keys, "model"], "left")).select(*columns)

    parts = [banded(baseline_forecasts(calendar, known, spec))]
    if "arima" in winners:
        models, rows = ar.arima_fit(known, spec)
        arima = join_on(calendar, ar.arima_forecast(models, rows, spec, horizon), [*keys, "step"])
        parts.append(arima.withColumn("model", F.lit("arima")).select(*columns))
    if "random_forest" in winners:
        matrix, names = _forest_rows(known, spec)
        forest = trees.fit_forest(matrix, names, v, **(forest_params or {}))
        last = trees.tree_interval(forest, trees.score_last(forest, matrix, spec, horizon))
        parts.append(trees.with_dates(last, calendar, spec).withColumn("model", F.lit("random_forest")).select(*columns))
    if "sequence" in winners:
        rows, stats = sequence.training_sequences(known.withColumn("part", F.lit("train")), spec)
        model = sequence.fit_sequence_model(rows, spec)
        path = sequence.recursive_forecast(model, sequence.last_sequences(known, spec, stats), stats, spec, horizon)
        parts.append(banded(join_on(calendar, path, [*keys, "step"]).withColumn("model", F.lit("sequence"))))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    chosen = cut_lineage(scoring.route(every, best, keys), "forecast")
    checks = forecast_checks(chosen, keys, spec.time)
    return Forecasted(chosen, checks, check_summary(checks, keys))


def run(panel: DataFrame, spec: SeriesSpec, forest_params: dict | None = None) -> dict[str, DataFrame]:
    """Clean, train, forecast and analyse the yearly rate of every key of a calendar panel."""
    (v,) = spec.values
    cleaned = clean(panel, spec)
    target = f"{v}_annual_rate"
    rates = spec.with_values(target)
    known = cut_lineage(cleaned.panel.where(F.col(target).isNotNull()), "rates")
    trained = train(known, rates, forest_params)
    ahead = forecast(known, rates, trained.metrics, forest_params=forest_params)
    return {
        "panel": cleaned.panel,
        "outliers": cleaned.outliers,
        "metrics": trained.metrics,
        "best": trained.best,
        "forecast": ahead.forecast,
        "checks": ahead.checks,
        "summary": ahead.summary,
        "analysis": analyse(known, ahead.forecast, trained.metrics, rates),
    }
