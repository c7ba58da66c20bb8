"""Regression on sliding sequences of a series and its recursive forecast."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.operators.dataset import scale_statistics, standardise
from panelwright.operators.layout import join_on, settled
from panelwright.operators.seasonal import sequences, tail
from panelwright.session import cut_lineage
from panelwright.spec import SeriesSpec

LENGTH = 12


def training_sequences(df: DataFrame, spec: SeriesSpec, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(rows, statistics): scaled sequences with their next value; scaling comes from the training rows.

    ``df`` carries ``part`` of a chronological split.
    """
    (v,) = spec.values
    known = df.where(F.col(v).isNotNull())
    stats = scale_statistics(known.where(F.col("part") == "train"), [v], spec.keys)
    stats = stats if spec.bounded else settled(stats, "scales")
    scaled = standardise(known, stats, [v], spec.keys)
    rows = sequences(scaled, spec, length).withColumn("features", array_to_vector("sequence"))
    return rows, stats


def fit_sequence_model(rows: DataFrame, spec: SeriesSpec, regressor=None):
    """One regression over the sequences of all series; any Spark ML regressor fits in."""
    (v,) = spec.values
    regressor = regressor or LinearRegression(regParam=1e-6)
    return regressor.setFeaturesCol("features").setLabelCol(v).fit(rows.where(F.col("part") == "train"))


def score_test(model, rows: DataFrame, stats: DataFrame, spec: SeriesSpec) -> DataFrame:
    """(keys, order, value, prediction) of the test rows on the original scale."""
    (v,) = spec.values
    scored = model.transform(rows.where(F.col("part") == "test"))
    back = join_on(scored, stats, spec.keys)
    return back.select(
        *spec.keys,
        *spec.order,
        (F.col(v) * F.col(f"sd_{v}") + F.col(f"mean_{v}")).alias(v),
        (F.col("prediction") * F.col(f"sd_{v}") + F.col(f"mean_{v}")).alias("prediction"),
    )


def last_sequences(df: DataFrame, spec: SeriesSpec, stats: DataFrame, length: int = LENGTH) -> DataFrame:
    """(keys, sequence): the newest ``length`` scaled values of each series that has them."""
    (v,) = spec.values
    rows = tail(standardise(df.where(F.col(v).isNotNull()), stats, [v], spec.keys), spec, length)
    pairs = F.array_sort(F.collect_list(F.struct(*spec.order, F.col(v))))  # at most ``length`` per key
    return (
        rows.groupBy(*spec.keys)
        .agg(pairs.alias("_p"))
        .select(*spec.keys, F.transform("_p", lambda p: p[v]).alias("sequence"))
        .where(F.size("sequence") == length)
    )


def _linear_path(model, horizon: int) -> Column:
    """The sequence with ``horizon`` predictions appended, as one expression."""
    weights = F.array(*[F.lit(float(c)) for c in model.coefficients])
    size = len(model.coefficients)

    def step(path: Column, _: Column) -> Column:
        recent = F.slice(path, F.size(path) - size + 1, F.lit(size))
        terms = F.zip_with(recent, weights, lambda x, c: x * c)
        ahead = F.aggregate(terms, F.lit(float(model.intercept)), lambda total, x: total + x)
        return F.concat(path, F.array(ahead))

    return F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("sequence"), step)


def _stepwise_path(model, last: DataFrame, horizon: int) -> DataFrame:
    """The same for any regressor: one round per step on one row per series, written in between."""
    state = last.withColumn("_path", F.col("sequence"))
    for _ in range(horizon):
        scored = model.transform(state.withColumn("features", array_to_vector("sequence")))
        state = cut_lineage(
            scored.withColumn("sequence", F.concat(F.slice("sequence", 2, F.size("sequence") - 1), F.array("prediction")))
            .withColumn("_path", F.concat("_path", F.array("prediction")))
            .drop("features", "prediction"),
            "recursive",
        )
    return state


def recursive_forecast(model, last: DataFrame, stats: DataFrame, spec: SeriesSpec, horizon: int = 12) -> DataFrame:
    """(keys, step, prediction): each step feeds its prediction back into the sequence."""
    (v,) = spec.values
    if isinstance(model, LinearRegressionModel):
        state = last.withColumn("_path", _linear_path(model, horizon))
    else:
        state = _stepwise_path(model, last, horizon)
    ahead = F.slice("_path", F.size("_path") - horizon + 1, F.lit(horizon))
    out = join_on(state.withColumn("_path", ahead), stats, spec.keys)
    steps = out.select(*spec.keys, f"sd_{v}", f"mean_{v}", F.posexplode("_path").alias("_i", "_z"))
    value = F.col("_z") * F.col(f"sd_{v}") + F.col(f"mean_{v}")
    return steps.select(*spec.keys, (F.col("_i") + 1).alias("step"), value.alias("prediction"))
