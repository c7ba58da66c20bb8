"""Tree ensembles on the panel's feature table (Spark ML)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.operators.dataset import expanding_folds
from panelwright.operators.layout import join_on
from panelwright.operators.seasonal import tail
from panelwright.session import cut_lineage
from panelwright.spec import SeriesSpec

# Forest parameters and the search grid (depth 30 is Spark's limit).
FOREST = {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 2, "seed": 42}
GRID = {"numTrees": (50, 100, 200), "maxDepth": (5, 10, 15, 30), "minInstancesPerNode": (1, 2, 4)}


def fit_forest(train: DataFrame, features: Sequence[str], target: str, **params) -> PipelineModel:
    """Assembler and forest; ``train`` has no NULLs in the features (see ``prepare_matrix``)."""
    forest = RandomForestRegressor(featuresCol="features", labelCol=target, **{**FOREST, **params})
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), forest]).fit(train)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``prediction``; refuses tables that lack a feature."""
    missing = set(model.stages[0].getInputCols()) - set(df.columns)
    if missing:
        raise ValueError(f"missing features: {sorted(missing)}")
    return model.transform(df)


def score_last(model: PipelineModel, df: DataFrame, spec: SeriesSpec, horizon: int = 12) -> DataFrame:
    """(keys, step, prediction, features): predictions for the last ``horizon`` known rows of each key."""
    rows = tail(df, spec, horizon)
    step = F.row_number().over(Window.partitionBy(*spec.keys).orderBy(*spec.order))
    return score(model, rows).select(*spec.keys, step.alias("step"), "prediction", "features")


def importances(model: PipelineModel) -> list[tuple[str, float]]:
    names = model.stages[0].getInputCols()
    values = model.stages[-1].featureImportances.toArray()
    return sorted(zip(names, map(float, values)), key=lambda x: (-x[1], x[0]))


def importance_table(model: PipelineModel, spark, top: int | None = None) -> DataFrame:
    """(rank, feature, importance); as long as the feature list."""
    rows = [(i + 1, n, v) for i, (n, v) in enumerate(importances(model))]
    return spark.createDataFrame(rows[:top], "rank int, feature string, importance double")


def select_by_forest(df: DataFrame, features: Sequence[str], target: str, **params) -> list[str]:
    """Features with at least the median importance."""
    ranked = importances(fit_forest(df, features, target, **params))
    values = sorted(v for _, v in ranked)
    middle = (values[(len(values) - 1) // 2] + values[len(values) // 2]) / 2
    return [n for n, v in ranked if v >= middle]


def label(params: Mapping) -> str:
    return ",".join(f"{k}={v}" for k, v in sorted(params.items()))


def growing_forests(grid: Sequence[Mapping]) -> list[tuple[dict, list[int]]]:
    """The grid by everything but the number of trees: (other parameters, numbers of trees in ascending order)."""
    grown: dict = {}
    for params in grid:
        rest = {k: v for k, v in params.items() if k != "numTrees"}
        grown.setdefault(label(rest), (rest, set()))[1].add(params.get("numTrees", FOREST["numTrees"]))
    return [(rest, sorted(sizes)) for rest, sizes in grown.values()]


def prefix_errors(train: DataFrame, test: DataFrame, features: Sequence[str], target: str, sizes: Sequence[int], **params) -> list[float]:
    """The mean absolute error of a forest at each of the growing ``sizes``.

    The trees of a forest do not depend on each other, so the first trees of a large one are a smaller one: only the trees
    that are new at each size are fitted, and one pass over the test rows scores all sizes.
    """
    scored, total, errors = test, F.lit(0.0), []
    for i, (before, size) in enumerate(zip([0, *sizes], sizes)):
        seed = params.get("seed", FOREST["seed"]) + i
        model = fit_forest(train, features, target, **{**params, "numTrees": size - before, "seed": seed})
        scored = model.transform(scored).withColumnRenamed("prediction", f"_p{i}").drop("features")
        total = total + (size - before) * F.col(f"_p{i}")
        errors.append(F.avg(F.abs(total / size - F.col(target))).alias(f"_e{i}"))
    return [float(x) if x is not None else float("nan") for x in scored.agg(*errors).first()]


def cross_validate(
    df: DataFrame, spec: SeriesSpec, features: Sequence[str], target: str, grid: Sequence[Mapping], folds: int = 5,
    parallelism: int = 8,
) -> DataFrame:
    """(model, fold, mae) of every parameter set on expanding windows.

    The folds are written once. Sets that differ in the number of trees share their trees. Fits run as concurrent Spark
    jobs; the driver holds one number per set and fold.
    """
    spark = df.sparkSession
    split = cut_lineage(expanding_folds(df, spec, folds).select("fold", "part", target, *features), "forest-folds")

    def run(job):
        fold, (rest, sizes) = job
        train, test = (split.where((F.col("fold") == fold) & (F.col("part") == p)) for p in ("train", "test"))
        errors = prefix_errors(train, test, features, target, sizes, **rest)
        return [(label({**rest, "numTrees": n}), fold, e) for n, e in zip(sizes, errors, strict=True)]

    with ThreadPoolExecutor(parallelism) as pool:
        rows = [r for part in pool.map(run, product(range(1, folds + 1), growing_forests(grid))) for r in part]
    return spark.createDataFrame(rows, "model string, fold int, mae double")


def cv_table(scores: DataFrame) -> DataFrame:
    """(model, cv_mae_mean, cv_mae_std, cv_folds)."""
    return scores.groupBy("model").agg(
        F.avg("mae").alias("cv_mae_mean"), F.stddev_pop("mae").alias("cv_mae_std"), F.count("mae").alias("cv_folds")
    )


def parameter_grid(**choices) -> list[dict]:
    return [dict(zip(choices, combo)) for combo in product(*choices.values())]


def tune(
    df: DataFrame, spec: SeriesSpec, features: Sequence[str], target: str, grid: Sequence[Mapping], folds: int = 5,
    scores: DataFrame | None = None,
) -> tuple[PipelineModel, dict, DataFrame]:
    """(model, parameters, table): the set with the smallest mean error, fitted again on all rows of ``df``.

    ``scores``: what ``cross_validate`` found for these rows, if it is known already.
    """
    table = cv_table(cross_validate(df, spec, features, target, grid, folds) if scores is None else scores)
    best = table.orderBy("cv_mae_mean", "model").first()["model"]  # one row per parameter set
    params = next(dict(g) for g in grid if label({"numTrees": FOREST["numTrees"], **g}) == best)
    return fit_forest(df, features, target, **params), params, table


def tree_interval(model: PipelineModel, scored: DataFrame, level: float = 0.95) -> DataFrame:
    """``lower`` and ``upper``: percentiles over the predictions of the single trees."""
    out = scored
    names = []
    for i, tree in enumerate(model.stages[-1].trees):
        name = f"_tree{i}"
        out = tree.setPredictionCol(name).setFeaturesCol("features").transform(out)
        names.append(name)
    out = out.withColumn("_sorted", F.array_sort(F.array(*names))).drop(*names)

    def at(p: float):
        place = (len(names) - 1) * p
        lo, share = int(place), place - int(place)
        hi = min(lo + 1, len(names) - 1)
        return F.col("_sorted")[lo] + (F.col("_sorted")[hi] - F.col("_sorted")[lo]) * share

    side = (1 - level) / 2
    return out.withColumns({"lower": at(side), "upper": at(1 - side), "level": F.lit(level)}).drop("_sorted")


def with_dates(scored: DataFrame, calendar: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Moves scored steps onto the future periods of the calendar."""
    return join_on(scored, calendar, [*spec.keys, "step"])


def recursive_forecast(
    model: PipelineModel, df: DataFrame, calendar: DataFrame, spec: SeriesSpec, lags: Sequence[int],
    parts: Callable[[DataFrame, str], DataFrame], lag_name: str = "{value}_lag_{k}", horizon: int = 12,
) -> DataFrame:
    """(keys, time, step, prediction): every step's prediction is the newest value of the next one.

    The state is one row per key: its last values, newest first. A step reads the lags from them, takes the date of its
    step from ``calendar`` (keys, step, time), adds the other features by ``parts``, scores, and puts the prediction in
    front. States are written in between, so a step scores each key once. Keys with fewer values than the longest lag
    have none for the missing ones and are left out, as in training.
    """
    (v,), keys, depth = spec.values, list(spec.keys), max(lags)
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in spec.order]))
    recent = tail(df.select(*keys, *spec.order, v).where(F.col(v).isNotNull()), spec, depth).withColumn("_at", at)
    newest = F.transform(F.array_sort(F.collect_list(F.struct("_at", F.col(v).cast("double").alias("_v")))), lambda x: x["_v"])
    state = recent.groupBy(*keys).agg(newest.alias("_values")).where(F.size("_values") >= depth).withColumn("_made", F.array().cast("array<double>"))
    state = cut_lineage(state, "forest-state")
    for step in range(1, horizon + 1):
        dated = join_on(state, calendar.where(F.col("step") == step).select(*keys, spec.time), keys)
        lagged = dated.select("*", *[F.get("_values", F.lit(k - 1)).alias(lag_name.format(value=v, k=k)) for k in lags])
        scored = score(model, parts(lagged, spec.time))
        pushed = F.concat(F.array("prediction"), F.slice("_values", 1, depth - 1)) if depth > 1 else F.array("prediction")
        state = cut_lineage(scored.select(*keys, pushed.alias("_values"), F.concat("_made", F.array("prediction")).alias("_made")), "forest-state")
    made = state.select(*keys, F.posexplode("_made").alias("_i", "prediction")).select(*keys, (F.col("_i") + 1).alias("step"), "prediction")
    return join_on(made, calendar, [*keys, "step"]).select(*keys, spec.time, "step", "prediction")
