"""Profiles of tables and series as tidy DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.stats import sample_kurtosis, sample_skewness
from panelwright.operators.layout import join_on, settled
from panelwright.operators.quantiles import aggregate_with_quantiles, column_name, quantiles
from panelwright.spec import SeriesSpec

CORRELATION_BLOCK = 64
CORRELATION_HELD = 4_000_000
MOMENTS = ("_n", "_mx", "_my", "_xx", "_yy", "_xy")
NARROW_COLUMNS = 4


def _tidy(row: DataFrame, structs: Sequence[Column]) -> DataFrame:
    return row.select(F.inline(F.array(*structs)))


def dataset_info(df: DataFrame, time: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(df.columns)).alias("total_columns"),
        F.min(time).cast("date").alias("start_date"),
        F.max(time).cast("date").alias("end_date"),
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """(column, missing, percentage) of every column, in one pass."""
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    return _tidy(
        row,
        [
            F.struct(
                F.lit(c).alias("column"),
                (F.col("_n") - F.col(f"_c{i}")).alias("missing"),
                F.try_divide((F.col("_n") - F.col(f"_c{i}")) * 100.0, F.col("_n")).alias("percentage"),
            )
            for i, c in enumerate(df.columns)
        ],
    )


DESCRIBE_PROBS = (0.25, 0.5, 0.75)


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), bounded: bool = False) -> DataFrame:
    """(by, column, count, mean, std, min, q25, q50, q75, max) with exact quantiles."""
    by = list(by)
    aggs = []
    for c in columns:
        aggs += [
            F.count(c).alias(f"count_{c}"), F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"std_{c}"),
            F.min(c).cast("double").alias(f"min_{c}"), F.max(c).cast("double").alias(f"max_{c}"),
        ]
    both = join_on(df.groupBy(*by).agg(*aggs), quantiles(df, by, columns, DESCRIBE_PROBS, bounded=bounded), by)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"{m}_{c}").alias(m) for m in ("count", "mean", "std", "min")],
            *[F.col(column_name(c, i)).alias(q) for i, q in enumerate(("q25", "q50", "q75"))],
            F.col(f"max_{c}").alias("max"),
        )
        for c in columns
    ]
    return both.select(*by, F.inline(F.array(*rows)))


def _merged(one: Sequence[np.ndarray], two: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The moments of two sets of rows together; each is (n, means of x and y, centred squares of x and y, centred product)."""
    n, shift = one[0] + two[0], [b - a for a, b in zip(one[1:3], two[1:3], strict=True)]
    share = two[0] / np.maximum(n, 1.0)
    both = one[0] * share
    dx, dy = shift
    return [n, one[1] + dx * share, one[2] + dy * share, one[3] + two[3] + dx * dx * both, one[4] + two[4] + dy * dy * both, one[5] + two[5] + dx * dy * both]


def _block_moments(values: np.ndarray, p: slice, q: slice) -> list[np.ndarray]:
    """The moments of each column in p with each in q, over the rows where both are known."""
    known = ~np.isnan(values)
    middle = np.where(known.any(axis=0), np.where(known, values, 0.0).sum(axis=0) / np.maximum(known.sum(axis=0), 1), 0.0)
    z, m = np.where(known, values - middle, 0.0), known.astype(np.float64)
    n = m[:, p].T @ m[:, q]
    sx, sy = z[:, p].T @ m[:, q], m[:, p].T @ z[:, q]
    least = np.maximum(n, 1.0)
    squares = [(z[:, p] ** 2).T @ m[:, q] - sx * sx / least, m[:, p].T @ z[:, q] ** 2 - sy * sy / least]
    return [n, middle[p][:, None] + sx / least, middle[q][None, :] + sy / least, *squares, z[:, p].T @ z[:, q] - sx * sy / least]


def _known_moments(columns: Sequence[str], by: Sequence[str]):
    """Centred moments of every pair of columns, per group, for one Arrow batch after the other.

    Pairs are worked out as products of blocks of ``CORRELATION_BLOCK`` columns. A batch is centred on its own means and
    merged pairwise, so values far from zero, or groups far from each other, keep their digits. What has been gathered is
    passed on whenever it exceeds ``CORRELATION_HELD`` numbers.
    """
    size, k = CORRELATION_BLOCK, len(columns)
    spans = [range(i, min(i + size, k)) for i in range(0, k, size)]
    blocks = [(x, y) for i, x in enumerate(spans) for y in spans[i:]]

    def rows(held, keys):
        out = []
        for (group, n), parts in held.items():
            x, y = blocks[n]
            at = [(i, j) for i in range(len(x)) for j in range(len(y)) if x[i] < y[j]]
            pick = tuple(np.array(at, dtype=np.int64).reshape(-1, 2).T)
            frame = pd.DataFrame({c: [v] * len(at) for c, v in zip(by, keys.get(group, ()), strict=False)} | {"_a": [x[i] for i, _ in at], "_b": [y[j] for _, j in at]})
            out.append(frame.assign(**{name: part[pick] for name, part in zip(MOMENTS, parts, strict=True)}))
        return pd.concat(out, ignore_index=True) if out else None

    def add(batches):
        held: dict = {}
        keys: dict = {}
        numbers = 0
        for batch in batches:
            groups = batch.groupby(list(by), dropna=False, sort=False).indices.items() if by else [((), np.arange(len(batch)))]
            values = batch[list(columns)].to_numpy(dtype=np.float64, na_value=np.nan)
            for _, at in groups:
                first = batch[list(by)].iloc[at[0]].tolist() if by and len(at) else []
                group = tuple(None if v is None or v != v else v for v in first)
                keys[group] = first
                for n, (p, q) in enumerate(blocks):
                    new = _block_moments(values[at], slice(p.start, p.stop), slice(q.start, q.stop))
                    numbers += 0 if (group, n) in held else 6 * new[0].size
                    held[group, n] = _merged(held[group, n], new) if (group, n) in held else new
                if numbers > CORRELATION_HELD:
                    yield rows(held, keys)
                    held, keys, numbers = {}, {}, 0
        last = rows(held, keys)
        if last is not None:
            yield last

    return add


def _wide_correlations(named: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(by, _a, _b, r) of many columns: tasks gather moments, which Spark merges about their common mean."""
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in named.select(*by).schema) + "_a int, _b int, " + ", ".join(f"{s} double" for s in MOMENTS)
    parts = settled(named.mapInPandas(_known_moments(columns, by), schema).where("_n > 0"), "moments")
    keys = [*by, "_a", "_b"]
    n, mx, my = (F.col(c) for c in MOMENTS[:3])
    middle = parts.groupBy(*keys).agg((F.sum(n * mx) / F.sum(n)).alias("_ux"), (F.sum(n * my) / F.sum(n)).alias("_uy"))
    dx, dy = mx - F.col("_ux"), my - F.col("_uy")
    total = join_on(parts, settled(middle, "moment-means"), keys).groupBy(*keys).agg(
        F.sum(n).alias("_n"), F.sum(F.col("_xx") + n * dx * dx).alias("_xx"), F.sum(F.col("_yy") + n * dy * dy).alias("_yy"), F.sum(F.col("_xy") + n * dx * dy).alias("_xy")
    )
    spread = F.sqrt("_xx") * F.sqrt("_yy")
    r = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("_xy") / F.nullif(spread, F.lit(0.0))))
    return total.select(*keys, F.when((F.col("_n") > 1) & (spread > 0), r).alias("r"))


def correlations(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, a, b, r) for every pair of columns, over the rows where both have a value; NULL where r is not defined.

    Both ways keep mergeable centred moments (counts, means, squares and products about the means): Spark's own aggregates
    for a few columns, products of column blocks for many. Before, each group's least value is taken off, which is exact for
    values near each other, so groups far from zero keep all their digits. NaN counts as no value.
    """
    by, k = list(by), len(columns)
    named = df.select(*by, *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"_x{i}") for i, c in enumerate(columns)])
    least = named.groupBy(*by).agg(*[F.min(f"_x{i}").alias(f"_l{i}") for i in range(k)])
    named = join_on(named, settled(least, "least") if by else least, by).select(*by, *[(F.col(f"_x{i}") - F.col(f"_l{i}")).alias(f"_x{i}") for i in range(k)])
    names = F.array(*[F.lit(c) for c in columns])
    pick = lambda i: F.element_at(names, F.col(i) + 1)
    if k <= NARROW_COLUMNS:
        pairs = [(i, j) for i in range(k) for j in range(i + 1, k)]
        sums = [f(F.col(f"_x{i}"), F.col(f"_x{j}")).alias(f"_{n}{i}_{j}") for i, j in pairs for n, f in (("xx", F.regr_sxx), ("yy", F.regr_syy), ("xy", F.regr_sxy))]
        spread = lambda i, j: F.sqrt(f"_xx{i}_{j}") * F.sqrt(f"_yy{i}_{j}")
        r = lambda i, j: F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.try_divide(F.col(f"_xy{i}_{j}"), spread(i, j))))
        cells = [F.struct(F.lit(i).alias("_a"), F.lit(j).alias("_b"), F.when(spread(i, j) > 0, r(i, j)).alias("r")) for i, j in pairs]
        found = named.groupBy(*by).agg(*sums).select(*by, F.inline(F.array(*cells)))
    else:
        found = _wide_correlations(named, by, [f"_x{i}" for i in range(k)])
        if by:  # pairs without a row in common too
            every = df.select(*by).distinct().select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 2))).alias("_a")).select("*", F.explode(F.sequence(F.col("_a") + 1, F.lit(k - 1))).alias("_b"))
        else:
            every = df.sparkSession.range(k - 1).select(F.col("id").cast("int").alias("_a")).select("*", F.explode(F.sequence(F.col("_a") + 1, F.lit(k - 1))).alias("_b"))
        found = join_on(every, found, [*by, "_a", "_b"], "left")
    return found.select(*by, pick("_a").alias("a"), pick("_b").alias("b"), "r")


def shape(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, column, skewness, kurtosis), bias-corrected."""
    row = df.groupBy(*by).agg(
        *[sample_skewness(F.col(c)).alias(f"_s_{c}") for c in columns],
        *[sample_kurtosis(F.col(c)).alias(f"_k_{c}") for c in columns],
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"_s_{c}").alias("skewness"), F.col(f"_k_{c}").alias("kurtosis"))
        for c in columns
    ]
    return row.select(*by, F.inline(F.array(*rows)))


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def categorical_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, unique_values, most_frequent); equal counts go to the smallest value."""
    counts = _value_counts(df, columns)
    # largest count first, then smallest value: min over (-n, value)
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col("value").alias("v")))
    return counts.groupBy("column").agg(F.count("value").alias("unique_values"), best["v"].alias("most_frequent"))


def top_categories(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """(column, rank, value, n): the ``k`` most frequent values of each column.

    Spark keeps the best ``k`` per task before the final ranking.
    """
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value")))
    ranked = _value_counts(df, columns).withColumn("rank", rank)
    return ranked.where(F.col("rank") <= k).select("column", "rank", "value", "n")


def approx_distinct(df: DataFrame, columns: Sequence[str], rsd: float = 0.02) -> DataFrame:
    row = df.agg(*[F.approx_count_distinct(c, rsd).alias(f"_d_{c}") for c in columns])
    return _tidy(
        row, [F.struct(F.lit(c).alias("column"), F.col(f"_d_{c}").alias("approx_distinct")) for c in columns]
    )


# Rate limits of the inflation statistics and regimes.
TARGET_RATE = 2.0
HIGH_RATE = 3.0
LOW_RATE = 1.0


def rate_statistics(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Per key: location, spread and the periods above target or below zero."""
    (v,) = spec.values
    x = F.col(v)
    moments = [
        F.avg(x).alias("mean_rate"),
        F.stddev_samp(x).alias("std_rate"),
        F.min(x).alias("min_rate"),
        F.max(x).alias("max_rate"),
        F.count_if(x > TARGET_RATE).alias("periods_above_2_percent"),
        F.count_if(x < 0).alias("periods_deflation"),
    ]
    out = aggregate_with_quantiles(df, spec.keys, moments, v, [0.5], spec.bounded)
    return out.withColumnRenamed(column_name(v, 0), "median_rate")


def download_summary(df: DataFrame, time: str, columns: Sequence[str]) -> DataFrame:
    """(column, total_records, start, end, total_months, missing, mean, std, min, max), rounded to 4 places."""
    aggs = [
        F.count(F.lit(1)).alias("_n"), F.min(time).cast("date").alias("_lo"), F.max(time).cast("date").alias("_hi"),
        F.count_distinct(F.col(time)).alias("_t"),
    ]
    for c in columns:
        aggs += [
            F.count(c).alias(f"_c_{c}"), F.avg(c).alias(f"_a_{c}"), F.stddev_samp(c).alias(f"_s_{c}"),
            F.min(c).cast("double").alias(f"_i_{c}"), F.max(c).cast("double").alias(f"_x_{c}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("_n").alias("total_records"),
            F.col("_lo").alias("start_date"),
            F.col("_hi").alias("end_date"),
            F.col("_t").alias("total_months"),
            (F.col("_n") - F.col(f"_c_{c}")).alias("missing"),
            F.round(f"_a_{c}", 4).alias("mean"),
            F.round(f"_s_{c}", 4).alias("std"),
            F.round(f"_i_{c}", 4).alias("min"),
            F.round(f"_x_{c}", 4).alias("max"),
        )
        for c in columns
    ]
    return _tidy(df.agg(*aggs), rows)


# Name parts of each feature category, tried in this order.
FEATURE_CATEGORIES = (
    ("lag_features", ("_lag_",)),
    ("rolling_features", ("_ma_", "_std_", "_min_", "_max_")),
    ("seasonal_features", ("month", "quarter", "seasonal", "sin", "cos")),
    ("economic_indicators", (
        "_trend_", "_roc_", "_volatility_", "_cv_", "_position_", "_deviation_", "_zscore_", "_acceleration",
    )),
)


def feature_category(name: Column) -> Column:
    category = F.lit("other")
    for label, parts in reversed(FEATURE_CATEGORIES):
        category = F.when(name.rlike("|".join(parts)), label).otherwise(category)
    return category


def feature_summary(long: DataFrame) -> DataFrame:
    """(category, features, cells, missing) of a long feature table."""
    return (
        long.groupBy("feature")
        .agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("x").isNull()).alias("_m"))
        .withColumn("category", feature_category(F.col("feature")))
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("features"), F.sum("_n").alias("cells"), F.sum("_m").alias("missing"))
    )


def _regime_aggs(x: Column) -> list[Column]:
    return [
        F.count_if(x > HIGH_RATE).alias("high_inflation_periods"),
        F.count_if(x < LOW_RATE).alias("low_inflation_periods"),
        F.count_if(x < 0).alias("deflation_periods"),
        F.count_if((x >= LOW_RATE) & (x <= HIGH_RATE)).alias("stable_periods"),
    ]


def regime_counts(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.groupBy(*spec.keys).agg(*_regime_aggs(F.col(spec.values[0])))


def historical_statistics(df: DataFrame, spec: SeriesSpec, prefix: str = "", regimes: bool = False) -> DataFrame:
    """Per key: mean, median, population deviation, extremes, count and dispersion; on request regime counts."""
    (v,) = spec.values
    x = F.col(v)
    moments = [
        F.avg(x).alias("mean"),
        F.stddev_pop(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.count(x).alias("count"),
    ]
    counts = _regime_aggs(x) if regimes else []
    out = aggregate_with_quantiles(df, spec.keys, [*moments, *counts], v, (0.25, 0.5, 0.75), spec.bounded)
    q1, q2, q3 = (F.col(column_name(v, i)) for i in range(3))
    stats = {
        "mean": F.col("mean"), "median": q2, "std": F.col("std"), "min": F.col("min"), "max": F.col("max"),
        "count": F.col("count"),
        "coefficient_variation": F.when(F.col("mean") == 0, 0.0).otherwise(F.col("std") / F.abs("mean")),
        "range": F.col("max") - F.col("min"),
        "iqr": q3 - q1,
    }
    names = ["high_inflation_periods", "low_inflation_periods", "deflation_periods", "stable_periods"]
    return out.select(*spec.keys, *[c.alias(prefix + n) for n, c in stats.items()], *(names if regimes else []))


def prediction_aggs(spec: SeriesSpec) -> list[Column]:
    p, width = F.col("prediction"), F.col("upper") - F.col("lower")
    at = F.struct(*spec.order)
    first, last = F.min_by(width, at), F.max_by(width, at)
    return [
        F.count(p).alias("prediction_count"),
        F.min(spec.time).alias("start_date"),
        F.max(spec.time).alias("end_date"),
        F.avg(p).alias("mean_prediction"),
        F.percentile(p, F.lit(0.5)).alias("median_prediction"),
        F.stddev_pop(p).alias("std_prediction"),
        F.min(p).alias("min_prediction"),
        F.max(p).alias("max_prediction"),
        F.avg(width).alias("mean_width"),
        F.percentile(width, F.lit(0.5)).alias("median_width"),
        F.min(width).alias("min_width"),
        F.max(width).alias("max_width"),
        F.when(last > first, "increasing").when(F.count(F.lit(1)) > 1, "decreasing").otherwise("stable").alias(
            "confidence_trend"
        ),
    ]


def prediction_statistics(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Per key: forecast statistics and interval widths. Forecasts are a few rows per key."""
    return df.groupBy(*spec.keys).agg(*prediction_aggs(spec))


def bucket_aggs() -> list[Column]:
    p = F.col("prediction")
    return [
        F.count_if(p > HIGH_RATE).alias("high_inflation_months"),
        F.count_if((p >= LOW_RATE) & (p <= HIGH_RATE)).alias("moderate_inflation_months"),
        F.count_if((p >= 0) & (p < LOW_RATE)).alias("low_inflation_months"),
        F.count_if(p < 0).alias("deflation_months"),
    ]


def prediction_buckets(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.groupBy(*spec.keys).agg(*bucket_aggs())


def histogram(df: DataFrame, column: str, bins: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """(by, bin, lower, upper, n) over equal bins from minimum to maximum; the last bin is closed.

    A constant column gets a range of one around its value. Empty bins are not listed.
    """
    known = df.where(F.col(column).isNotNull())
    ends = known.groupBy(*by).agg(F.min(column).cast("double").alias("_lo"), F.max(column).cast("double").alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    ends = ends.select(
        *by,
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"),
    )
    share = (F.col(column) - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    placed = join_on(known, settled(ends, "ends") if by else ends, by).withColumn("bin", F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    return (
        placed.groupBy(*by, "bin", "_lo", "_hi")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            *by,
            "bin",
            (F.col("_lo") + width * F.col("bin")).alias("lower"),
            (F.col("_lo") + width * (F.col("bin") + 1)).alias("upper"),
            "n",
        )
    )


def boxplot(df: DataFrame, column: str, by: Sequence[str] = (), bounded: bool = False) -> DataFrame:
    """(by, q1, median, q3, whisker_low, whisker_high, fliers) with fences at 1.5 times the quartile range."""
    by = list(by)
    quart = quantiles(df, by, [column], (0.25, 0.5, 0.75), bounded=bounded)
    quart = quart.withColumnsRenamed({column_name(column, i): n for i, n in enumerate(("q1", "median", "q3"))})
    joined = join_on(df.select(*by, column), quart if bounded else settled(quart, "quartiles"), by)
    x, spread = F.col(column), F.col("q3") - F.col("q1")
    inside = (x >= F.col("q1") - 1.5 * spread) & (x <= F.col("q3") + 1.5 * spread)
    return joined.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("fliers"),
    )


# --- tables behind the charts --------------------------------------------------------


def history_and_forecast(history: DataFrame, forecast: DataFrame, spec: SeriesSpec) -> DataFrame:
    """(keys, t, series, value, lower, upper): the observed series followed by the forecast."""
    (v,) = spec.values
    empty = F.lit(None).cast("double")
    past = history.where(F.col(v).isNotNull()).select(
        *spec.keys, spec.time, F.lit("history").alias("series"), F.col(v).alias("value"),
        empty.alias("lower"), empty.alias("upper"),
    )
    ahead = forecast.select(
        *spec.keys, spec.time, F.lit("forecast").alias("series"), F.col("prediction").alias("value"), "lower", "upper"
    )
    return past.unionByName(ahead)


def interval_widths(forecast: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Width of each interval and the mean width of its key."""
    width = F.col("upper") - F.col("lower")
    return forecast.select(
        *spec.keys, spec.time, width.alias("width"),
        F.avg(width).over(Window.partitionBy(*spec.keys)).alias("mean_width"),
    )


def metrics_long(metrics: DataFrame, ids: Sequence[str]) -> DataFrame:
    return metrics.unpivot(list(ids), ["mae", "rmse", "mape"], "metric", "score")
