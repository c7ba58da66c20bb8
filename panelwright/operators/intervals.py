"""Intervals around point forecasts."""

from __future__ import annotations

from collections.abc import Sequence
from math import exp, factorial

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.stats import z_value

LEVEL = 0.95
DEFAULT_ERROR = 0.1  # half-width unit where neither a spread nor an RMSE is known


def _around(df: DataFrame, margin: Column, level: float) -> DataFrame:
    p = F.col("prediction")
    return df.withColumns({"lower": p - margin, "upper": p + margin, "level": F.lit(level)})


def normal_interval(df: DataFrame, level: float = LEVEL) -> DataFrame:
    """prediction +- z * RMSE of the validation; needs an ``rmse`` column, NULL counts as 0.1."""
    return _around(df, z_value(level) * F.coalesce(F.col("rmse"), F.lit(DEFAULT_ERROR)), level)


def spread_interval(df: DataFrame, by: Sequence[str], level: float = LEVEL) -> DataFrame:
    """prediction +- z * population deviation of the forecasts of a group; 0.1 for a single one."""
    over = Window.partitionBy(*by)  # a forecast has as many rows as its horizon
    sd = F.when(F.count("prediction").over(over) > 1, F.stddev_pop("prediction").over(over)).otherwise(DEFAULT_ERROR)
    return _around(df, z_value(level) * sd, level)


def dispersion_interval(df: DataFrame, by: Sequence[str], level: float = LEVEL) -> DataFrame:
    """As ``spread_interval``, but a single forecast falls back to the RMSE."""
    over = Window.partitionBy(*by)
    fallback = F.coalesce(F.col("rmse"), F.lit(DEFAULT_ERROR))
    sd = F.when(F.count("prediction").over(over) > 1, F.stddev_pop("prediction").over(over)).otherwise(fallback)
    return _around(df, z_value(level) * sd, level)


# Which interval 'auto' gives a model type; the first keeps its own.
OWN_INTERVAL_TYPES = ("ARIMA",)
DISPERSION_TYPES = ("RandomForest",)


def add_interval(df: DataFrame, by: Sequence[str], method: str = "auto", level: float = LEVEL) -> DataFrame:
    """Interval by method: 'normal', 'bootstrap' (dispersion) or 'auto' by ``model_type`` row by row."""
    if method == "normal":
        return normal_interval(df, level)
    if method == "bootstrap":
        return dispersion_interval(df, by, level)
    if method != "auto":
        raise ValueError(f"unknown method {method!r}")
    own = F.col("model_type").isin(*OWN_INTERVAL_TYPES)
    spread = F.col("model_type").isin(*DISPERSION_TYPES)
    kept = df.withColumns({"_lo": F.col("lower"), "_up": F.col("upper")})
    wide = dispersion_interval(kept, by, level).withColumnsRenamed({"lower": "_dlo", "upper": "_dup"})
    both = normal_interval(wide, level)
    pick = lambda k, d, n: F.when(own, F.col(k)).when(spread, F.col(d)).otherwise(F.col(n))
    return both.withColumns({"lower": pick("_lo", "_dlo", "lower"), "upper": pick("_up", "_dup", "upper")}).drop(
        "_lo", "_up", "_dlo", "_dup"
    )


# --- bootstrap of errors ---------------------------------------------------------------

REPLICATES = 400


def _uniform(h: np.ndarray, replicate: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from row hashes and replicate numbers: the same wherever and in whatever order rows are read."""
    x = h.view(np.uint64)[:, None] + replicate.astype(np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53


def bootstrap_scores(
    df: DataFrame, keys: Sequence[str], ids: Sequence[str], error: str, level: float = 0.95, replicates: int = REPLICATES, seed: int = 0
) -> DataFrame:
    """(keys, metric, value, lower, upper): bias, mae and rmse of each key with bootstrap intervals.

    Rows are resampled by Poisson weights, drawn from a hash of (row, replicate), so no row is copied or collected and
    reruns agree. A replicate is a few weighted sums: tasks add up theirs, Spark adds up the tasks'; a key has
    ``replicates`` + 1 rows, however many errors it has. ``ids`` tell a key's rows apart. NULL errors are left out; a
    replicate that draws no row of a key has no scores.
    """
    keys = list(keys)
    known = df.where(F.col(error).isNotNull()).select(*keys, F.xxhash64(F.lit(seed), *keys, *ids).alias("_h"), F.col(error).cast("double").alias("_e"))
    steps = np.cumsum([exp(-1) / factorial(k) for k in range(18)])
    names = ["_w", "_s", "_a", "_q"]

    def draw(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            code = pdf.groupby(keys, dropna=False, sort=False).ngroup().to_numpy() if keys else np.zeros(len(pdf), dtype=int)
            order = np.argsort(code, kind="stable")
            begin = np.flatnonzero(np.diff(code[order], prepend=-1))
            h, e = pdf["_h"].to_numpy(np.int64)[order], pdf["_e"].to_numpy(float)[order]
            first = pdf.iloc[order[begin]][keys]
            for at in range(0, replicates + 1, 50):
                chosen = np.arange(at, min(at + 50, replicates + 1))
                weight = np.searchsorted(steps, _uniform(h, chosen), side="right").astype(float)
                weight[:, chosen == 0] = 1.0  # the rows as they are
                sums = [np.add.reduceat(weight * x[:, None], begin, axis=0) for x in (np.ones(len(e)), e, np.abs(e), e * e)]
                out = first.loc[first.index.repeat(len(chosen))].reset_index(drop=True)
                yield out.assign(_b=np.tile(chosen, len(begin)), **{n: x.ravel() for n, x in zip(names, sums, strict=True)})

    schema = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys) + "_b int, " + ", ".join(f"{n} double" for n in names)
    total = known.mapInPandas(draw, schema).groupBy(*keys, "_b").agg(*[F.sum(n).alias(n) for n in names])
    per = lambda c: F.try_divide(F.col(c), F.col("_w"))
    scores = total.select(*keys, "_b", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), x.alias("x")) for m, x in (("bias", per("_s")), ("mae", per("_a")), ("rmse", F.sqrt(per("_q"))))
    ])))
    drawn, side = F.when(F.col("_b") > 0, F.col("x")), (1 - level) / 2
    ends = F.percentile(drawn, F.array(F.lit(side), F.lit(1 - side)))
    found = scores.groupBy(*keys, "metric").agg(F.max(F.when(F.col("_b") == 0, F.col("x"))).alias("value"), ends.alias("_i"))
    return found.select(*keys, "metric", "value", F.col("_i")[0].alias("lower"), F.col("_i")[1].alias("upper"))
