"""ARIMA family on aggregated normal equations.

Every regression is a sum of products per key: one aggregation shuffles a
fixed number of sums per key, however long its series is. Python only sees
those sums (a few dozen numbers per key) and solves them for a whole batch of
keys at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import comb, pi

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.stats import z_value
from panelwright.functions.windowed import lagged
from panelwright.operators.fill import cumulative
from panelwright.operators.layout import join_on, over_series, settled, with_slices
from panelwright.session import cut_lineage
from panelwright.spec import SeriesSpec

MAX_P, MAX_D, MAX_Q = 5, 2, 5
LONG_AR = 8
MAX_LAGS = 8
MAX_KPSS_LAGS = 24
# 5 % critical value of the unit-root test with a constant, as a
# polynomial in 1/n.
ADF_CRITICAL = (-2.86154, -2.8903, -4.234, -40.040)
# Fixed value: 5 % critical value of the test of stationarity around a level.
KPSS_CRITICAL = 0.463


def _schema(df: DataFrame, keys: Sequence[str], rest: str) -> str:
    own = [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys]
    return ", ".join([*own, rest])


def gram(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(by, n, gram): upper triangle of the cross products of 1 and the columns.

    Rows with a NULL in any column are left out.
    """
    known = df.dropna(subset=list(columns))
    terms = [F.lit(1.0), *[F.col(c).cast("double") for c in columns]]
    sums = [F.sum(a * b) for i, a in enumerate(terms) for b in terms[i:]]
    names = [f"_g{i}" for i in range(len(sums))]
    out = known.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[s.alias(n) for s, n in zip(sums, names)])
    return out.select(*by, "n", F.array(*names).alias("gram"))


def _square(flat: pd.Series, size: int) -> np.ndarray:
    upper = np.stack(flat.to_numpy())
    full = np.zeros((len(upper), size, size))
    rows, cols = np.triu_indices(size)
    full[:, rows, cols] = upper
    full[:, cols, rows] = upper
    return full


def _solve(g: np.ndarray, y: int, xs: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and residual sums of squares of column ``y`` on ``xs``, per key."""
    a, b = g[:, xs][:, :, xs], g[:, xs, y]
    ridge = 1e-10 * np.maximum(np.trace(a, axis1=1, axis2=2), 1e-12) / len(xs)
    coef = np.linalg.solve(a + ridge[:, None, None] * np.eye(len(xs)), b[..., None])[..., 0]
    return coef, np.maximum(g[:, y, y] - np.einsum("bi,bi->b", coef, b), 0.0)


def _stable(coef: np.ndarray) -> np.ndarray:
    """Whether all roots of the lag polynomial with these coefficients lie inside the unit circle, per key."""
    size = coef.shape[1]
    if size == 0:
        return np.ones(len(coef), bool)
    companion = np.zeros((len(coef), size, size))
    companion[:, 0, :] = coef
    companion[:, range(1, size), range(size - 1)] = 1.0
    return np.abs(np.linalg.eigvals(companion)).max(axis=1) < 1.0


# --- stationarity ----------------------------------------------------------------


def adf_critical(n: Column) -> Column:
    return sum(F.lit(c) / F.pow(n.cast("double"), F.lit(i)) for i, c in enumerate(ADF_CRITICAL))


def adf_lag0(df: DataFrame, spec: SeriesSpec, column: str | None = None) -> DataFrame:
    """(keys, n, tau, critical, stationary): unit-root test without lagged differences."""
    v = column or spec.values[0]
    lag = over_series(df, spec, lambda f: {"x1": lagged(F.col(v), 1, f)}, before=1)
    dy, x = F.col(v) - F.col("x1"), F.col("x1")
    slope, n = F.regr_slope(dy, x), F.regr_count(dy, x)
    rss = F.regr_syy(dy, x) - slope * F.regr_sxy(dy, x)
    error = F.sqrt(F.try_divide(F.try_divide(rss, n - 2), F.regr_sxx(dy, x)))
    out = lag.groupBy(*spec.keys).agg(n.alias("n"), F.try_divide(slope, error).alias("tau"))
    return out.withColumn("critical", adf_critical(F.col("n"))).withColumn(
        "stationary", F.coalesce(F.col("tau") <= F.col("critical"), F.lit(False))
    )


def adf(df: DataFrame, spec: SeriesSpec, lags: int, column: str | None = None) -> DataFrame:
    """The same test with ``lags`` lagged differences among the regressors."""
    v, keys = column or spec.values[0], list(spec.keys)

    def build(f):
        return {"lag0": F.col(v)} | {f"lag{k}": lagged(F.col(v), k, f) for k in range(1, lags + 2)}

    laid = over_series(df, spec, build, before=lags + 1)
    diffs = {f"d{k}": F.col(f"lag{k}") - F.col(f"lag{k + 1}") for k in range(lags + 1)}
    names = ["d0", "lag1", *[f"d{k}" for k in range(1, lags + 1)]]
    sums = gram(laid.select(*keys, "lag1", *[c.alias(n) for n, c in diffs.items()]), keys, names)
    size = len(names) + 1

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            g, n = _square(pdf["gram"], size), pdf["n"].to_numpy(float)
            xs = [0, *range(2, size)]
            coef, rss = _solve(g, 1, xs)
            a = g[:, xs][:, :, xs]
            var = np.linalg.pinv(a)[:, 1, 1] * rss / np.maximum(n - len(xs), 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                tau = coef[:, 1] / np.sqrt(var)
            tau[(n <= len(xs)) | ~np.isfinite(tau)] = np.nan
            yield pdf[keys].assign(n=pdf["n"], tau=tau)

    out = sums.mapInPandas(solve, _schema(df, keys, "n long, tau double"))
    tau = F.nanvl("tau", F.lit(None).cast("double"))
    return out.withColumn("tau", tau).withColumn("critical", adf_critical(F.col("n"))).withColumn(
        "stationary", F.coalesce(F.col("tau") <= F.col("critical"), F.lit(False))
    )


def _difference_row(order: int, shift: int, size: int) -> np.ndarray:
    """The weights of a series and its lags in the difference of this order, ``shift`` periods ago."""
    row = np.zeros(size)
    for j in range(order + 1):
        row[shift + j] = (-1) ** j * comb(order, j)
    return row


def _ols(g: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(t value of the second regressor, residual sum of squares); ``g``: cross products of y, 1, x, ..."""
    inverse = np.linalg.pinv(g[:, 1:, 1:], hermitian=True)
    coef = np.einsum("bij,bj->bi", inverse, g[:, 1:, 0])
    rss = np.maximum(g[:, 0, 0] - np.einsum("bi,bi->b", coef, g[:, 1:, 0]), 0.0)
    free = n - (g.shape[1] - 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        tau = coef[:, 1] / np.sqrt(inverse[:, 1, 1] * rss / np.where(free > 0, free, np.nan))
    return np.where(np.isfinite(tau), tau, np.nan), rss


def _lag_sums(df: DataFrame, spec: SeriesSpec, v: str, depth: int) -> DataFrame:
    """(keys, _all, _sums): cross products of 1, the series and ``depth`` lags, apart for rows with 0, 1, ... known lags.

    Values are centred and scaled per key, which no t value sees. Only a key's first rows, and those behind gaps, have
    fewer lags, so that a key has ``depth`` + 1 entries at most and every regression can take all rows that it may.
    """
    keys = list(spec.keys)
    scale = df.groupBy(*keys).agg(F.avg(v).alias("_m"), F.stddev_pop(v).alias("_sd"), F.count(v).alias("_all"))
    scaled = join_on(df.select(*keys, *spec.order, F.col(v).cast("double").alias("_v")), scale if spec.bounded else settled(scale, "scales"), keys)
    scaled = scaled.withColumn("w0", (F.col("_v") - F.col("_m")) / F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(1.0))
    names = [f"w{k}" for k in range(depth + 1)]
    laid = over_series(scaled, spec, lambda f: {n: lagged(F.col("w0"), k, f) for k, n in enumerate(names) if k}, before=depth)
    known = F.coalesce(*[F.when(F.col(n).isNull(), k - 1) for k, n in enumerate(names) if k], F.lit(depth))
    rows = laid.where("w0 IS NOT NULL").select(*keys, "_all", known.alias("_known"), *[F.coalesce(n, F.lit(0.0)).alias(n) for n in names])
    sums = gram(rows, [*keys, "_all", "_known"], names)
    return sums.groupBy(*keys, "_all").agg(F.collect_list(F.struct("_known", "n", "gram")).alias("_sums"))


def unit_root_sweep(df: DataFrame, spec: SeriesSpec, column: str | None = None, max_lags: int = MAX_LAGS, max_d: int = MAX_D) -> DataFrame:
    """(keys, d, lags, n, tau, aic, chosen): unit-root tests of the d-th difference with up to ``max_lags`` lagged differences.

    All of a key's regressions are linear in the same cross products, which one aggregation yields for every d and every
    number of lags. As usual the number of lags goes up to 12 (n / 100)^(1/4), is chosen by Akaike's criterion over the
    rows that all have (at least half of the rows: series with many gaps get fewer lags), and each test takes all rows it can.
    """
    v, keys = column or spec.values[0], list(spec.keys)
    depth = max_lags + max_d
    size = depth + 2

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            g, n = np.zeros((len(pdf), depth + 1, size, size)), np.zeros((len(pdf), depth + 1))
            rows, cols = np.triu_indices(size)
            for i, parts in enumerate(pdf["_sums"]):
                for part in parts:
                    g[i, part["_known"], rows, cols] = g[i, part["_known"], cols, rows] = part["gram"]
                    n[i, part["_known"]] = part["n"]
            g, n = (np.flip(np.cumsum(np.flip(x, axis=1), axis=1), axis=1) for x in (g, n))  # rows with so many lags or more
            total = pdf["_all"].to_numpy(float)
            for d in range(max_d):
                length = np.maximum(total - d, 0)
                most = np.minimum(np.ceil(12 * (length / 100) ** 0.25), np.maximum(length // 2 - 2, 0)).clip(0, max_lags).astype(int)
                enough = 2 * n[:, d + 1 : d + 2 + max_lags] >= n[:, d + 1 : d + 2]
                most = np.minimum(most, enough.cumprod(axis=1).sum(axis=1) - 1)
                one = np.eye(1, size)[0]
                wide = np.stack([_difference_row(d + 1, 1, size), one, _difference_row(d, 2, size), *[_difference_row(d + 1, 1 + k, size) for k in range(1, max_lags + 1)]])
                aic = np.full((len(pdf), max_lags + 1), np.inf)
                tests = []
                for lags in range(max_lags + 1):
                    a = wide[: lags + 3]
                    at = lags + d + 1
                    tau, _ = _ols(a @ g[:, at] @ a.T, n[:, at])
                    tests.append((tau, n[:, at]))
                    common = np.minimum(most + d + 1, depth)
                    own, rows_of = g[np.arange(len(pdf)), common], n[np.arange(len(pdf)), common]
                    _, rss = _ols(a @ own @ a.T, rows_of)
                    fits = (lags <= most) & (rows_of > lags + 2)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        score = rows_of * np.log(np.maximum(rss, 1e-300) / rows_of) + 2 * (lags + 2)
                    aic[fits, lags] = score[fits]
                best = np.where(np.isfinite(aic).any(axis=1), aic.argmin(axis=1), 0)
                for lags, (tau, rows_of) in enumerate(tests):
                    here = (lags <= most) & (rows_of > 0)
                    out = pdf[keys].assign(d=d, lags=lags, n=rows_of.astype("int64"), tau=tau, aic=np.where(np.isfinite(aic[:, lags]), aic[:, lags], np.nan), chosen=best == lags)
                    yield out[here]

    sums = _lag_sums(df, spec, v, depth)
    out = sums.mapInPandas(solve, _schema(sums, keys, "d int, lags int, n long, tau double, aic double, chosen boolean"))
    null = F.lit(None).cast("double")
    return out.withColumns({"tau": F.nanvl("tau", null), "aic": F.nanvl("aic", null)})


def differencing_order(df: DataFrame, spec: SeriesSpec, max_d: int = MAX_D, max_lags: int = MAX_LAGS) -> DataFrame:
    """(keys, d): the first difference order below ``max_d`` that the unit-root test calls stationary, else ``max_d``."""
    keys = list(spec.keys)
    tests = unit_root_sweep(df, spec, None, max_lags, max_d).where("chosen")
    stationary = F.coalesce(F.col("tau") <= adf_critical(F.col("n")), F.lit(False))
    found = tests.groupBy(*keys).agg(F.coalesce(F.min(F.when(stationary, F.col("d"))), F.lit(max_d)).alias("d"))
    if not keys:
        return found
    return join_on(df.select(*keys).distinct(), found, keys, "left").withColumn("d", F.coalesce("d", F.lit(max_d)))


def kpss(df: DataFrame, spec: SeriesSpec, column: str | None = None, max_lags: int = MAX_KPSS_LAGS, **layout) -> DataFrame:
    """(keys, n, lags, statistic, stationary): test of stationarity around a level.

    The squared partial sums of the centred series over its long-run variance, that with Bartlett weights over
    12 (n / 100)^(1/4) lags, ``max_lags`` at most. Partial sums are carried from block to block, so any length will do.
    NULLs are left out before.
    """
    v, keys = column or spec.values[0], list(spec.keys)
    known = df.select(*keys, *spec.order, F.col(v).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    spec = with_slices(known, spec).with_values("r")
    mean = known.groupBy(*keys).agg(F.avg("_v").alias("_m"))
    centred = join_on(known, mean if spec.bounded else settled(mean, "means"), keys).withColumn("r", F.col("_v") - F.col("_m"))
    summed = cumulative(centred.select(*keys, *spec.order, "r"), spec, **layout)
    laid = over_series(summed, spec, lambda f: {f"r{k}": lagged(F.col("r"), k, f) for k in range(1, max_lags + 1)}, before=max_lags, **layout)
    sums = [F.count("r").alias("n"), F.sum(F.col("r_cumsum") ** 2).alias("_s"), F.sum(F.col("r") ** 2).alias("_g0")]
    out = laid.groupBy(*keys).agg(*sums, *[F.coalesce(F.sum(F.col("r") * F.col(f"r{k}")), F.lit(0.0)).alias(f"_g{k}") for k in range(1, max_lags + 1)])
    n = F.col("n")
    out = out.withColumn("lags", F.least(F.floor(12 * F.pow(n / 100, F.lit(0.25))), n - 1, F.lit(max_lags)).cast("int"))
    weight = lambda k: F.greatest(1 - F.lit(k) / (F.col("lags") + 1), F.lit(0.0))
    spread = (F.col("_g0") + 2 * sum(weight(k) * F.col(f"_g{k}") for k in range(1, max_lags + 1))) / n
    out = out.withColumn("statistic", F.when(F.col("_g0") > 0, F.try_divide(F.col("_s") / (n * n), spread)))
    return out.select(*keys, "n", "lags", "statistic", F.coalesce(F.col("statistic") < KPSS_CRITICAL, F.lit(True)).alias("stationary"))


def _differences(df: DataFrame, spec: SeriesSpec, v: str) -> DataFrame:
    """Adds the value and its first and second difference as u0, u1, u2."""

    def build(f):
        c = F.col(v).cast("double")
        one, two = lagged(c, 1, f), lagged(c, 2, f)
        return {"u0": c, "u1": c - one, "u2": c - 2 * one + two}

    return over_series(df, spec, build, before=2)


# --- ARMA by two regressions ------------------------------------------------------


def _innovations(df: DataFrame, spec: SeriesSpec, orders: DataFrame, long_ar: int) -> DataFrame:
    """Rows with the differenced, standardised series ``w`` and estimated innovations ``e``.

    The innovations are the residuals of an autoregression of ``long_ar`` lags.
    """
    keys = list(spec.keys)
    (v,) = spec.values
    laid = join_on(_differences(df, spec, v), orders if spec.bounded else settled(orders, "orders"), keys)
    u = F.when(F.col("d") == 0, F.col("u0")).when(F.col("d") == 1, F.col("u1")).otherwise(F.col("u2"))
    laid = laid.withColumn("u", u).drop("u1", "u2")
    scale = laid.groupBy(*keys).agg(F.avg("u").alias("_m"), F.stddev_pop("u").alias("_sd"))
    scaled = join_on(laid, scale if spec.bounded else settled(scale, "scales"), keys)
    scaled = scaled.withColumn("w", F.try_divide(F.col("u") - F.col("_m"), F.col("_sd")))
    names = [f"w{k}" for k in range(1, long_ar + 1)]
    lagged_w = over_series(
        scaled, spec, lambda f: {n: lagged(F.col("w"), k + 1, f) for k, n in enumerate(names)}, before=long_ar
    )
    lagged_w = cut_lineage(lagged_w, "arma-lags")  # read twice: for the fit and for its residuals
    sums = gram(lagged_w, keys, ["w", *names])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = long_ar + 2
        for pdf in batches:
            if pdf.empty:
                continue
            coef, _ = _solve(_square(pdf["gram"], size), 1, [0, *range(2, size)])
            yield pdf[keys].assign(_a=list(coef))

    fits = sums.where(F.col("n") > 2 * (long_ar + 1)).mapInPandas(solve, _schema(df, keys, "_a array<double>"))
    fits = fits if spec.bounded else settled(fits, "long-fits")
    rows = join_on(lagged_w, fits, keys, "left")  # a series too short for it has no innovations
    fitted = F.col("_a")[0] + sum(F.col("_a")[k + 1] * F.col(n) for k, n in enumerate(names))
    return rows.withColumn("e", F.col("w") - fitted).drop("_a")


def _regressors(rows: DataFrame, spec: SeriesSpec, max_q: int) -> DataFrame:
    return over_series(
        rows, spec, lambda f: {f"e{k}": lagged(F.col("e"), k, f) for k in range(1, max_q + 1)}, before=max_q
    )


def _grid_scores(sums: DataFrame, keys: list[str], max_p: int, max_q: int) -> DataFrame:
    """All (p, q) models of a key from one matrix of sums; only stationary, invertible ones are kept."""
    size = 2 + max_p + max_q

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            g, n = _square(pdf["gram"], size), pdf["n"].to_numpy(float)
            unit = pdf["_sd"].to_numpy(float) ** 2
            for p in range(max_p + 1):
                for q in range(max_q + 1):
                    xs = [0, *range(2, 2 + p), *range(2 + max_p, 2 + max_p + q)]
                    coef, rss = _solve(g, 1, xs)
                    sigma2 = np.maximum(rss / n, 1e-12) * unit
                    fit, params = n * np.log(sigma2), p + q + 2
                    out = pdf[keys].assign(
                        p=p, q=q, n=pdf["n"], sigma2=sigma2, aic=fit + 2 * params, bic=fit + np.log(n) * params,
                        loglik=-0.5 * n * (np.log(2 * pi * sigma2) + 1),
                        const=coef[:, 0], ar=list(coef[:, 1 : 1 + p]), ma=list(coef[:, 1 + p :]),
                    )
                    sound = _stable(coef[:, 1 : 1 + p]) & _stable(-coef[:, 1 + p :])
                    yield out[sound & (n > len(xs) + 1)]

    rest = (
        "p int, q int, n long, sigma2 double, aic double, bic double, loglik double, const double, "
        "ar array<double>, ma array<double>"
    )
    return sums.mapInPandas(solve, _schema(sums, keys, rest))


def arma_rows(
    df: DataFrame, spec: SeriesSpec, orders: DataFrame, max_p: int = MAX_P, max_q: int = MAX_Q, long_ar: int = LONG_AR
) -> DataFrame:
    """The regression rows of all orders: w, its lags, e and its lags; a written table."""
    rows = _regressors(_innovations(df, spec, orders, max(long_ar, max_p)), spec, max_q)
    return cut_lineage(rows, "arma-rows")


def order_search(rows: DataFrame, spec: SeriesSpec, max_p: int = MAX_P, max_q: int = MAX_Q) -> DataFrame:
    """(keys, p, q, aic, bic, ...) for the whole grid, from one aggregation.

    Constant and coefficients belong to the standardised series, variance and
    criteria to the differenced one.
    """
    keys = list(spec.keys)
    columns = ["w", *[f"w{k}" for k in range(1, max_p + 1)], *[f"e{k}" for k in range(1, max_q + 1)]]
    return _grid_scores(gram(rows, [*keys, "_sd"], columns), keys, max_p, max_q)


def best_order(scores: DataFrame, keys: Sequence[str], criterion: str = "aic") -> DataFrame:
    """The grid row with the smallest criterion per key; ties go to the smaller order."""
    if criterion not in ("aic", "bic"):
        raise ValueError(f"unknown criterion {criterion!r}")
    fields = [c for c in scores.columns if c not in keys]
    row = F.struct(F.col(criterion).alias("_c"), F.col("p").alias("_p"), F.col("q").alias("_q"))
    best = scores.groupBy(*keys).agg(F.min_by(F.struct(*fields), row).alias("_b"))
    return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in fields])


def fallback_models(rows: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The model rows of a first-order autoregression, or of a constant where that is not stationary, for every key.

    They need no innovations, so a few rows are enough.
    """
    y, x = F.col("w"), F.col("w1")
    sums = rows.groupBy(*spec.keys).agg(
        F.regr_slope(y, x).alias("phi"), F.regr_intercept(y, x).alias("icept"), F.regr_count(y, x).alias("pairs"),
        (F.regr_syy(y, x) - F.regr_slope(y, x) * F.regr_sxy(y, x)).alias("rss"),
        F.count(y).alias("rows"), F.avg(y).alias("mean"), F.var_pop(y).alias("var"), F.max("_sd").alias("sd"),
    )
    one = F.coalesce((F.col("pairs") > 3) & (F.abs("phi") < 1), F.lit(False))
    n = F.greatest(F.when(one, F.col("pairs")).otherwise(F.col("rows")), F.lit(1))
    spread = F.when(one, F.col("rss") / F.greatest(F.col("pairs"), F.lit(1))).otherwise(F.col("var")) * F.col("sd") ** 2
    made = sums.withColumns({"p": F.when(one, 1).otherwise(0), "q": F.lit(0), "n": n, "sigma2": F.greatest(F.coalesce(spread, F.lit(0.0)), F.lit(1e-12))})
    fit, params = F.col("n") * F.log("sigma2"), F.col("p") + 2
    none = F.array().cast("array<double>")
    return made.select(
        *spec.keys, "p", "q", "n", "sigma2", (fit + 2 * params).alias("aic"), (fit + F.log("n") * params).alias("bic"),
        (-0.5 * F.col("n") * (F.log(2 * pi * F.col("sigma2")) + 1)).alias("loglik"),
        F.coalesce(F.when(one, F.col("icept")).otherwise(F.col("mean")), F.lit(0.0)).alias("const"),
        F.when(one, F.array("phi")).otherwise(none).alias("ar"), none.alias("ma"),
    )


def arima_fit(
    df: DataFrame, spec: SeriesSpec, max_p: int = MAX_P, max_d: int = MAX_D, max_q: int = MAX_Q,
    criterion: str = "aic", long_ar: int = LONG_AR,
) -> tuple[DataFrame, DataFrame]:
    """(models, rows): per key the chosen order and coefficients, and the regression rows.

    Keys too short for the grid get the small model of ``fallback_models``.
    """
    keys = list(spec.keys)
    spec = with_slices(df, spec)
    orders = differencing_order(df, spec, max_d)
    rows = arma_rows(df, spec, orders, max_p, max_q, long_ar)
    best = cut_lineage(best_order(order_search(rows, spec, max_p, max_q), keys, criterion), "arma-best")
    best = best.unionByName(join_on(fallback_models(rows, spec), best, keys, "left_anti").select(best.columns))
    d = rows.groupBy(*keys).agg(F.max("d").alias("d"))
    return cut_lineage(join_on(best, d, keys), "arma-models"), rows


def _model_residual(max_p: int, max_q: int) -> Column:
    """w minus the fitted value; missing coefficients count as zero."""
    term = lambda a, k, c: F.coalesce(F.get(F.col(a), F.lit(k - 1)), F.lit(0.0)) * F.col(f"{c}{k}")
    return (
        F.col("w")
        - F.col("const")
        - sum(term("ar", k, "w") for k in range(1, max_p + 1))
        - sum(term("ma", k, "e") for k in range(1, max_q + 1))
    )


def residuals(models: DataFrame, rows: DataFrame, spec: SeriesSpec, max_p: int = MAX_P, max_q: int = MAX_Q) -> DataFrame:
    """(keys, order, residual) of each key's model, in units of the differenced series."""
    keys = list(spec.keys)
    fitted = join_on(rows, models.select(*keys, "const", "ar", "ma"), keys)
    return fitted.select(
        *keys, *spec.order, (_model_residual(max_p, max_q) * F.col("_sd")).alias("residual")
    ).where(F.col("residual").isNotNull())


def chi2_tail(x: Column, dof: int) -> Column:
    """Upper tail of a chi-square variable with an even number of degrees of freedom."""
    if dof % 2:
        raise ValueError("even degrees of freedom only")
    half, term, total = x / 2, F.lit(1.0), F.lit(1.0)
    for i in range(1, dof // 2):
        term = term * half / i
        total = total + term
    return F.exp(-half) * total


def ljung_box(df: DataFrame, spec: SeriesSpec, column: str = "residual", lags: int = 10, **layout) -> DataFrame:
    """(keys, n, residual_mean, residual_std, ljung_box, p_value, autocorrelated)."""
    names = [f"_r{k}" for k in range(1, lags + 1)]
    laid = over_series(df, spec, lambda f: {n[1:]: lagged(F.col(column), k, f) for k, n in enumerate(names, 1)}, before=lags, **layout)
    return ljung_box_of(laid, list(spec.keys), F.col(column), [F.col(n[1:]) for n in names])


def ljung_box_of(laid: DataFrame, keys: Sequence[str], residual: Column, lagged_residuals: Sequence[Column]) -> DataFrame:
    """The same from rows that hold their residual and its lags: one aggregate, the means taken off the sums of products."""
    lags = len(lagged_residuals)
    rows = laid.select(*keys, residual.alias("_r0"), *[c.alias(f"_r{k}") for k, c in enumerate(lagged_residuals, 1)])
    r = F.col("_r0")
    sums = [F.count(r).alias("n"), F.avg(r).alias("residual_mean"), F.stddev_samp(r).alias("residual_std"), F.var_pop(r).alias("_v")]
    for k in range(1, lags + 1):
        both = F.when(r.isNotNull() & F.col(f"_r{k}").isNotNull(), F.lit(1.0))
        sums += [F.sum(both).alias(f"_n{k}"), F.covar_pop(r, f"_r{k}").alias(f"_c{k}"), F.avg(both * r).alias(f"_a{k}"), F.avg(both * F.col(f"_r{k}")).alias(f"_b{k}")]
    out = rows.groupBy(*keys).agg(*sums)
    n, mean = F.col("n"), F.col("residual_mean")
    # The sum of (r - mean)(lag - mean) over the pairs, from their own covariance and means.
    products = [F.col(f"_n{k}") * (F.col(f"_c{k}") + (F.col(f"_a{k}") - mean) * (F.col(f"_b{k}") - mean)) for k in range(1, lags + 1)]
    rho = [F.try_divide(F.coalesce(c, F.lit(0.0)), n * F.col("_v")) for c in products]
    q = n * (n + 2) * sum(F.try_divide(p * p, n - k) for k, p in enumerate(rho, 1))
    out = out.withColumn("ljung_box", q).withColumn("p_value", chi2_tail(F.col("ljung_box"), lags))
    return out.withColumn("autocorrelated", F.col("p_value") < 0.05).select(
        *keys, "n", "residual_mean", "residual_std", "ljung_box", "p_value", "autocorrelated"
    )


def diagnostics(models: DataFrame, rows: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Residual statistics, Ljung-Box test and fit criteria per key."""
    test = ljung_box(residuals(models, rows, spec), spec)
    return join_on(test, models.select(*spec.keys, "p", "d", "q", "loglik", "aic", "bic"), spec.keys)


def arima_forecast(
    models: DataFrame, rows: DataFrame, spec: SeriesSpec, horizon: int = 12, level: float = 0.95,
    max_p: int = MAX_P, max_q: int = MAX_Q,
) -> DataFrame:
    """(keys, step, prediction, lower, upper, level) on the scale of the input.

    The recursion runs on levels: the autoregressive and the differencing
    polynomial are multiplied, so forecasts need no separate integration. The
    variance comes from the same polynomial's impulse weights.
    """
    keys = list(spec.keys)
    depth = max_p + MAX_D
    recent = over_series(
        rows, spec, lambda f: {"ys": F.array(*[lagged(F.col("u0"), k, f) for k in range(depth)])}, before=depth
    )
    es = F.array(F.col("e"), *[F.col(f"e{k}") for k in range(1, max_q)]) if max_q else F.array(F.lit(0.0))
    last = recent.groupBy(*keys).agg(
        F.max_by(F.struct("ys", es.alias("es"), "_m", "_sd"), F.struct(*spec.order)).alias("_l")
    )
    at = join_on(models, last, keys).select(*keys, "d", "sigma2", "const", "ar", "ma", "_l.*")
    z = z_value(level)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            size = len(pdf)
            pad = lambda s, m: np.stack([np.pad(np.asarray(a, float), (0, m - len(a))) for a in s])
            phi, theta = pad(pdf["ar"], max_p), pad(pdf["ma"], max(max_q, 1))
            sd, mean = pdf["_sd"].to_numpy(float), pdf["_m"].to_numpy(float)
            const = mean * (1 - phi.sum(axis=1)) + sd * pdf["const"].to_numpy(float)
            poly = np.concatenate([np.ones((size, 1)), -phi, np.zeros((size, MAX_D))], axis=1)
            for step in range(MAX_D):
                shifted = np.concatenate([np.zeros((size, 1)), poly[:, :-1]], axis=1)
                poly = np.where((pdf["d"].to_numpy() > step)[:, None], poly - shifted, poly)
            weights = -poly[:, 1:]
            ys = np.nan_to_num(np.stack(pdf["ys"].to_numpy()).astype(float))
            es = np.nan_to_num(np.stack(pdf["es"].to_numpy()).astype(float)) * sd[:, None]
            impulse = np.concatenate([np.ones((size, 1)), np.zeros((size, depth - 1))], axis=1)
            spread = np.sqrt(pdf["sigma2"].to_numpy(float))
            variance = np.zeros(size)
            for h in range(1, horizon + 1):
                variance = variance + (impulse[:, 0] * spread) ** 2
                y = const + (weights * ys).sum(axis=1) + (theta * es).sum(axis=1)
                psi = (weights * impulse).sum(axis=1) + (theta[:, h - 1] if h <= theta.shape[1] else 0.0)
                ys = np.concatenate([y[:, None], ys[:, :-1]], axis=1)
                es = np.concatenate([np.zeros((size, 1)), es[:, :-1]], axis=1)
                impulse = np.concatenate([psi[:, None], impulse[:, :-1]], axis=1)
                margin = z * np.sqrt(variance)
                yield pdf[keys].assign(step=h, prediction=y, lower=y - margin, upper=y + margin, level=level)

    rest = "step int, prediction double, lower double, upper double, level double"
    return at.mapInPandas(run, _schema(at, keys, rest))
