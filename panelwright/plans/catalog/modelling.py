"""Data sets, feature selection, models, scoring."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.operators import autoregressive as ar
from panelwright.operators import dataset, scoring, selection, sequence, trees
from panelwright.operators import features as fe
from panelwright.operators import fill
from panelwright.operators.forecast import ar1_fit, future_calendar
from panelwright.operators.layout import join_on, over_series, settled, with_slices
from panelwright.operators.profile import metrics_long
from panelwright.functions.windowed import lagged
from panelwright.plans import panels as p
from panelwright.plans.catalog import query
from panelwright.plans.panels import rounded, with_ctes
from panelwright.session import cut_lineage, scratch_path
from panelwright.sources import models as store

_K = "k, CAST(t AS VARCHAR) AS t"


def _text_t(df: DataFrame, **places: int) -> DataFrame:
    out = df.withColumn("t", F.col("t").cast("string")) if "t" in df.columns else df
    return out.withColumns({c: rounded(F.col(c), n) for c, n in places.items()})


# --- data sets ------------------------------------------------------------------------


@query(
    "align_xy",
    with_ctes(
        """SELECT p.k, CAST(p.t AS VARCHAR) AS t, p.n, round(r.annual_rate, 6) + 0.0 AS annual_rate FROM panel p
           JOIN rates r ON p.k = r.k AND p.t = r.t WHERE r.annual_rate IS NOT NULL""",
        "rates",
    ),
)
def align_xy(spark: SparkSession, sf: str) -> DataFrame:
    x = p.nation_panel(spark, sf).select("k", "t", "n")
    y = p.rate_panel(spark, sf).select("k", "t", "annual_rate").where("annual_rate IS NOT NULL")
    return _text_t(dataset.align(x, y, p.NATION), annual_rate=6)


_TICK_W = "(PARTITION BY event_type ORDER BY ts, event_id)"
_TICK_SPLIT = f"""SELECT *, CASE WHEN row_number() OVER {_TICK_W}
    <= floor(count(*) OVER (PARTITION BY event_type) * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS part FROM events"""


@query("chrono_split", f"SELECT event_id, part FROM ({_TICK_SPLIT})")
def chrono_split(spark: SparkSession, sf: str) -> DataFrame:
    return dataset.chrono_split(p.ticks(spark, sf), p.TICKS).select("event_id", "part")


_TICK_STATS = """SELECT event_type, avg(value) AS m, CASE WHEN stddev_pop(value) = 0 THEN 1 ELSE stddev_pop(value) END AS sd
    FROM split WHERE part = 'train' GROUP BY event_type"""


def _tick_scale(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    split = dataset.chrono_split(p.ticks(spark, sf), p.TICKS)
    stats = dataset.scale_statistics(split.where("part = 'train'"), ["value"], ["event_type"])
    return split, settled(stats, "scales")


@query(
    "standardise",
    f"""WITH split AS ({_TICK_SPLIT}), stats AS ({_TICK_STATS})
        SELECT event_id, part, round((value - m) / sd, 8) + 0.0 AS value FROM split JOIN stats USING (event_type)""",
)
def standardise(spark: SparkSession, sf: str) -> DataFrame:
    split, stats = _tick_scale(spark, sf)
    return _text_t(dataset.standardise(split, stats, ["value"], ["event_type"]).select("event_id", "part", "value"), value=8)


@query("unstandardise", "SELECT event_id, round(value, 4) + 0.0 AS value FROM events")
def unstandardise(spark: SparkSession, sf: str) -> DataFrame:
    split, stats = _tick_scale(spark, sf)
    scaled = dataset.standardise(split, stats, ["value"], ["event_type"])
    return _text_t(dataset.unstandardise(scaled, stats, ["value"], ["event_type"]).select("event_id", "value"), value=4)


@query(
    "expanding_folds",
    f"""SELECT event_id, CAST(fold AS INTEGER) AS fold, CASE WHEN pos <= first THEN 'train' ELSE 'test' END AS part FROM (
          SELECT event_id, fold, pos, width, size - (6 - fold) * width AS first FROM (
            SELECT event_id, row_number() OVER {_TICK_W} AS pos, count(*) OVER (PARTITION BY event_type) AS size,
                   count(*) OVER (PARTITION BY event_type) // 6 AS width FROM events),
            (SELECT unnest(generate_series(1, 5)) AS fold))
        WHERE pos <= first + width""",
)
def expanding_folds(spark: SparkSession, sf: str) -> DataFrame:
    return dataset.expanding_folds(p.ticks(spark, sf), p.TICKS).select("event_id", "fold", "part")


# --- selection ----------------------------------------------------------------------------

_PICKS = [f"value_lag_{k}" for k in fe.LAGS] + ["value_ma_3", "value_ma_12", "value_std_6"]
_TICK_FEATURES = f"""SELECT event_id, value, {", ".join(f"lag(value, {k}) OVER {_TICK_W} AS value_lag_{k}" for k in fe.LAGS)},
    avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS 2 PRECEDING) AS value_ma_3,
    avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS 11 PRECEDING) AS value_ma_12,
    stddev_samp(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS 5 PRECEDING) AS value_std_6 FROM events"""
_TICK_LONG = f"FROM feats UNPIVOT INCLUDE NULLS (x FOR feature IN ({', '.join(_PICKS)}))"


def _tick_features(spark: SparkSession, sf: str) -> DataFrame:
    df = fe.lags_and_rolling(p.ticks(spark, sf), p.TICKS, stats=("ma", "std"))
    return df.select("event_type", "ts", "event_id", "value", *_PICKS)


@query(
    "select_by_correlation",
    f"""WITH feats AS ({_TICK_FEATURES}) SELECT feature, round(abs(corr(x, value)), 8) + 0.0 AS r
        FROM ({_TICK_LONG}) GROUP BY feature HAVING abs(corr(x, value)) > 0.1""",
)
def select_by_correlation(spark: SparkSession, sf: str) -> DataFrame:
    long = selection.long_with_target(_tick_features(spark, sf), _PICKS, "value")
    return _text_t(selection.by_correlation(long, "value"), r=8)


@query(
    "select_by_variance",
    f"""WITH feats AS ({_TICK_FEATURES}) SELECT feature, round(variance, 6) + 0.0 AS variance FROM (
          SELECT *, max(variance) OVER () AS m FROM (SELECT feature, var_samp(x) AS variance FROM ({_TICK_LONG}) GROUP BY 1))
        WHERE variance > m * 0.01""",
)
def select_by_variance(spark: SparkSession, sf: str) -> DataFrame:
    long = selection.long_with_target(_tick_features(spark, sf), _PICKS, "value")
    return _text_t(selection.by_variance(long), variance=6)


@query(
    "prune_collinear",
    f"WITH feats AS ({_TICK_FEATURES}) SELECT f AS feature FROM ("
    + " UNION ALL ".join(
        f"SELECT '{b}' AS f, " + (" OR ".join(f"abs(corr({a}, {b})) > 0.6" for a in _PICKS[:i]) or "count(*) < 0") + " AS out FROM feats"
        for i, b in enumerate(_PICKS)
    )
    + ") WHERE NOT out",
)
def prune_collinear(spark: SparkSession, sf: str) -> DataFrame:
    return selection.prune_collinear(_tick_features(spark, sf), _PICKS, 0.6)


_WIDE = [
    f"CASE WHEN (l_orderkey + {i}) % {5 + i % 4} = 0 THEN NULL ELSE CAST({c} AS DOUBLE) * {1 + i % 3} + {i} * (l_partkey % 11) END AS {c[2:]}_{i}"
    for i in range(9)
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
] + ["CAST(NULL AS DOUBLE) AS nothing"]
_WIDE_NAMES = [c.rsplit(" ", 1)[1] for c in _WIDE]


@query(
    "prune_collinear_wide",
    f"WITH feats AS (SELECT {', '.join(_WIDE)} FROM lineitem) SELECT f AS feature FROM ("
    + " UNION ALL ".join(
        f"SELECT '{b}' AS f, " + (" OR ".join(f"coalesce(abs(corr({a}, {b})), 0) > 0.93" for a in _WIDE_NAMES[:i]) or "count(*) < 0") + " AS out FROM feats"
        for i, b in enumerate(_WIDE_NAMES)
    )
    + ") WHERE NOT out",
)
def prune_collinear_wide(spark: SparkSession, sf: str) -> DataFrame:
    """More columns than any pairwise limit, with gaps and a column that is never known."""
    return selection.prune_collinear(p.table(spark, sf, "lineitem").selectExpr(*_WIDE), _WIDE_NAMES, 0.93)


_MI_FEATURES = ("l_quantity", "l_discount", "l_tax")
_MI_BIN = " + ".join("CAST({c} > q_{c}[%d] AS INTEGER)" % i for i in range(1, 8))
_MI_SQL = f"""WITH cuts AS (SELECT {", ".join(
        f"quantile_cont({c}, [{', '.join(f'CAST({i / 8} AS DOUBLE)' for i in range(1, 8))}]) AS q_{c}"
        for c in (*_MI_FEATURES, "l_extendedprice"))} FROM lineitem),
    binned AS (SELECT {_MI_BIN.format(c="l_extendedprice")} AS yb, {", ".join(f"{_MI_BIN.format(c=c)} AS {c}" for c in _MI_FEATURES)}
               FROM lineitem CROSS JOIN cuts),
    cells AS (SELECT feature, xb, yb, CAST(count(*) AS DOUBLE) AS n
              FROM (FROM binned UNPIVOT (xb FOR feature IN ({", ".join(_MI_FEATURES)}))) GROUP BY 1, 2, 3),
    scored AS (SELECT feature, sum(n / total * ln(n * total / (nx * ny))) AS mi FROM (SELECT *,
                 sum(n) OVER (PARTITION BY feature) AS total, sum(n) OVER (PARTITION BY feature, xb) AS nx,
                 sum(n) OVER (PARTITION BY feature, yb) AS ny FROM cells) GROUP BY feature)"""


@query("binned_mutual_information", f"{_MI_SQL} SELECT feature, round(mi, 8) + 0.0 AS mi FROM scored")
def binned_mutual_information(spark: SparkSession, sf: str) -> DataFrame:
    df = selection.mutual_information(p.table(spark, sf, "lineitem"), _MI_FEATURES, "l_extendedprice")
    return _text_t(df, mi=8)


@query(
    "select_by_mutual_information",
    f"{_MI_SQL} SELECT feature, round(mi, 8) + 0.0 AS mi FROM scored WHERE mi > (SELECT median(mi) FROM scored)",
)
def select_by_mutual_information(spark: SparkSession, sf: str) -> DataFrame:
    df = selection.by_mutual_information(p.table(spark, sf, "lineitem"), _MI_FEATURES, "l_extendedprice")
    return _text_t(df, mi=8)


# --- autoregression ----------------------------------------------------------------------------


@query(
    "ar1_fit",
    with_ctes(
        """SELECT event_type, round(regr_slope(value, y1), 8) + 0.0 AS phi, round(regr_intercept(value, y1), 6) + 0.0 AS intercept,
             round((regr_syy(value, y1) - regr_slope(value, y1) * regr_sxy(value, y1)) / (regr_count(value, y1) - 2), 4) + 0.0
               AS sigma2, CAST(regr_count(value, y1) AS BIGINT) AS n
           FROM lagged GROUP BY event_type""",
        lagged=f"SELECT event_type, value, lag(value) OVER {_TICK_W} AS y1 FROM events",
    ),
)
def fit_ar1(spark: SparkSession, sf: str) -> DataFrame:
    return _text_t(ar1_fit(p.ticks(spark, sf), p.TICKS), phi=8, intercept=6, sigma2=4)


_ADF = """{key}n, tau, -2.86154 - 2.8903 / n - 4.234 / (n * n) - 40.040 / (n * n * n) AS critical FROM (
    SELECT {key}CAST(regr_count(dy, y1) AS DOUBLE) AS n, regr_slope(dy, y1) / nullif(sqrt((regr_syy(dy, y1)
      - regr_slope(dy, y1) * regr_sxy(dy, y1)) / nullif(regr_count(dy, y1) - 2, 0) / nullif(regr_sxx(dy, y1), 0)), 0) AS tau
    FROM (SELECT {key}{v} - lag({v}) OVER {w} AS dy, lag({v}) OVER {w} AS y1 FROM {source}) GROUP BY {group})"""


def _adf_sql(source: str, v: str, key: str = "k", w: str = "(PARTITION BY k ORDER BY t)") -> str:
    return "SELECT " + _ADF.format(key=f"{key}, ", v=v, w=w, source=source, group=key)


@query(
    "adf_lag0",
    with_ctes(
        """SELECT k, CAST(n AS BIGINT) AS n, round(tau, 6) + 0.0 AS tau, round(critical, 6) + 0.0 AS critical,
             coalesce(tau <= critical, false) AS stationary FROM test""",
        "panel",
        test=_adf_sql("panel", "value"),
    ),
)
def adf_lag0(spark: SparkSession, sf: str) -> DataFrame:
    return _text_t(ar.adf_lag0(p.nation_panel(spark, sf), p.NATION), tau=6, critical=6)


_KPSS_LAGS = ", ".join(f"lag(r, {k}) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS r{k}" for k in range(1, 25))
_KPSS_SUM = " + ".join(f"greatest(1 - {k} / (l + 1.0), 0) * coalesce(sum(r * r{k}), 0)" for k in range(1, 25))


@query(
    "kpss",
    with_ctes(
        """SELECT event_type, n, CAST(l AS INTEGER) AS lags, round(s / (CAST(n AS DOUBLE) * n) / (g / n), 6) + 0.0 AS statistic,
             s / (CAST(n AS DOUBLE) * n) / (g / n) < 0.463 AS stationary FROM found""",
        centred="SELECT *, value - avg(value) OVER (PARTITION BY event_type) AS r, count(*) OVER (PARTITION BY event_type) AS n FROM events",
        rows_=f"""SELECT event_type, r, n, least(floor(12 * pow(n / 100.0, 0.25)), n - 1, 24) AS l, {_KPSS_LAGS},
             sum(r) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS total FROM centred""",
        found=f"SELECT event_type, n, l, sum(total * total) AS s, sum(r * r) + 2 * ({_KPSS_SUM}) AS g FROM rows_ GROUP BY event_type, n, l",
    ),
)
def kpss(spark: SparkSession, sf: str) -> DataFrame:
    """Stationarity of every event type's readings around their level, with partial sums carried over blocks."""
    return _text_t(ar.kpss(p.ticks(spark, sf), p.TICKS), statistic=6)


@query("adf_lagged")
def adf_lagged(spark: SparkSession, sf: str) -> DataFrame:
    return ar.adf(p.ticks(spark, sf), p.TICKS, lags=4)


def _sweep_ctes(source: str) -> dict[str, str]:
    """The unit-root tests of a series and its difference with no and with one lagged difference, in closed form."""
    return {
        "u": f"""SELECT k, t, 0 AS d, value AS u FROM {source} UNION ALL
            SELECT k, t, 1 AS d, value - lag(value) OVER (PARTITION BY k ORDER BY t) AS u FROM {source}""",
        "r": """SELECT k, d, u - lag(u) OVER w AS y, lag(u) OVER w AS x, lag(u) OVER w - lag(u, 2) OVER w AS z FROM u
            WINDOW w AS (PARTITION BY k, d ORDER BY t)""",
        "zero": """SELECT k, d, CAST(regr_count(y, x) AS BIGINT) AS n, regr_slope(y, x)
              / sqrt((regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x)) / (regr_count(y, x) - 2) / regr_sxx(y, x)) AS tau
            FROM r GROUP BY k, d""",
        "s": """SELECT k, d, CAST(regr_count(y, x) AS BIGINT) AS n, regr_syy(y, x) AS yy, regr_sxx(y, x) AS xx, regr_sxy(y, x) AS xy,
              regr_sxx(y, z) AS zz, regr_sxy(y, z) AS zy, regr_sxy(x, z) AS xz
            FROM r WHERE x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL GROUP BY k, d""",
        "f": "SELECT *, xx * zz - xz * xz AS det, (zz * xy - xz * zy) / (xx * zz - xz * xz) AS b, (xx * zy - xz * xy) / (xx * zz - xz * xz) AS c FROM s",
        "o": "SELECT *, yy - b * xy - c * zy AS rss, n * ln((yy - xy * xy / xx) / n) + 4 AS aic0, n * ln((yy - b * xy - c * zy) / n) + 6 AS aic1 FROM f",
        "tests": """SELECT zero.k, zero.d, 0 AS lags, zero.n, zero.tau, aic0 <= aic1 AS chosen FROM zero JOIN o ON o.k = zero.k AND o.d = zero.d
            UNION ALL SELECT k, d, 1 AS lags, n, b / sqrt(rss / (n - 3) * zz / det) AS tau, aic1 < aic0 AS chosen FROM o""",
    }


@query(
    "unit_root_lags",
    with_ctes(
        "SELECT k, CAST(d AS INTEGER) AS d, CAST(lags AS INTEGER) AS lags, n, round(tau, 4) + 0.0 AS tau, chosen FROM tests",
        "panel",
        **_sweep_ctes("panel"),
    ),
)
def unit_root_lags(spark: SparkSession, sf: str) -> DataFrame:
    """Every nation's tests with no and one lagged difference, and which one Akaike's criterion takes."""
    tests = ar.unit_root_sweep(p.nation_panel(spark, sf), p.NATION, "value", max_lags=1)
    return _text_t(tests.select("k", "d", "lags", "n", "tau", "chosen"), tau=4)


@query(
    "differencing_order",
    with_ctes(
        """SELECT k, CAST(coalesce(min(d) FILTER (tau <= -2.86154 - 2.8903 / n - 4.234 / (n * n) - 40.040 / (n * n * n)), 2) AS INTEGER) AS d
           FROM tests WHERE chosen GROUP BY k""",
        "panel",
        levels="SELECT k, t, sum(value) OVER (PARTITION BY k ORDER BY t ROWS UNBOUNDED PRECEDING) AS value FROM panel",
        **_sweep_ctes("levels"),
    ),
)
def differencing_order(spark: SparkSession, sf: str) -> DataFrame:
    """Of the running totals of each nation, which grow and must be differenced; no or one lagged difference."""
    totals = fill.cumulative(p.nation_panel(spark, sf).select("k", "t", "value"), p.NATION)
    levels = totals.select("k", "t", F.col("value_cumsum").alias("value"))
    return ar.differencing_order(levels, p.NATION, max_lags=1)


_LB_SUMS = ", ".join(f"sum(r * lag{k}) / nullif(sum(r * r), 0) AS rho{k}" for k in range(1, 11))
_LB_LAGS = ", ".join(f"lag(r, {k}) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS lag{k}" for k in range(1, 11))
_LB_Q = " + ".join(f"rho{k} * rho{k} / (n - {k})" for k in range(1, 11))


@query(
    "ljung_box",
    with_ctes(
        """SELECT event_type, n, round(q, 6) + 0.0 AS ljung_box,
             round(exp(-q / 2) * (1 + q / 2 + pow(q / 2, 2) / 2 + pow(q / 2, 3) / 6 + pow(q / 2, 4) / 24), 8) + 0.0 AS p_value,
             round(sd, 6) + 0.0 AS residual_std FROM stat""",
        fits=f"""SELECT event_type, regr_slope(value, y1) AS phi, regr_intercept(value, y1) AS c
                 FROM (SELECT event_type, value, lag(value) OVER {_TICK_W} AS y1 FROM events) GROUP BY 1""",
        resid=f"""SELECT event_type, ts, event_id, value - c - phi * y1 AS e FROM (
                 SELECT *, lag(value) OVER {_TICK_W} AS y1 FROM events) JOIN fits USING (event_type) WHERE y1 IS NOT NULL""",
        centred="SELECT *, e - avg(e) OVER (PARTITION BY event_type) AS r FROM resid",
        lagged=f"SELECT event_type, e, r, {_LB_LAGS} FROM centred",
        rhos=f"SELECT event_type, count(*) AS n, stddev_samp(e) AS sd, {_LB_SUMS} FROM lagged GROUP BY event_type",
        stat=f"SELECT event_type, n, sd, CAST(n AS DOUBLE) * (n + 2) * ({_LB_Q}) AS q FROM rhos",
    ),
)
def ljung_box(spark: SparkSession, sf: str) -> DataFrame:
    """Autocorrelation left in the residuals of a first-order autoregression."""
    lags = 10
    laid = over_series(p.ticks(spark, sf), p.TICKS, lambda f: {f"y{k}": lagged(F.col("value"), k, f) for k in range(1, lags + 2)}, before=lags + 1)
    laid = cut_lineage(laid.withColumn("y0", F.col("value").cast("double")), "lags")
    fits = laid.groupBy("event_type").agg(F.regr_slope("y0", "y1").alias("phi"), F.regr_intercept("y0", "y1").alias("c"))
    rows = join_on(laid, settled(fits, "fits"), ["event_type"])
    residual = lambda k: F.col(f"y{k}") - F.col("c") - F.col("phi") * F.col(f"y{k + 1}")
    df = ar.ljung_box_of(rows, ["event_type"], residual(0), [residual(k) for k in range(1, lags + 1)])
    return _text_t(
        df.select("event_type", "n", "ljung_box", "p_value", "residual_std"), ljung_box=6, p_value=8, residual_std=6
    )


def _arima(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return ar.arima_fit(cut_lineage(p.nation_panel(spark, sf).select("k", "t", "value"), "panel"), p.NATION)


@query("arma_order_search")
def arma_order_search(spark: SparkSession, sf: str) -> DataFrame:
    """All 36 orders of each event type's series, from one aggregation."""
    ticks = p.ticks(spark, sf)
    spec = with_slices(ticks, p.TICKS)
    rows = ar.arma_rows(ticks, spec, ar.differencing_order(ticks, spec))
    return ar.order_search(rows, spec).select("event_type", "p", "q", "n", "aic", "bic")


@query("arima_fit")
def arima_fit(spark: SparkSession, sf: str) -> DataFrame:
    return _arima(spark, sf)[0]


@query("arima_diagnostics")
def arima_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    models, rows = _arima(spark, sf)
    return ar.diagnostics(models, rows, p.NATION)


@query("arima_forecast")
def arima_forecast(spark: SparkSession, sf: str) -> DataFrame:
    models, rows = _arima(spark, sf)
    ahead = ar.arima_forecast(models, rows, p.NATION)
    return join_on(future_calendar(p.nation_panel(spark, sf), p.NATION), ahead, ["k", "step"])


# --- trees and sequences ----------------------------------------------------------------------------

_FOREST: dict = {}  # the library's parameters


def _learning_table(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """Lagged values and calendar columns of every nation with the part of the split."""
    df = fe.lags(p.nation_panel(spark, sf).select("k", "t", "value"), p.NATION)
    df = df.transform(fe.calendar_parts, "t").transform(fe.cyclical, "t").transform(fe.season_flags, "t")
    names = [f"value_lag_{k}" for k in fe.LAGS] + ["month", "quarter", "month_sin", "month_cos", "is_summer", "is_christmas"]
    spec = replace(p.NATION, values=(*names, "value"))
    return cut_lineage(dataset.chrono_split(fill.prepare_matrix(df, spec, "value"), p.NATION), "learning"), names


def _forest(spark: SparkSession, sf: str):
    df, names = _learning_table(spark, sf)
    return trees.fit_forest(df.where("part = 'train'"), names, "value", **_FOREST), df, names


@query("forest_scores")
def forest_scores(spark: SparkSession, sf: str) -> DataFrame:
    model, df, _ = _forest(spark, sf)
    scored = trees.score(model, df.where("part = 'test'")).withColumn("model", F.lit("random_forest"))
    return scoring.forecast_metrics(scored, ["k", "model"])


@query("forest_importance")
def forest_importance(spark: SparkSession, sf: str) -> DataFrame:
    return trees.importance_table(_forest(spark, sf)[0], spark, 5)


@query("forest_selection")
def forest_selection(spark: SparkSession, sf: str) -> DataFrame:
    df, names = _learning_table(spark, sf)
    picked = trees.select_by_forest(df, names, "value", **_FOREST)
    return spark.createDataFrame([(n,) for n in picked], "feature string")


@query("forest_interval")
def forest_interval(spark: SparkSession, sf: str) -> DataFrame:
    """Forecasts of the last twelve known rows with percentiles over the trees, on future dates."""
    model, df, _ = _forest(spark, sf)
    scored = trees.tree_interval(model, trees.score_last(model, df, p.NATION))
    dated = trees.with_dates(scored, future_calendar(df, p.NATION), p.NATION)
    return dated.select("k", "t", "step", "prediction", "lower", "upper", "level")


_SETS = " UNION ALL ".join(f"SELECT '{trees.label(g)}' AS model" for g in trees.parameter_grid(**trees.GRID))


_CV_SCORES: dict[tuple[str, str], DataFrame] = {}


def _cv_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Five scores of every set of the whole grid on the training rows; minutes of fits, so written once a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CV_SCORES:
        df, names = _learning_table(spark, sf)
        scores = trees.cross_validate(df.where("part = 'train'").drop("part"), p.NATION, names, "value", trees.parameter_grid(**trees.GRID))
        _CV_SCORES[key] = cut_lineage(scores, "cv")
    return _CV_SCORES[key]


@query("forest_cross_validation", f"SELECT model, CAST(5 AS BIGINT) AS cv_folds, true AS within FROM ({_SETS})")
def forest_cross_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Every parameter set has five scores, and a mean between the least and the largest of them."""
    scores = _cv_scores(spark, sf)
    ends = scores.groupBy("model").agg(F.min("mae").alias("lo"), F.max("mae").alias("hi"))
    within = F.col("cv_mae_mean").between(F.col("lo"), F.col("hi")) & (F.col("cv_mae_std") <= F.col("hi") - F.col("lo")) & (F.col("lo") > 0)
    return trees.cv_table(scores).join(ends, "model").select("model", "cv_folds", within.alias("within"))


@query("forest_grid_search")
def forest_grid_search(spark: SparkSession, sf: str) -> DataFrame:
    """Test scores of the parameter set that did best on expanding windows of the training rows."""
    df, names = _learning_table(spark, sf)
    train = df.where("part = 'train'").drop("part")
    model, params, _ = trees.tune(train, p.NATION, names, "value", trees.parameter_grid(**trees.GRID), scores=_cv_scores(spark, sf))
    scored = trees.score(model, df.where("part = 'test'")).withColumn("model", F.lit(trees.label(params)))
    return scoring.forecast_metrics(scored, ["k", "model"])


@query("model_reload")
def model_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of a forest that was saved and loaded again by name."""
    model, df, _ = _forest(spark, sf)
    root = scratch_path(spark, "models")
    store.save_model(model, root, "random_forest", "RandomForest", spark, _FOREST)
    return trees.score(store.load_model(spark, root, "random_forest"), df.where("part = 'test'")).select("k", "t", "prediction")


@query("sequence_model")
def sequence_model(spark: SparkSession, sf: str) -> DataFrame:
    """Twelve values predict the next one; trained on the events of all types, scored on the newest fifth."""
    ticks = p.ticks(spark, sf)
    spec = with_slices(ticks, p.TICKS)
    rows, stats = sequence.training_sequences(dataset.chrono_split(ticks, spec), spec)
    rows = cut_lineage(rows.drop("features"), "sequences").withColumn("features", array_to_vector("sequence"))
    scored = sequence.score_test(sequence.fit_sequence_model(rows, spec), rows, stats, spec)
    return scoring.forecast_metrics(scored.withColumn("model", F.lit("sequence")), ["event_type", "model"])


@query("sequence_forecast")
def sequence_forecast(spark: SparkSession, sf: str) -> DataFrame:
    split = cut_lineage(dataset.chrono_split(p.nation_panel(spark, sf).select("k", "t", "value"), p.NATION), "split")
    rows, stats = sequence.training_sequences(split, p.NATION)
    model = sequence.fit_sequence_model(rows, p.NATION)
    ahead = sequence.recursive_forecast(model, sequence.last_sequences(split, p.NATION, stats), stats, p.NATION)
    return join_on(ahead, future_calendar(split, p.NATION), ["k", "step"])


# --- what SQL can say about learned models ---------------------------------------------------------------

# Twelve months after a nation's last one; with what must hold for every row.
_AHEAD = """SELECT k, CAST(CAST(last + INTERVAL (s) MONTH AS DATE) AS VARCHAR) AS t, CAST(s AS INTEGER) AS step, true AS holds
    FROM (SELECT k, date_trunc('month', max(t)) AS last FROM panel GROUP BY k), range(1, 13) AS r(s)"""


def _held(df: DataFrame, holds: Column) -> DataFrame:
    return df.select("k", F.col("t").cast("date").cast("string").alias("t"), F.col("step").cast("int").alias("step"), holds.alias("holds"))


@query("forest_interval_order", with_ctes(_AHEAD, "panel"))
def forest_interval_order(spark: SparkSession, sf: str) -> DataFrame:
    """The forest's prediction lies between the percentiles of its trees, on twelve future dates."""
    return _held(forest_interval(spark, sf), (F.col("lower") <= F.col("prediction")) & (F.col("prediction") <= F.col("upper")) & (F.col("lower") < F.col("upper")))


def _calendar_features(df: DataFrame, t: str) -> DataFrame:
    return df.transform(fe.calendar_parts, t).transform(fe.cyclical, t).transform(fe.season_flags, t)


@query("forest_recursive", with_ctes(_AHEAD, "panel"))
def forest_recursive(spark: SparkSession, sf: str) -> DataFrame:
    """Twelve months ahead, each prediction a lag of the next; the first one is the forecast one month ahead."""
    model, _, _ = _forest(spark, sf)
    panel = cut_lineage(p.nation_panel(spark, sf).select("k", "t", "value"), "panel")
    calendar = cut_lineage(future_calendar(panel, p.NATION), "calendar")
    ahead = trees.recursive_forecast(model, panel, calendar, p.NATION, fe.LAGS, _calendar_features)
    first = calendar.where("step = 1").select("k", "t", F.lit(None).cast("double").alias("value"), "step")
    rows = fe.lags(panel.withColumn("step", F.lit(0)).unionByName(first), p.NATION).where("step = 1")
    once = trees.score(model, _calendar_features(rows.drop("value"), "t")).select("k", "step", F.col("prediction").alias("_once"))
    x, once_x = F.col("prediction"), F.col("_once")
    both = ahead.join(once, ["k", "step"], "left")
    return _held(both, (x > 0) & (F.abs(x) < float("inf")) & ((F.col("step") > 1) | F.coalesce(x == once_x, F.lit(False))))


@query("arima_forecast_order", with_ctes(_AHEAD, "panel"))
def arima_forecast_order(spark: SparkSession, sf: str) -> DataFrame:
    """Every nation has a model; its intervals hold their prediction and never get narrower."""
    ahead = arima_forecast(spark, sf)
    width = F.col("upper") - F.col("lower")
    wider = F.coalesce(width >= F.lag(width).over(Window.partitionBy("k").orderBy("step")) - 1e-9 * width, F.lit(True))
    return _held(ahead.withColumn("_wider", wider), F.col("_wider") & (F.col("lower") <= F.col("prediction")) & (F.col("prediction") <= F.col("upper")))


@query("sequence_forecast_calendar", with_ctes(_AHEAD, "panel"))
def sequence_forecast_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Twelve finite predictions for every nation."""
    x = F.col("prediction")
    return _held(sequence_forecast(spark, sf), x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


@query(
    "model_reload_difference",
    with_ctes(
        """SELECT k, CAST(count(*) AS BIGINT) AS n, CAST(0 AS DOUBLE) AS difference
           FROM (SELECT k, row_number() OVER (PARTITION BY k ORDER BY t) AS r, count(*) OVER (PARTITION BY k) AS n FROM panel)
           WHERE r > floor(n * CAST(0.8 AS DOUBLE)) GROUP BY k""",
        "panel",
    ),
)
def model_reload_difference(spark: SparkSession, sf: str) -> DataFrame:
    """A forest read back from the store predicts what the saved one does, on the newest fifth of each nation."""
    model, df, _ = _forest(spark, sf)
    root = scratch_path(spark, "models")
    store.save_model(model, root, "random_forest", "RandomForest", spark, _FOREST)
    test = df.where("part = 'test'")
    again = trees.score(store.load_model(spark, root, "random_forest"), test).select("k", "t", F.col("prediction").alias("again"))
    both = join_on(trees.score(model, test), again, ["k", "t"])
    return both.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("prediction") - F.col("again"))).alias("difference"))


# --- forecasts and scores ------------------------------------------------------------------------------


@query(
    "future_calendar",
    with_ctes("SELECT k, CAST(step AS INTEGER) AS step, CAST(t AS VARCHAR) AS t FROM calendar", "calendar"),
)
def calendar_ahead(spark: SparkSession, sf: str) -> DataFrame:
    return _text_t(future_calendar(p.price_panel(spark, sf), p.RATE))


@query(
    "baseline_forecasts",
    with_ctes(f"SELECT {_K}, model, round(prediction, 8) + 0.0 AS prediction FROM forecasts", "forecasts"),
)
def baseline(spark: SparkSession, sf: str) -> DataFrame:
    return _text_t(p.forecasts(p.written_prices(spark, sf)).drop("step"), prediction=8)


_ROUNDED_METRICS = "round(mae, 8) + 0.0 AS mae, round(rmse, 8) + 0.0 AS rmse, round(mape, 4) + 0.0 AS mape"


@query("forecast_metrics", with_ctes(f"SELECT k, model, {_ROUNDED_METRICS}, n_test FROM metrics", "metrics"))
def forecast_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _text_t(p.backtest(p.written_prices(spark, sf))[1], mae=8, rmse=8, mape=4)


@query(
    "evaluate_models",
    with_ctes(
        f"""SELECT k, model, {_ROUNDED_METRICS}, n_test, CASE WHEN mae IS NULL THEN 'failed' ELSE 'success' END AS status
            FROM (SELECT k, 'sequence' AS model FROM split GROUP BY k UNION ALL SELECT k, model FROM metrics) LEFT JOIN metrics
            USING (k, model)""",
        "metrics",
    ),
)
def evaluate_models(spark: SparkSession, sf: str) -> DataFrame:
    """A model that gave no scores is listed as failed."""
    metrics = p.backtest(p.written_prices(spark, sf))[1]
    missing = metrics.groupBy("k").agg(F.lit("sequence").alias("model"))
    everyone = metrics.select("k", "model").unionByName(missing)
    return _text_t(scoring.evaluate(join_on(everyone, metrics, ["k", "model"], "left")), mae=8, rmse=8, mape=4)


@query("best_model", with_ctes("SELECT k, model, round(best_score, 8) + 0.0 AS best_score, candidates FROM best", "best"))
def best_model(spark: SparkSession, sf: str) -> DataFrame:
    return _text_t(scoring.best_model(p.backtest(p.written_prices(spark, sf))[1], ["k"]), best_score=8)


@query(
    "best_per_metric",
    with_ctes(
        """SELECT k, metric, min(model) AS model, round(min(score), 4) + 0.0 AS score FROM (
             SELECT *, min(score) OVER (PARTITION BY k, metric) AS least
             FROM (FROM metrics UNPIVOT (score FOR metric IN (mae, rmse, mape)))) WHERE score = least GROUP BY k, metric""",
        "metrics",
    ),
)
def best_per_metric(spark: SparkSession, sf: str) -> DataFrame:
    return _text_t(scoring.best_per_metric(p.backtest(p.written_prices(spark, sf))[1], ["k"]), score=4)


@query(
    "metrics_chart",
    with_ctes(
        "SELECT k, model, metric, round(score, 4) + 0.0 AS score FROM (FROM metrics UNPIVOT (score FOR metric IN (mae, rmse, mape)))",
        "metrics",
    ),
)
def metrics_chart(spark: SparkSession, sf: str) -> DataFrame:
    return _text_t(metrics_long(p.backtest(p.written_prices(spark, sf))[1].drop("n_test"), ["k", "model"]), score=4)


@query(
    "model_routing",
    with_ctes(f"SELECT {_K}, model, round(prediction, 8) + 0.0 AS prediction FROM chosen", "chosen"),
)
def model_routing(spark: SparkSession, sf: str) -> DataFrame:
    return _text_t(p.chosen_forecast(p.written_prices(spark, sf))[0].select("k", "t", "model", "prediction"), prediction=8)
