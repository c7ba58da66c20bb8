"""Ordered-window, calendar and seasonal operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators import features as fe
from panelwright.operators import fill
from panelwright.operators import seasonal as se
from panelwright.plans import panels as p
from panelwright.plans.catalog import query
from panelwright.plans.panels import rounded, with_ctes

W = "(PARTITION BY k ORDER BY t)"


def trailing(n: int, part: str = "k", order: str = "t") -> str:
    return f"(PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _nation(name: str, run: Callable[[DataFrame], DataFrame], columns: dict[str, tuple[int, str]], windows: str = "") -> None:
    """One query over the nation panel: name -> (places, SQL expression over ``panel``)."""

    def spark_query(spark: SparkSession, sf: str) -> DataFrame:
        df = run(p.nation_panel(spark, sf).select("k", "t", "value"))
        return df.select("k", F.col("t").cast("string").alias("t"), *[rounded(F.col(c), n).alias(c) for c, (n, _) in columns.items()])

    cells = ", ".join(f"round({e}, {n}) + 0.0 AS {c}" for c, (n, e) in columns.items())
    body = f"SELECT k, CAST(t AS VARCHAR) AS t, {cells} FROM panel {windows}"
    query(name, with_ctes(body, "panel"))(spark_query)


def pct(v: str, k: int, w: str = W) -> str:
    return f"({v} - lag({v}, {k}) OVER {w}) / nullif(lag({v}, {k}) OVER {w}, 0) * 100"


_nation(
    "rates",
    lambda d: fe.inflation_rates(d, p.NATION),
    {"value_monthly_rate": (6, pct("value", 1)), "value_annual_rate": (6, pct("value", 12))},
)
_nation(
    "lag_features",
    lambda d: fe.lags(d, p.NATION),
    {f"value_lag_{k}": (2, f"lag(value, {k}) OVER {W}") for k in fe.LAGS},
)
_AGG = {"ma": (6, "avg"), "std": (3, "stddev_samp"), "min": (2, "min"), "max": (2, "max")}
for _stat, _title in (("ma", "mean"), ("std", "std"), ("min", "min"), ("max", "max")):
    _nation(
        f"rolling_{_title}",
        lambda d, s=_stat: fe.rolling(d, p.NATION, stats=(s,)),
        {f"value_{_stat}_{n}": (_AGG[_stat][0], f"{_AGG[_stat][1]}(value) OVER {trailing(n)}") for n in fe.WINDOWS},
    )
_nation(
    "rate_of_change",
    lambda d: fe.indicators(d, p.NATION),
    {f"value_roc_{k}": (6, pct("value", k)) for k in fe.ROC_PERIODS},
)
_nation(
    "acceleration",
    lambda d: fe.indicators(d, p.NATION),
    {"value_acceleration": (2, f"value - 2 * lag(value, 1) OVER {W} + lag(value, 2) OVER {W}")},
)
_nation(
    "volatility",
    lambda d: fe.indicators(d, p.NATION),
    {f"value_volatility_{n}": (3, f"stddev_samp(value) OVER {trailing(n)}") for n in fe.VOLATILITY_WINDOWS},
)
_nation(
    "coefficient_of_variation",
    lambda d: fe.indicators(d, p.NATION),
    {
        f"value_cv_{n}": (6, f"stddev_samp(value) OVER {trailing(n)} / nullif(avg(value) OVER {trailing(n)}, 0)")
        for n in fe.CV_WINDOWS
    },
)


def _position(n: int, v: str = "value", part: str = "k", order: str = "t") -> str:
    lo, hi = (f"{f}({v}) OVER {trailing(n, part, order)}" for f in ("min", "max"))
    return f"CASE WHEN {hi} - {lo} = 0 THEN 0.5 ELSE ({v} - {lo}) / nullif({hi} - {lo}, 0) END"


def _zscore(n: int, v: str = "value", part: str = "k", order: str = "t") -> str:
    sd, ma = (f"{f}({v}) OVER {trailing(n, part, order)}" for f in ("stddev_samp", "avg"))
    return f"CASE WHEN {sd} IS NULL THEN NULL WHEN {sd} = 0 THEN 0.0 ELSE ({v} - {ma}) / nullif({sd}, 0) END"


_nation(
    "range_position",
    lambda d: fe.indicators(d, p.NATION),
    {f"value_position_{n}": (6, _position(n)) for n in fe.POSITION_WINDOWS},
)
_nation(
    "ma_deviation",
    lambda d: fe.indicators(d, p.NATION),
    {f"value_ma_deviation_{n}": (6, f"value - avg(value) OVER {trailing(n)}") for n in fe.DEVIATION_WINDOWS},
)
_nation(
    "rolling_zscore",
    lambda d: fe.indicators(d, p.NATION),
    {f"value_zscore_{n}": (6, _zscore(n)) for n in fe.DEVIATION_WINDOWS},
)
_nation(
    "rolling_full_window",
    lambda d: fe.rolling_full(d, p.NATION),
    {
        "value_mean_12": (6, f"CASE WHEN count(value) OVER {trailing(12)} = 12 THEN avg(value) OVER {trailing(12)} END"),
        "value_sd_12": (
            3,
            f"CASE WHEN count(value) OVER {trailing(12)} = 12 THEN stddev_samp(value) OVER {trailing(12)} END",
        ),
    },
)


def _counted(v: str, source: str, part: str, order: str) -> str:
    """The source with a running count of known values as ``c``."""
    return f"(SELECT *, count({v}) OVER (PARTITION BY {part} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS c FROM {source})"


def _slopes(v: str, part: str, order: str, windows: Sequence[int], places: int) -> str:
    """Slopes over ``c``; a single known value has none."""
    cells = []
    for n in windows:
        w = trailing(n, part, order)
        cells.append(
            f"CASE WHEN count({v}) OVER {w} >= 2 THEN round(regr_slope({v}, c) OVER {w}, {places}) + 0.0 END "
            f"AS {v}_trend_{n}"
        )
    return ", ".join(cells)


@query(
    "trend_slope",
    with_ctes(
        f"SELECT k, CAST(t AS VARCHAR) AS t, {_slopes('value', 'k', 't', fe.TREND_WINDOWS, 5)} "
        f"FROM {_counted('value', 'gaps', 'k', 't')}",
        "gaps",
    ),
)
def trend_slope(spark: SparkSession, sf: str) -> DataFrame:
    df = fe.trends(p.gap_panel(spark, sf), p.NATION)
    cols = [rounded(F.col(f"value_trend_{n}"), 5).alias(f"value_trend_{n}") for n in fe.TREND_WINDOWS]
    return df.select("k", F.col("t").cast("string").alias("t"), *cols)


_LAG_ROWS = f"""SELECT event_type, value, row_number() OVER w AS pos,
    {", ".join(f"lag(value, {k}) OVER w AS value_lag_{k}" for k in fe.LAGS)}
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)"""


@query(
    "lag_validation",
    with_ctes(
        " UNION ALL ".join(
            f"""SELECT 'value_lag_{k}' AS feature, count(*) FILTER (a.pos <= {k} AND a.value_lag_{k} IS NOT NULL) AS early_values,
                count(*) FILTER (a.pos > {k} AND a.value_lag_{k} IS DISTINCT FROM b.value) AS mismatches
                FROM laid a LEFT JOIN laid b ON a.event_type = b.event_type AND b.pos = a.pos - {k}"""
            for k in fe.LAGS
        ),
        laid=_LAG_ROWS,
    ),
)
def lag_validation(spark: SparkSession, sf: str) -> DataFrame:
    return fe.check_lags(fe.lags(p.ticks(spark, sf), p.TICKS), p.TICKS)


# --- calendar ------------------------------------------------------------------------

@query(
    "calendar_parts",
    """SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year FROM orders""",
)
def calendar_parts(spark: SparkSession, sf: str) -> DataFrame:
    df = p.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return fe.calendar_parts(df, "o_orderdate").drop("o_orderdate")


@query(
    "cyclical_encoding",
    """SELECT o_orderkey, round(sin(2 * pi() * month(o_orderdate) / 12), 9) + 0.0 AS month_sin,
       round(cos(2 * pi() * month(o_orderdate) / 12), 9) + 0.0 AS month_cos,
       round(sin(2 * pi() * quarter(o_orderdate) / 4), 9) + 0.0 AS quarter_sin,
       round(cos(2 * pi() * quarter(o_orderdate) / 4), 9) + 0.0 AS quarter_cos FROM orders""",
)
def cyclical_encoding(spark: SparkSession, sf: str) -> DataFrame:
    df = fe.cyclical(p.table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")
    names = ["month_sin", "month_cos", "quarter_sin", "quarter_cos"]
    return df.select("o_orderkey", *[rounded(F.col(c), 9).alias(c) for c in names])


@query(
    "one_hot_calendar",
    "SELECT o_orderkey, "
    + ", ".join(f"CAST(month(o_orderdate) = {m} AS INTEGER) AS month_{m}" for m in range(1, 13))
    + ", "
    + ", ".join(f"CAST(quarter(o_orderdate) = {q} AS INTEGER) AS quarter_{q}" for q in range(1, 5))
    + " FROM orders",
)
def one_hot_calendar(spark: SparkSession, sf: str) -> DataFrame:
    df = p.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return fe.one_hot(df, "o_orderdate").drop("o_orderdate")


@query(
    "season_flags",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    + ", ".join(
        f"CAST(month(l_shipdate) IN ({', '.join(map(str, ms))}) AS INTEGER) AS {n}" for n, ms in fe.SEASON_MONTHS.items()
    )
    + " FROM lineitem",
)
def season_flags(spark: SparkSession, sf: str) -> DataFrame:
    df = p.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return fe.season_flags(df, "l_shipdate").drop("l_shipdate")


# --- differences and totals -------------------------------------------------------------


@query(
    "difference",
    with_ctes(
        f"""SELECT k, CAST(t AS VARCHAR) AS t, round(value - 2 * lag(value, 1) OVER {W} + lag(value, 2) OVER {W}, 2) + 0.0
            AS value_diff_2 FROM panel QUALIFY row_number() OVER {W} > 2""",
        "panel",
    ),
)
def difference(spark: SparkSession, sf: str) -> DataFrame:
    df = fe.difference(p.nation_panel(spark, sf).select("k", "t", "value"), p.NATION, 2)
    return df.select("k", F.col("t").cast("string").alias("t"), rounded(F.col("value_diff_2"), 2).alias("value_diff_2"))


@query(
    "difference_ticks",
    """SELECT event_id, round(value - lag(value) OVER w, 2) + 0.0 AS value_diff_1 FROM events
       WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id) QUALIFY row_number() OVER w > 1""",
)
def difference_ticks(spark: SparkSession, sf: str) -> DataFrame:
    df = fe.difference(p.ticks(spark, sf), p.TICKS)
    return df.select("event_id", rounded(F.col("value_diff_1"), 2).alias("value_diff_1"))


@query(
    "integrate",
    with_ctes(
        "SELECT k, CAST(t AS VARCHAR) AS t, round(value, 2) + 0.0 AS value FROM panel "
        f"QUALIFY row_number() OVER {W} > 1",
        "panel",
    ),
)
def integrate(spark: SparkSession, sf: str) -> DataFrame:
    """Differences summed up again give the panel back."""
    panel = p.nation_panel(spark, sf).select("k", "t", "value")
    diffs = fe.difference(panel, p.NATION).drop("value").withColumnRenamed("value_diff_1", "value")
    levels = panel.groupBy("k").agg(F.min_by("value", "t").alias("value_level"))
    back = fill.integrate(diffs, p.NATION, levels)
    return back.select("k", F.col("t").cast("string").alias("t"), rounded(F.col("value_integrated"), 2).alias("value"))


@query(
    "cumulative_ticks",
    """SELECT event_id, round(sum(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4)
       + 0.0 AS value_cumsum FROM events""",
)
def cumulative_ticks(spark: SparkSession, sf: str) -> DataFrame:
    df = fill.cumulative(p.ticks(spark, sf), p.TICKS)
    return df.select("event_id", rounded(F.col("value_cumsum"), 4).alias("value_cumsum"))


# --- trailing comparisons, decomposition, sequences ---------------------------------------


@query(
    "trailing_comparison",
    with_ctes(
        """SELECT k, round(recent, 6) + 0.0 AS recent_avg, round(before, 6) + 0.0 AS previous_avg,
                  CASE WHEN recent > before THEN 'increasing' WHEN recent IS NOT NULL THEN 'decreasing' END AS trend_direction,
                  round(abs(recent - before), 6) + 0.0 AS trend_magnitude
           FROM (SELECT k, CASE WHEN max(size) >= 12 THEN avg(value) FILTER (back <= 12) END AS recent,
                        CASE WHEN max(size) >= 24 THEN avg(value) FILTER (back BETWEEN 13 AND 24)
                             WHEN max(size) >= 12 THEN avg(value) FILTER (pos <= 12) END AS before
                 FROM known GROUP BY k)""",
        "panel",
        known="""SELECT k, value, row_number() OVER (PARTITION BY k ORDER BY t DESC) AS back,
                 row_number() OVER (PARTITION BY k ORDER BY t) AS pos, count(*) OVER (PARTITION BY k) AS size FROM panel""",
    ),
)
def trailing_comparison(spark: SparkSession, sf: str) -> DataFrame:
    df = se.trailing_comparison(p.nation_panel(spark, sf).select("k", "t", "value"), p.NATION)
    nums = {c: rounded(F.col(c), 6) for c in ("recent_avg", "previous_avg", "trend_magnitude")}
    return df.withColumns(nums)


_TRAJECTORY = """SELECT k, round(min_by(rate, t), 6) + 0.0 AS initial_value, round(max_by(rate, t), 6) + 0.0 AS final_value,
    CASE WHEN max_by(rate, t) > min_by(rate, t) THEN 'increasing' WHEN count(*) > 1 THEN 'decreasing' ELSE 'stable' END
      AS overall_trend,
    round(coalesce(stddev_pop(step), 0), 6) + 0.0 AS step_volatility, round(coalesce(max(abs(step)), 0), 6) + 0.0 AS max_jump
    FROM (SELECT *, rate - lag(rate) OVER (PARTITION BY k ORDER BY t) AS step FROM prices) GROUP BY k"""


@query("trajectory", with_ctes(_TRAJECTORY, "prices"))
def trajectory(spark: SparkSession, sf: str) -> DataFrame:
    df = se.trajectory(p.price_panel(spark, sf), p.RATE)
    return df.withColumns({c: rounded(F.col(c), 6) for c in ("initial_value", "final_value", "step_volatility", "max_jump")})


def _decompose_sql(v: str, source: str, part: str, order: str, ids: str, places: Sequence[int]) -> str:
    by = f"PARTITION BY {part} ORDER BY {order}" if part else f"ORDER BY {order}"
    key = f"{part}, " if part else ""
    frame = lambda a, b: f"({by} ROWS BETWEEN {a} PRECEDING AND {b} FOLLOWING)"
    over_key = f"OVER (PARTITION BY {part})" if part else "OVER ()"
    using = f"USING ({key}phase)" if part else "USING (phase)"
    return f"""WITH known AS (SELECT * FROM {source} WHERE {v} IS NOT NULL),
      trended AS (SELECT *, (row_number() OVER ({by}) - 1) % 12 AS phase,
        CASE WHEN count(*) OVER {frame(6, 6)} = 13
             THEN (sum({v}) OVER {frame(6, 5)} + sum({v}) OVER {frame(5, 6)}) / 24 END AS trend FROM known),
      phases AS (SELECT {key}phase, avg({v} - trend) AS m, count(*) AS n FROM trended GROUP BY {key}phase),
      centred AS (SELECT {key}phase, CASE WHEN sum(n) {over_key} >= 24 THEN m - avg(m) {over_key} END AS seasonal FROM phases)
      SELECT {ids}, round(CASE WHEN seasonal IS NOT NULL THEN trend END, {places[0]}) + 0.0 AS trend,
             round(seasonal, {places[1]}) + 0.0 AS seasonal, round({v} - trend - seasonal, {places[2]}) + 0.0 AS residual
      FROM trended JOIN centred {using}"""


def _nested(sql: str, *ctes: str) -> str:
    return sql.replace("WITH ", with_ctes("", *ctes).rstrip() + ", ", 1) if ctes else sql


def _decomposed(df: DataFrame, ids: Sequence, places: Sequence[int]) -> DataFrame:
    parts = zip(("trend", "seasonal", "residual"), places)
    return df.select(*ids, *[rounded(F.col(c), n).alias(c) for c, n in parts])


@query("seasonal_decompose", _nested(_decompose_sql("value", "panel", "k", "t", "k, CAST(t AS VARCHAR) AS t", (6, 5, 3)), "panel"))
def seasonal_decompose(spark: SparkSession, sf: str) -> DataFrame:
    df = se.decompose(p.nation_panel(spark, sf).select("k", "t", "value"), p.NATION)
    return _decomposed(df, ["k", F.col("t").cast("string").alias("t")], (6, 5, 3))


@query("seasonal_decompose_ticks", _decompose_sql("value", "events", "event_type", "ts, event_id", "event_id", (6, 6, 6)))
def seasonal_decompose_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of one long series per event type, with six rows of halo on either side."""
    return _decomposed(se.decompose(p.ticks(spark, sf), p.TICKS), ["event_id"], (6, 6, 6))


@query(
    "seasonal_decompose_total",
    _nested(_decompose_sql("value", "total", "", "t", "CAST(t AS VARCHAR) AS t", (6, 4, 3)), "total"),
)
def seasonal_decompose_total(spark: SparkSession, sf: str) -> DataFrame:
    """A single series without keys."""
    return _decomposed(se.decompose(p.total_series(spark, sf), p.TOTAL), [F.col("t").cast("string").alias("t")], (6, 4, 3))


@query(
    "seasonal_profile",
    with_ctes(
        "SELECT k, CAST(month(t) AS INTEGER) AS month, round(avg(annual_rate), 6) + 0.0 AS annual_rate_mean "
        "FROM rates GROUP BY 1, 2",
        "rates",
    ),
)
def seasonal_profile(spark: SparkSession, sf: str) -> DataFrame:
    df = se.seasonal_profile(p.rate_panel(spark, sf), p.NATION.with_values("annual_rate"))
    return df.withColumn("annual_rate_mean", rounded(F.col("annual_rate_mean"), 6))


@query(
    "sequence_windows",
    """SELECT event_id, target, sequence FROM (
         SELECT event_id, round(value, 2) + 0.0 AS target, list_aggregate(list_transform(list(value) OVER w,
                  lambda x: printf('%.2f', x)), 'string_agg', ',') AS sequence, count(*) OVER w AS c FROM events
         WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))
       WHERE c = 12""",
)
def sequence_windows(spark: SparkSession, sf: str) -> DataFrame:
    df = se.sequences(p.ticks(spark, sf), p.TICKS)
    texts = F.transform("sequence", lambda x: F.format_string("%.2f", x))
    return df.select("event_id", rounded(F.col("value"), 2).alias("target"), F.array_join(texts, ",").alias("sequence"))


@query(
    "tail_rows",
    """SELECT event_type, event_id, round(value, 2) + 0.0 AS value FROM events
       QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 24""",
)
def tail_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = se.tail(p.ticks(spark, sf), p.TICKS, 24)
    return df.select("event_type", "event_id", rounded(F.col("value"), 2).alias("value"))


# --- whole feature sets over raw rows, in blocks --------------------------------------------

_SHIP_ORDER = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
_SHIP_IDS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _ship(n: int) -> str:
    return trailing(n, "l_returnflag", _SHIP_ORDER)


_SHIP_W = f"(PARTITION BY l_returnflag ORDER BY {_SHIP_ORDER})"
_X = "l_extendedprice"
_INDICATORS: dict[str, tuple[int, str]] = (
    {f"{_X}_roc_{k}": (6, pct(_X, k, _SHIP_W)) for k in fe.ROC_PERIODS}
    | {f"{_X}_acceleration": (2, f"{_X} - 2 * lag({_X}, 1) OVER {_SHIP_W} + lag({_X}, 2) OVER {_SHIP_W}")}
    | {f"{_X}_volatility_{n}": (4, f"stddev_samp({_X}) OVER {_ship(n)}") for n in fe.VOLATILITY_WINDOWS}
    | {
        f"{_X}_cv_{n}": (6, f"stddev_samp({_X}) OVER {_ship(n)} / nullif(avg({_X}) OVER {_ship(n)}, 0)")
        for n in fe.CV_WINDOWS
    }
    | {f"{_X}_position_{n}": (6, _position(n, _X, "l_returnflag", _SHIP_ORDER)) for n in fe.POSITION_WINDOWS}
    | {f"{_X}_ma_deviation_{n}": (6, f"{_X} - avg({_X}) OVER {_ship(n)}") for n in fe.DEVIATION_WINDOWS}
    | {f"{_X}_zscore_{n}": (6, _zscore(n, _X, "l_returnflag", _SHIP_ORDER)) for n in fe.DEVIATION_WINDOWS}
)


@query(
    "indicators_shipments",
    f"SELECT {_SHIP_IDS}, "
    + ", ".join(f"round({e}, {n}) + 0.0 AS {c}" for c, (n, e) in _INDICATORS.items())
    + f", {_slopes(_X, 'l_returnflag', _SHIP_ORDER, fe.TREND_WINDOWS, 5)}"
    + f" FROM {_counted(_X, 'lineitem', 'l_returnflag', _SHIP_ORDER)}",
)
def indicators_shipments(spark: SparkSession, sf: str) -> DataFrame:
    """All indicators of the price of every shipped line, in order of shipping, per return flag.

    Three keys hold the whole table; blocks keep every task small.
    """
    columns = ["l_returnflag", "l_shipdate", *_SHIP_IDS.split(", "), _X]
    df = fe.indicators(p.table(spark, sf, "lineitem").select(*columns), p.SHIPMENTS)
    cells = [rounded(F.col(c), n).alias(c) for c, (n, _) in _INDICATORS.items()]
    cells += [rounded(F.col(f"{_X}_trend_{n}"), 5).alias(f"{_X}_trend_{n}") for n in fe.TREND_WINDOWS]
    return df.select(*_SHIP_IDS.split(", "), *cells)


_TICK_ORDER = "ts, event_id"


def _tick(n: int) -> str:
    return trailing(n, "event_type", _TICK_ORDER)


_TICK_W = f"(PARTITION BY event_type ORDER BY {_TICK_ORDER})"
_TICK_CELLS: dict[str, tuple[int, str]] = {f"value_lag_{k}": (2, f"lag(value, {k}) OVER {_TICK_W}") for k in fe.LAGS} | {
    f"value_{s}_{n}": (6, f"{_AGG[s][1]}(value) OVER {_tick(n)}")
    for n in fe.WINDOWS
    for s in ("ma", "std", "min", "max")
}


@query(
    "lag_rolling_ticks",
    "SELECT event_id, " + ", ".join(f"round({e}, {n}) + 0.0 AS {c}" for c, (n, e) in _TICK_CELLS.items()) + " FROM events",
)
def lag_rolling_ticks(spark: SparkSession, sf: str) -> DataFrame:
    df = fe.lags_and_rolling(p.ticks(spark, sf), p.TICKS)
    return df.select("event_id", *[rounded(F.col(c), n).alias(c) for c, (n, _) in _TICK_CELLS.items()])


# Every column of the feature matrix of a value over (k, t): name -> (places, SQL); slopes and whole numbers apart.
_MATRIX: dict[str, tuple[int, str]] = (
    {f"value_lag_{k}": (2, f"lag(value, {k}) OVER {W}") for k in fe.LAGS}
    | {f"value_{s}_{n}": (_AGG[s][0] if s != "std" else 3, f"{_AGG[s][1]}(value) OVER {trailing(n)}") for n in fe.WINDOWS for s in _AGG}
    | {f"value_roc_{k}": (4, pct("value", k)) for k in fe.ROC_PERIODS}
    | {"value_acceleration": (2, f"value - 2 * lag(value, 1) OVER {W} + lag(value, 2) OVER {W}")}
    | {f"value_volatility_{n}": (3, f"stddev_samp(value) OVER {trailing(n)}") for n in fe.VOLATILITY_WINDOWS}
    | {f"value_cv_{n}": (6, f"stddev_samp(value) OVER {trailing(n)} / nullif(avg(value) OVER {trailing(n)}, 0)") for n in fe.CV_WINDOWS}
    | {f"value_position_{n}": (6, _position(n)) for n in fe.POSITION_WINDOWS}
    | {f"value_ma_deviation_{n}": (5, f"value - avg(value) OVER {trailing(n)}") for n in fe.DEVIATION_WINDOWS}
    | {f"value_zscore_{n}": (6, _zscore(n)) for n in fe.DEVIATION_WINDOWS}
    | {"month_sin": (9, "sin(2 * pi() * month(t) / 12)"), "month_cos": (9, "cos(2 * pi() * month(t) / 12)")}
    | {"quarter_sin": (9, "sin(2 * pi() * quarter(t) / 4)"), "quarter_cos": (9, "cos(2 * pi() * quarter(t) / 4)")}
)
_MATRIX_WHOLE: dict[str, str] = (
    {"month": "month(t)", "quarter": "quarter(t)", "year": "year(t)", "day_of_year": "dayofyear(t)"}
    | {f"month_{m}": f"month(t) = {m}" for m in range(1, 13)}
    | {f"quarter_{q}": f"quarter(t) = {q}" for q in range(1, 5)}
    | {n: f"month(t) IN ({', '.join(map(str, ms))})" for n, ms in fe.SEASON_MONTHS.items()}
)


def matrix_sql(source: str) -> str:
    cells = ", ".join(f"round({e}, {n}) + 0.0 AS {c}" for c, (n, e) in _MATRIX.items())
    whole = ", ".join(f"CAST({e} AS INTEGER) AS {c}" for c, e in _MATRIX_WHOLE.items())
    slopes = _slopes("value", "k", "t", fe.TREND_WINDOWS, 4)
    return f"SELECT k, CAST(t AS VARCHAR) AS t, {cells}, {whole}, {slopes} FROM {_counted('value', source, 'k', 't')}"


def matrix_cells(df: DataFrame) -> DataFrame:
    cells = [rounded(F.col(c), n).alias(c) for c, (n, _) in _MATRIX.items()] + [F.col(c).cast("int").alias(c) for c in _MATRIX_WHOLE]
    cells += [rounded(F.col(f"value_trend_{n}"), 4).alias(f"value_trend_{n}") for n in fe.TREND_WINDOWS]
    return df.select("k", F.col("t").cast("string").alias("t"), *cells)


@query("customer_features", with_ctes(matrix_sql("customers"), "customers"))
def customer_features(spark: SparkSession, sf: str) -> DataFrame:
    """Every feature column of one monthly series per customer: many short series."""
    return matrix_cells(fe.feature_matrix(p.customer_panel(spark, sf), p.CUSTOMER))


@query(
    "feature_cascade",
    with_ctes(
        """SELECT k, CAST(t AS VARCHAR) AS t, feature, round((x - lag(x, 1) OVER f) / nullif(lag(x, 1) OVER f, 0) * 100, 4) + 0.0
             AS x_roc_1, round(avg(x) OVER (PARTITION BY k, feature ORDER BY t ROWS 5 PRECEDING), 6) + 0.0 AS x_ma_6
           FROM long WINDOW f AS (PARTITION BY k, feature ORDER BY t)""",
        "panel",
        wide="SELECT k, t, value, "
        + ", ".join(f"lag(value, {k}) OVER {W} AS value_lag_{k}" for k in fe.LAGS)
        + ", "
        + ", ".join(
            f"{_AGG[s][1]}(value) OVER {trailing(n)} AS value_{s}_{n}" for n in fe.WINDOWS for s in ("ma", "std", "min", "max")
        )
        + " FROM panel",
        long="SELECT * FROM (FROM wide UNPIVOT INCLUDE NULLS (x FOR feature IN (COLUMNS(* EXCLUDE (k, t)))))",
    ),
)
def feature_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Indicators of lags and moving statistics, in the long layout."""
    panel = p.nation_panel(spark, sf).select("k", "t", "value")
    df = fe.cascade_long(panel, p.NATION)
    return df.select(
        "k",
        F.col("t").cast("string").alias("t"),
        "feature",
        rounded(F.col("x_roc_1"), 4).alias("x_roc_1"),
        rounded(F.col("x") - F.col("x_ma_deviation_6"), 6).alias("x_ma_6"),
    )
