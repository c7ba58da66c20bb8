"""The given tables as panels, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.stats import z_value
from panelwright.operators import features as fe
from panelwright.operators import fill, intervals, scoring
from panelwright.operators.dataset import chrono_split
from panelwright.operators.forecast import baseline_forecasts, future_calendar, test_grid
from panelwright.operators.layout import join_on
from panelwright.operators.quality import SECTOR_NAMES
from panelwright.session import cut_lineage
from panelwright.spec import SeriesSpec

MONEY = "decimal(18,2)"

NATION = SeriesSpec("k", "t", "value", "month")
RATE = NATION.with_values("rate")
TOTAL = SeriesSpec((), "t", "value", "month")
CUSTOMER = SeriesSpec("k", "t", "value", "month")
TICKS = SeriesSpec("event_type", "ts", "value", None, "event_id")
SHIPMENTS = SeriesSpec(
    "l_returnflag", "l_shipdate", "l_extendedprice", None,
    ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"),
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(c: Column, places: int) -> Column:
    """Rounded, without a negative zero."""
    return F.round(c, places) + F.lit(0.0)


def month_of(c: str) -> Column:
    return F.trunc(c, "MM")


def customer_months(spark: SparkSession, sf: str) -> DataFrame:
    """(o_custkey, t, total, n): orders of a customer and month, money added up exactly.

    The first step of every order panel: a customer with very many orders
    shrinks to one row per month before anything is joined.
    """
    return (
        table(spark, sf, "orders")
        .groupBy("o_custkey", month_of("o_orderdate").alias("t"))
        .agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("total"), F.count(F.lit(1)).alias("n"))
    )


def _value(c: str) -> Column:
    return F.sum(c).cast("double").alias("value")


def nation_panel(spark: SparkSession, sf: str) -> DataFrame:
    """(k, t, value, n): order value per nation and month."""
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("k"))
    joined = customer_months(spark, sf).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("k", "t").agg(_value("total"), F.sum("n").alias("n"))


def segment_panel(spark: SparkSession, sf: str) -> DataFrame:
    """One row per month, one value column per market segment."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    joined = customer_months(spark, sf).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("t").pivot("c_mktsegment", SEGMENTS).agg(F.sum("total").cast("double"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


# The nations dealt out to the twelve sectors.
SECTORS = [c for c in SECTOR_NAMES if SECTOR_NAMES[c] != "fecha"]


def sector_table(spark: SparkSession, sf: str) -> DataFrame:
    """One row per month, one column per sector under its source name."""
    customers = table(spark, sf, "customer").select("c_custkey", F.pmod("c_nationkey", F.lit(len(SECTORS))).alias("s"))
    joined = customer_months(spark, sf).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    wide = joined.groupBy("t").pivot("s", list(range(len(SECTORS)))).agg(F.sum("total").cast("double"))
    return wide.select("t", *[F.col(f"`{i}`").alias(s) for i, s in enumerate(SECTORS)])


def total_series(spark: SparkSession, sf: str) -> DataFrame:
    """(t, value): one monthly series of all orders."""
    months = customer_months(spark, sf)
    return months.groupBy("t").agg(_value("total"))


def customer_panel(spark: SparkSession, sf: str) -> DataFrame:
    """(k, t, value): one monthly series per customer."""
    return customer_months(spark, sf).select(
        F.col("o_custkey").alias("k"), "t", F.col("total").cast("double").alias("value")
    )


def gap_panel(spark: SparkSession, sf: str) -> DataFrame:
    """(k, t, value): every month of a nation; months of fewer than four orders have no value."""
    thin = nation_panel(spark, sf).select("k", "t", F.when(F.col("n") >= 4, F.col("value")).alias("value"))
    return fill.regularise(thin, NATION)


def rate_panel(spark: SparkSession, sf: str) -> DataFrame:
    """(k, t, value, monthly_rate, annual_rate)."""
    rated = fe.inflation_rates(nation_panel(spark, sf).select("k", "t", "value"), NATION)
    return rated.withColumnsRenamed({"value_monthly_rate": "monthly_rate", "value_annual_rate": "annual_rate"})


def price_panel(spark: SparkSession, sf: str) -> DataFrame:
    """(k, t, rate): year-on-year change of the average price per item shipped, per flags and month."""
    monthly = (
        table(spark, sf, "lineitem")
        .groupBy(F.concat("l_returnflag", "l_linestatus").alias("k"), month_of("l_shipdate").alias("t"))
        .agg(
            F.sum(F.col("l_extendedprice").cast(MONEY)).cast("double").alias("_money"),
            F.sum(F.col("l_quantity").cast(MONEY)).cast("double").alias("_items"),
        )
        .select("k", "t", (F.col("_money") / F.col("_items")).alias("value"))
    )
    rated = fe.inflation_rates(monthly, NATION)
    return rated.where(F.col("value_annual_rate").isNotNull()).select(
        "k", "t", F.col("value_annual_rate").alias("rate")
    )


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_type", "event_id", "ts", "value")


def gap_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks whose reading is missing where the counter in the event's JSON is below 30."""
    events = table(spark, sf, "events")
    counter = F.get_json_object("props", "$.k").cast("int")
    return events.select("event_type", "event_id", "ts", F.when(counter >= 30, F.col("value")).alias("value"))


def written_prices(spark: SparkSession, sf: str) -> DataFrame:
    """The price panel, computed once: models and forecasts read it many times."""
    return cut_lineage(price_panel(spark, sf), "prices")


def backtest(prices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tested, metrics) of the baseline models on the newest fifth of the price panel."""
    split = chrono_split(prices, RATE)
    train = split.where(F.col("part") == "train").drop("part")
    tested = baseline_forecasts(test_grid(split, RATE), train, RATE)
    return tested, scoring.forecast_metrics(tested, ["k", "model"], "rate")


def forecasts(prices: DataFrame) -> DataFrame:
    """(k, step, t, model, prediction) of the baseline models for the next twelve months."""
    return baseline_forecasts(future_calendar(prices, RATE), prices, RATE)


def with_rmse(prices: DataFrame, metrics: DataFrame) -> DataFrame:
    return join_on(forecasts(prices), metrics.select("k", "model", "rmse"), ["k", "model"], "left")


def chosen_forecast(prices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(forecast with interval of each key's best model, metrics of all models)."""
    metrics = backtest(prices)[1]
    banded = intervals.normal_interval(with_rmse(prices, metrics))
    best = scoring.best_model(metrics, ["k"])
    return scoring.route(banded, best, ["k"]), metrics


# --- the same in SQL -----------------------------------------------------------------

Z95 = f"CAST('{z_value(0.95)!r}' AS DOUBLE)"

CTES = {
    "panel": """
        SELECT c_nationkey AS k, CAST(date_trunc('month', o_orderdate) AS DATE) AS t,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value, count(*) AS n
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
    "total": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS t,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
        FROM orders GROUP BY 1""",
    "customers": """
        SELECT o_custkey AS k, CAST(date_trunc('month', o_orderdate) AS DATE) AS t,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
        FROM orders GROUP BY 1, 2""",
    "segments": "SELECT t, " + ", ".join(
        f"CAST(sum(CASE WHEN c_mktsegment = '{s}' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS {s}"
        for s in SEGMENTS
    ) + """ FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS t, c_mktsegment, o_totalprice
        FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY t""",
    "sectors": "SELECT t, " + ", ".join(
        f"CAST(sum(CASE WHEN c_nationkey % {len(SECTORS)} = {i} THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS s{i}"
        for i in range(len(SECTORS))
    ) + """ FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS t, c_nationkey, o_totalprice
        FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY t""",
    "gaps": """
        SELECT g.k, g.t, CASE WHEN p.n >= 4 THEN p.value END AS value
        FROM (SELECT k, CAST(unnest(generate_series(min(t), max(t), INTERVAL 1 MONTH)) AS DATE) AS t
              FROM panel GROUP BY k) g
        LEFT JOIN panel p ON p.k = g.k AND p.t = g.t""",
    "rates": """
        SELECT k, t, value,
               (value - lag(value, 1) OVER w) / nullif(lag(value, 1) OVER w, 0) * 100 AS monthly_rate,
               (value - lag(value, 12) OVER w) / nullif(lag(value, 12) OVER w, 0) * 100 AS annual_rate
        FROM panel WINDOW w AS (PARTITION BY k ORDER BY t)""",
    "prices": """
        SELECT k, t, rate FROM (
          SELECT k, t, (value - lag(value, 12) OVER w) / nullif(lag(value, 12) OVER w, 0) * 100 AS rate
          FROM (SELECT l_returnflag || l_linestatus AS k, CAST(date_trunc('month', l_shipdate) AS DATE) AS t,
                       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
                         / CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS value
                FROM lineitem GROUP BY 1, 2)
          WINDOW w AS (PARTITION BY k ORDER BY t))
        WHERE rate IS NOT NULL""",
    "ticks": "SELECT event_type, event_id, ts, value FROM events",
    "gapticks": """
        SELECT event_type, event_id, ts,
               CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) >= 30 THEN value END AS value
        FROM events""",
}
# Backtest and forecast of the price panel with the baseline models.
_FIT = """SELECT k, max_by(rate, t) AS last_value, avg(rate) AS mean_value, max(t) AS last_t,
       regr_slope(rate, y1) AS phi, regr_intercept(rate, y1) AS c
    FROM (SELECT *, lag(rate) OVER (PARTITION BY k ORDER BY t) AS y1 FROM {source}) GROUP BY k"""
_MODELS = """SELECT {ids}, 'random_walk' AS model, last_value AS prediction FROM {source}
    UNION ALL SELECT {ids}, 'historic_mean', mean_value FROM {source}
    UNION ALL SELECT {ids}, 'ar1', c * (1 - pow(phi, step)) / (1 - phi) + pow(phi, step) * last_value FROM {source}"""
CTES |= {
    "split": """
        SELECT *, CASE WHEN row_number() OVER (PARTITION BY k ORDER BY t)
                    <= floor(count(*) OVER (PARTITION BY k) * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS part
        FROM prices""",
    "fits": _FIT.format(source="(SELECT * FROM split WHERE part = 'train')"),
    "grid": """
        SELECT k, t, rate, row_number() OVER (PARTITION BY k ORDER BY t) AS step, last_value, mean_value, phi, c
        FROM split JOIN fits USING (k) WHERE part = 'test'""",
    "tested": _MODELS.format(ids="k, t, rate, step", source="grid"),
    "metrics": """
        SELECT k, model, avg(abs(rate - prediction)) AS mae, sqrt(avg((rate - prediction) * (rate - prediction))) AS rmse,
               avg(abs((rate - prediction) / nullif(rate, 0))) * 100 AS mape, count(rate - prediction) AS n_test
        FROM tested GROUP BY k, model""",
    "best": """
        SELECT k, min(model) AS model, min(mae) AS best_score, max(candidates) AS candidates
        FROM (SELECT *, min(mae) OVER (PARTITION BY k) AS least, count(*) OVER (PARTITION BY k) AS candidates FROM metrics)
        WHERE mae = least GROUP BY k""",
    "ahead": _FIT.format(source="prices"),
    "calendar": """
        SELECT k, step, CAST(date_trunc('month', last_t) + to_months(CAST(step AS INTEGER)) AS DATE) AS t,
               last_value, mean_value, phi, c
        FROM ahead, (SELECT unnest(generate_series(1, 12)) AS step)""",
    "forecasts": _MODELS.format(ids="k, t, step", source="calendar"),
    "banded": f"""
        SELECT f.*, prediction - {Z95} * coalesce(rmse, 0.1) AS lower, prediction + {Z95} * coalesce(rmse, 0.1) AS upper
        FROM forecasts f LEFT JOIN metrics USING (k, model)""",
    "chosen": "SELECT b.* FROM banded b JOIN best USING (k, model)",
}
NEEDS = {"gaps": ["panel"], "rates": ["panel"]}
NEEDS["split"] = ["prices"]
NEEDS["fits"] = [*NEEDS["split"], "split"]
NEEDS["grid"] = [*NEEDS["fits"], "fits"]
NEEDS["tested"] = [*NEEDS["grid"], "grid"]
NEEDS["metrics"] = [*NEEDS["tested"], "tested"]
NEEDS["best"] = [*NEEDS["metrics"], "metrics"]
NEEDS["ahead"] = ["prices"]
NEEDS["calendar"] = ["prices", "ahead"]
NEEDS["forecasts"] = [*NEEDS["calendar"], "calendar"]
NEEDS["banded"] = [*NEEDS["metrics"], "metrics", *NEEDS["forecasts"], "forecasts"]
NEEDS["chosen"] = [*NEEDS["banded"], "best", "banded"]


def with_ctes(body: str, *names: str, **extra: str) -> str:
    """``body`` after the named and the given common table expressions."""
    ordered: list[str] = []
    for n in names:
        for m in [*NEEDS.get(n, []), n]:
            if m not in ordered:
                ordered.append(m)
    parts = [f"{n} AS ({CTES[n]})" for n in ordered] + [f"{n} AS ({q})" for n, q in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
