"""Profiles of tables and series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators import features as fe
from panelwright.operators import profile
from panelwright.plans import panels as p
from panelwright.plans.catalog import query
from panelwright.plans.panels import rounded, with_ctes


def _rounded(df: DataFrame, **places: int) -> DataFrame:
    return df.withColumns({c: rounded(F.col(c), n) for c, n in places.items()})


@query(
    "dataset_info",
    """SELECT count(*) AS total_rows, 6 AS total_columns, CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS start_date,
       CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS end_date FROM orders""",
)
def dataset_info(spark: SparkSession, sf: str) -> DataFrame:
    df = profile.dataset_info(p.table(spark, sf, "orders"), "o_orderdate")
    return df.withColumns({c: F.col(c).cast("string") for c in ("start_date", "end_date")})


@query(
    "missing_profile",
    with_ctes(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
                round(100.0 * (count(*) - count({c})) / count(*), 6) + 0.0 AS percentage FROM gapticks"""
            for c in ("event_type", "event_id", "ts", "value")
        ),
        "gapticks",
    ),
)
def missing_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile.missing_profile(p.gap_ticks(spark, sf)), percentage=6)


_LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _describe_sql(c: str, source: str, by: str = "") -> str:
    key = f"{by}, " if by else ""
    q = lambda x: f"round(quantile_cont({c}, {x}), 4) + 0.0"
    return (
        f"""SELECT {key}'{c}' AS "column", count({c}) AS count, round(avg({c}), 6) + 0.0 AS mean,
        round(stddev_samp({c}), 6) + 0.0 AS std, round(min({c}), 4) + 0.0 AS min, {q(0.25)} AS q25, {q(0.5)} AS q50,
        {q(0.75)} AS q75, round(max({c}), 4) + 0.0 AS max FROM {source}"""
        + (f" GROUP BY {by}" if by else "")
    )


def _described(df: DataFrame) -> DataFrame:
    return _rounded(df, mean=6, std=6, min=4, q25=4, q50=4, q75=4, max=4)


@query("describe", " UNION ALL ".join(_describe_sql(c, "lineitem") for c in _LINE_NUMBERS))
def describe(spark: SparkSession, sf: str) -> DataFrame:
    """The whole line table as one group, with exact quantiles."""
    return _described(profile.describe(p.table(spark, sf, "lineitem"), _LINE_NUMBERS))


@query("describe_by_key", _describe_sql("value", "events", "event_type"))
def describe_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return _described(profile.describe(p.table(spark, sf, "events"), ["value"], ["event_type"]))


@query(
    "correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) + 0.0 AS r FROM lineitem"
        for i, a in enumerate(_LINE_NUMBERS)
        for b in _LINE_NUMBERS[i + 1 :]
    ),
)
def correlation_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile.correlations(p.table(spark, sf, "lineitem"), _LINE_NUMBERS), r=8)


@query(
    "correlation_by_key",
    with_ctes(
        " UNION ALL ".join(
            f"SELECT k, '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS r FROM rates GROUP BY k"
            for a, b in (("value", "monthly_rate"), ("value", "annual_rate"), ("monthly_rate", "annual_rate"))
        ),
        "rates",
    ),
)
def correlation_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile.correlations(p.rate_panel(spark, sf), ["value", "monthly_rate", "annual_rate"], ["k"]), r=6)


# Three kinds of keys whose values lie around 0, 1e7 and 1e9, three columns of related noise.
_OFFSETS = """SELECT l_linenumber % 3 AS k, (CASE l_linenumber % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 1e7 ELSE 1e9 END) + l_quantity AS a,
    (CASE l_linenumber % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 1e7 ELSE 1e9 END) + l_quantity + 0.5 * (l_partkey % 41) AS b,
    CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE (CASE l_linenumber % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 1e7 ELSE 1e9 END) - 2.0 * l_quantity + (l_suppkey % 53) END AS c
    FROM lineitem"""


@query(
    "correlation_offsets",
    with_ctes(
        " UNION ALL ".join(f"SELECT k, '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS r FROM shifted GROUP BY k" for a, b in ("ab", "ac", "bc")),
        shifted=_OFFSETS.replace("1e7", "CAST(1e7 AS DOUBLE)").replace("1e9", "CAST(1e9 AS DOUBLE)"),
    ),
)
def correlation_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Per key, in one table with keys far from each other; by the way for few and the way for many columns, which agree."""
    p.table(spark, sf, "lineitem").createOrReplaceTempView("_lineitem_offsets")
    shifted = spark.sql(_OFFSETS.replace("FROM lineitem", "FROM _lineitem_offsets").replace("1e7", "1e7D").replace("1e9", "1e9D").replace("0.0", "0.0D"))
    few = profile.correlations(shifted, ["a", "b", "c"], ["k"])
    more = [F.col(c).alias(f"{c}{i}") for i in range(3) for c in ("a", "b", "c")]
    many = profile.correlations(shifted.select("k", *more), [f"{c}{i}" for i in range(3) for c in ("a", "b", "c")], ["k"])
    many = many.where(F.col("a").endswith("0") & F.col("b").endswith("0")).select("k", F.substring("a", 1, 1).alias("a"), F.substring("b", 1, 1).alias("b"), F.col("r").alias("_r"))
    both = few.join(many, ["k", "a", "b"])
    return _rounded(both.select("k", "a", "b", F.when(F.abs(F.col("r") - F.col("_r")) < 1e-9, F.col("r")).alias("r")), r=6)


@query(
    "skew_kurtosis",
    """SELECT event_type, 'value' AS "column", round(skewness(value), 6) + 0.0 AS skewness,
       round(kurtosis(value), 6) + 0.0 AS kurtosis FROM events GROUP BY event_type""",
)
def skew_kurtosis(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(
        profile.shape(p.table(spark, sf, "events"), ["value"], ["event_type"]), skewness=6, kurtosis=6
    )


_CATEGORIES = ("o_orderstatus", "o_orderpriority", "o_custkey")
_COUNTS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY 2"
    for c in _CATEGORIES
)


@query(
    "categorical_summary",
    f"""SELECT "column", count(*) AS unique_values, min(value) FILTER (n = most) AS most_frequent
        FROM (SELECT *, max(n) OVER (PARTITION BY "column") AS most FROM ({_COUNTS})) GROUP BY 1""",
)
def categorical_summary(spark: SparkSession, sf: str) -> DataFrame:
    return profile.categorical_summary(p.table(spark, sf, "orders"), _CATEGORIES)


@query(
    "top_categories",
    f"""SELECT "column", CAST(rank AS INTEGER) AS rank, value, n FROM (
        SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM ({_COUNTS})) WHERE rank <= 10""",
)
def top_categories(spark: SparkSession, sf: str) -> DataFrame:
    return profile.top_categories(p.table(spark, sf, "orders"), _CATEGORIES)


@query("approx_distinct")
def approx_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return profile.approx_distinct(p.table(spark, sf, "orders"), _CATEGORIES)


@query(
    "approx_distinct_error",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS exact_distinct, true AS within FROM orders" for c in _CATEGORIES),
)
def approx_distinct_error(spark: SparkSession, sf: str) -> DataFrame:
    """The sketch stays within four of its standard errors of the exact number."""
    orders = p.table(spark, sf, "orders")
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in _CATEGORIES]).unpivot([], list(_CATEGORIES), "column", "exact_distinct")
    near = F.abs(F.col("approx_distinct") - F.col("exact_distinct")) <= 4 * 0.02 * F.col("exact_distinct")
    return profile.approx_distinct(orders, _CATEGORIES, 0.02).join(exact, "column").select("column", "exact_distinct", near.alias("within"))


@query(
    "rate_statistics",
    with_ctes(
        """SELECT k, round(avg(annual_rate), 6) + 0.0 AS mean_rate, round(median(annual_rate), 6) + 0.0 AS median_rate,
             round(stddev_samp(annual_rate), 6) + 0.0 AS std_rate, round(min(annual_rate), 6) + 0.0 AS min_rate,
             round(max(annual_rate), 6) + 0.0 AS max_rate, count(*) FILTER (annual_rate > 2) AS periods_above_2_percent,
             count(*) FILTER (annual_rate < 0) AS periods_deflation FROM rates GROUP BY k""",
        "rates",
    ),
)
def rate_statistics(spark: SparkSession, sf: str) -> DataFrame:
    df = profile.rate_statistics(p.rate_panel(spark, sf), p.NATION.with_values("annual_rate"))
    return _rounded(df, mean_rate=6, median_rate=6, std_rate=6, min_rate=6, max_rate=6)


@query(
    "download_summary",
    with_ctes(
        """SELECT 'value' AS "column", count(*) AS total_records, CAST(min(t) AS VARCHAR) AS start_date,
             CAST(max(t) AS VARCHAR) AS end_date, count(DISTINCT t) AS total_months, count(*) - count(value) AS missing,
             round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, round(min(value), 4) AS min,
             round(max(value), 4) AS max FROM gaps""",
        "gaps",
    ),
)
def download_summary(spark: SparkSession, sf: str) -> DataFrame:
    df = profile.download_summary(p.gap_panel(spark, sf), "t", ["value"])
    return df.withColumns({c: F.col(c).cast("string") for c in ("start_date", "end_date")})


_SUMMARY_LAGS = ", ".join(
    f"lag(value, {k}) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS value_lag_{k}" for k in fe.LAGS
)
_SUMMARY_STATS = ", ".join(
    f"{f}(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS {n - 1} PRECEDING) AS value_{s}_{n}"
    for n in fe.WINDOWS
    for s, f in (("ma", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
)


@query(
    "feature_summary",
    with_ctes(
        """SELECT CASE WHEN contains(feature, '_lag_') THEN 'lag_features' WHEN feature = 'month' THEN 'seasonal_features'
                  WHEN regexp_matches(feature, '_(ma|std|min|max)_') THEN 'rolling_features' ELSE 'other' END AS category,
                  count(DISTINCT feature) AS features, count(*) AS cells, count(*) - count(x) AS missing
           FROM (FROM wide UNPIVOT INCLUDE NULLS (x FOR feature IN (COLUMNS(*)))) GROUP BY 1""",
        "gapticks",
        wide=f"SELECT value, {_SUMMARY_LAGS}, {_SUMMARY_STATS}, CAST(month(ts) AS DOUBLE) AS month FROM gapticks",
    ),
)
def feature_summary(spark: SparkSession, sf: str) -> DataFrame:
    df = fe.lags_and_rolling(p.gap_ticks(spark, sf), p.TICKS)
    df = df.withColumn("month", F.month("ts"))
    names = [c for c in df.columns if c not in ("event_type", "event_id", "ts")]
    return profile.feature_summary(fe.to_long(df, ["event_id"], names))


@query(
    "historical_statistics",
    with_ctes(
        """SELECT k, round(avg(rate), 6) + 0.0 AS mean, round(median(rate), 6) + 0.0 AS median,
             round(stddev_pop(rate), 6) + 0.0 AS std, round(min(rate), 6) + 0.0 AS min, round(max(rate), 6) + 0.0 AS max,
             count(rate) AS count,
             round(CASE WHEN avg(rate) = 0 THEN 0 ELSE stddev_pop(rate) / abs(avg(rate)) END, 6) + 0.0 AS coefficient_variation,
             round(max(rate) - min(rate), 6) + 0.0 AS range,
             round(quantile_cont(rate, 0.75) - quantile_cont(rate, 0.25), 6) + 0.0 AS iqr FROM prices GROUP BY k""",
        "prices",
    ),
)
def historical_statistics(spark: SparkSession, sf: str) -> DataFrame:
    df = profile.historical_statistics(p.price_panel(spark, sf), p.RATE)
    return _rounded(df, mean=6, median=6, std=6, min=6, max=6, coefficient_variation=6, range=6, iqr=6)


@query(
    "dispersion_ticks",
    """SELECT event_type, round(stddev_pop(value) / nullif(abs(avg(value)), 0), 8) + 0.0 AS coefficient_variation,
       round(max(value) - min(value), 4) + 0.0 AS range,
       round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 4) + 0.0 AS iqr FROM events GROUP BY event_type""",
)
def dispersion_ticks(spark: SparkSession, sf: str) -> DataFrame:
    df = profile.historical_statistics(p.ticks(spark, sf), p.TICKS)
    return _rounded(
        df.select("event_type", "coefficient_variation", "range", "iqr"), coefficient_variation=8, range=4, iqr=4
    )


@query(
    "regime_counts",
    with_ctes(
        """SELECT k, count(*) FILTER (rate > 3) AS high_inflation_periods, count(*) FILTER (rate < 1) AS low_inflation_periods,
             count(*) FILTER (rate < 0) AS deflation_periods, count(*) FILTER (rate BETWEEN 1 AND 3) AS stable_periods
           FROM prices GROUP BY k""",
        "prices",
    ),
)
def regime_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.regime_counts(p.price_panel(spark, sf), p.RATE)


def _histogram_sql(v: str, source: str, bins: int, by: str = "") -> str:
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    join = f"JOIN ends USING ({by})" if by else "CROSS JOIN ends"
    return f"""WITH ends AS (SELECT {key}CASE WHEN min({v}) = max({v}) THEN min({v}) - 0.5 ELSE min({v}) END AS lo,
        CASE WHEN min({v}) = max({v}) THEN max({v}) + 0.5 ELSE max({v}) END AS hi FROM {source} {group})
      SELECT {key}bin, round(lo + (hi - lo) / {bins} * bin, 6) + 0.0 AS lower, round(lo + (hi - lo) / {bins} * (bin + 1), 6) + 0.0 AS upper,
        count(*) AS n
      FROM (SELECT {key}lo, hi, CAST(least(floor(({v} - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS bin
            FROM {source} {join} WHERE {v} IS NOT NULL) GROUP BY {key}bin, lo, hi"""


@query("histogram", _histogram_sql("l_extendedprice", "lineitem", 20))
def histogram(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile.histogram(p.table(spark, sf, "lineitem"), "l_extendedprice", 20), lower=6, upper=6)


@query("histogram_by_key", _histogram_sql("value", "events", 15, "event_type"))
def histogram_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile.histogram(p.table(spark, sf, "events"), "value", 15, ["event_type"]), lower=6, upper=6)


@query(
    "boxplot",
    """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
       SELECT event_type, round(q1, 4) + 0.0 AS q1, round(median, 4) + 0.0 AS median, round(q3, 4) + 0.0 AS q3,
         round(min(value) FILTER (ok), 4) + 0.0 AS whisker_low, round(max(value) FILTER (ok), 4) + 0.0 AS whisker_high,
         count(*) FILTER (NOT ok) AS fliers
       FROM (SELECT *, value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) AS ok FROM events JOIN q USING (event_type))
       GROUP BY event_type, q1, median, q3""",
)
def boxplot(spark: SparkSession, sf: str) -> DataFrame:
    df = profile.boxplot(p.table(spark, sf, "events"), "value", ["event_type"])
    return _rounded(df, q1=4, median=4, q3=4, whisker_low=4, whisker_high=4)
