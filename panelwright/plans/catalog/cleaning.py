"""Gaps, dates, outliers, quality rules and column roles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions import times
from panelwright.operators import features as fe
from panelwright.operators import fill, quality
from panelwright.plans import panels as p
from panelwright.plans.catalog import query
from panelwright.plans.panels import rounded, with_ctes

_FRAME = "PARTITION BY {part} ORDER BY {order} ROWS BETWEEN"


def _points(source: str, part: str, order: str) -> dict[str, str]:
    """CTEs that put the nearest known value and its position on either side of each row."""
    over = _FRAME.format(part=part, order="p")
    return {
        "placed": f"SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS p FROM {source}",
        "points": f"""SELECT *,
            last_value(value IGNORE NULLS) OVER ({over} UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
            max(CASE WHEN value IS NOT NULL THEN p END) OVER ({over} UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
            first_value(value IGNORE NULLS) OVER ({over} CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
            min(CASE WHEN value IS NOT NULL THEN p END) OVER ({over} CURRENT ROW AND UNBOUNDED FOLLOWING) AS np
            FROM placed""",
    }


_LINEAR = "coalesce(value, pv + (nv - pv) * (CAST(p - pp AS DOUBLE) / nullif(np - pp, 0)), pv{end})"


def _filled(ids: str, expression: str, places: int, source: str, part: str, order: str, where: str = "") -> str:
    body = f"SELECT {ids}, round({expression}, {places}) + 0.0 AS value FROM points {where}"
    return with_ctes(body, source, **_points(source, part, order))


_K = "k, CAST(t AS VARCHAR) AS t"
_TICK = ("gapticks", "event_type", "ts, event_id")


def _panel_out(df: DataFrame, places: int = 4) -> DataFrame:
    return df.select("k", F.col("t").cast("string").alias("t"), rounded(F.col("value"), places).alias("value"))


def _tick_out(df: DataFrame, places: int = 4) -> DataFrame:
    return df.select("event_id", rounded(F.col("value"), places).alias("value"))


@query("interpolate", _filled(_K, _LINEAR.format(end=", nv"), 6, "gaps", "k", "t"))
def interpolate(spark: SparkSession, sf: str) -> DataFrame:
    return _panel_out(fill.interpolate(p.gap_panel(spark, sf), p.NATION), 6)


@query("interpolate_forward", _filled(_K, _LINEAR.format(end=""), 6, "gaps", "k", "t"))
def interpolate_forward(spark: SparkSession, sf: str) -> DataFrame:
    return _panel_out(fill.interpolate(p.gap_panel(spark, sf), p.NATION, ends="forward"), 6)


@query("interpolate_ticks", _filled("event_id", _LINEAR.format(end=", nv"), 6, *_TICK))
def interpolate_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Five long series, cut into blocks that hand their last known value on."""
    return _tick_out(fill.interpolate(p.gap_ticks(spark, sf), p.TICKS), 6)


@query("ffill_bfill_ticks", _filled("event_id", "coalesce(pv, nv)", 4, *_TICK))
def ffill_bfill_ticks(spark: SparkSession, sf: str) -> DataFrame:
    return _tick_out(fill.fill_neighbours(p.gap_ticks(spark, sf), p.TICKS))


_STATUS = """SELECT o_custkey, o_orderkey, o_orderdate,
    CASE WHEN o_orderpriority NOT LIKE '4%' THEN o_orderpriority END AS value FROM orders"""


@query(
    "ffill_bfill_categories",
    with_ctes(
        "SELECT o_orderkey, coalesce(pv, nv) AS value FROM points",
        statuses=_STATUS,
        **_points("statuses", "o_custkey", "o_orderdate, o_orderkey"),
    ),
)
def ffill_bfill_categories(spark: SparkSession, sf: str) -> DataFrame:
    """The priority of a customer's order, or of the order before (after) where it was not specified."""
    known = F.when(~F.col("o_orderpriority").startswith("4"), F.col("o_orderpriority"))
    orders = p.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", known.alias("value"))
    spec = p.SeriesSpec("o_custkey", "o_orderdate", "value", None, "o_orderkey", short=True)
    return fill.fill_neighbours(orders, spec).select("o_orderkey", "value")


@query(
    "fill_for_learning",
    with_ctes(
        """SELECT k, CAST(t AS VARCHAR) AS t, round(coalesce(lag1, lag1_prev, lag1_next, 0), 2) + 0.0 AS value_lag_1,
                  round(coalesce(value, pv, nv), 2) + 0.0 AS value
           FROM (SELECT *, last_value(lag1 IGNORE NULLS) OVER (PARTITION BY k ORDER BY p ROWS UNBOUNDED PRECEDING) AS lag1_prev,
                   first_value(lag1 IGNORE NULLS) OVER (PARTITION BY k ORDER BY p
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lag1_next
                 FROM (SELECT *, lag(value) OVER (PARTITION BY k ORDER BY p) AS lag1 FROM points))
           WHERE coalesce(value, pv, nv) IS NOT NULL""",
        "gaps",
        **_points("gaps", "k", "t"),
    ),
)
def fill_for_learning(spark: SparkSession, sf: str) -> DataFrame:
    lagged = fe.lags(p.gap_panel(spark, sf), p.NATION, [1])
    df = fill.prepare_matrix(lagged, p.NATION.with_values("value_lag_1", "value"), "value")
    return _panel_out(df, 2).join(
        df.select("k", F.col("t").cast("string").alias("t"), rounded(F.col("value_lag_1"), 2).alias("value_lag_1")),
        ["k", "t"],
    )


@query("regularise", with_ctes(f"SELECT {_K}, round(value, 2) + 0.0 AS value FROM gaps", "gaps"))
def regularise(spark: SparkSession, sf: str) -> DataFrame:
    return _panel_out(p.gap_panel(spark, sf), 2)


# --- outliers ------------------------------------------------------------------------


def _bounds(source: str, part: str, values: tuple[str, ...]) -> dict[str, str]:
    cells = []
    for v in values:
        q1, q3 = f"quantile_cont({v}, 0.25)", f"quantile_cont({v}, 0.75)"
        cells += [
            f"{q1} - 1.5 * ({q3} - {q1}) AS lo_{v}", f"{q3} + 1.5 * ({q3} - {q1}) AS hi_{v}",
            f"avg({v}) AS mean_{v}", f"stddev_samp({v}) AS sd_{v}",
        ]
    key = f"{part}, " if part else ""
    bounds = f"SELECT {key}{', '.join(cells)} FROM {source}" + (f" GROUP BY {part}" if part else "")
    flags = []
    for v in values:
        flags += [
            f"coalesce({v} < lo_{v} OR {v} > hi_{v}, false) AS iqr_{v}",
            f"coalesce(abs({v} - mean_{v}) / nullif(sd_{v}, 0) > 3, false) AS z_{v}",
        ]
    join = f"JOIN bounds USING ({part})" if part else "CROSS JOIN bounds"
    return {"bounds": bounds, "flagged": f"SELECT s.*, {', '.join(flags)} FROM {source} s {join}"}


_EVENT_FLAGS = _bounds("ticks", "event_type", ("value",))


@query(
    "outliers_iqr",
    with_ctes("SELECT event_id, round(value, 2) + 0.0 AS value FROM flagged WHERE iqr_value", "ticks", **_EVENT_FLAGS),
)
def outliers_iqr(spark: SparkSession, sf: str) -> DataFrame:
    flagged = quality.outlier_flags(p.ticks(spark, sf), p.TICKS)
    return _tick_out(flagged.where("value_iqr_outlier"), 2)


@query(
    "outliers_z",
    with_ctes("SELECT event_id, round(value, 2) + 0.0 AS value FROM flagged WHERE z_value", "ticks", **_EVENT_FLAGS),
)
def outliers_z(spark: SparkSession, sf: str) -> DataFrame:
    flagged = quality.outlier_flags(p.ticks(spark, sf), p.TICKS)
    return _tick_out(flagged.where("value_z_outlier"), 2)


_AMOUNTS = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice * l_quantity AS amount, l_quantity FROM lineitem"


@query(
    "outlier_rows",
    with_ctes(
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(amount, 2) + 0.0 AS amount FROM flagged "
        "WHERE iqr_amount OR z_amount OR iqr_l_quantity OR z_l_quantity",
        lines=_AMOUNTS,
        **_bounds("lines", "", ("amount", "l_quantity")),
    ),
)
def outlier_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of unusual value: one series, the whole table."""
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = p.table(spark, sf, "lineitem").select(
        *ids, (F.col("l_extendedprice") * F.col("l_quantity")).alias("amount"), "l_quantity"
    )
    spec = p.SeriesSpec((), "l_orderkey", ("amount", "l_quantity"))
    return quality.outlier_rows(lines, spec).select(*ids, rounded(F.col("amount"), 2).alias("amount"))


@query(
    "outlier_counts",
    with_ctes(
        """SELECT k, count(*) FILTER (iqr_monthly_rate) AS monthly_rate_iqr_count,
                  count(*) FILTER (z_monthly_rate) AS monthly_rate_z_count, count(*) FILTER (iqr_value) AS value_iqr_count,
                  count(*) FILTER (z_value) AS value_z_count,
                  count(*) FILTER (iqr_monthly_rate OR z_monthly_rate OR iqr_value OR z_value) AS outlier_rows
           FROM flagged GROUP BY k""",
        "rates",
        **_bounds("rates", "k", ("monthly_rate", "value")),
    ),
)
def outlier_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.outlier_counts(p.rate_panel(spark, sf), p.NATION.with_values("monthly_rate", "value"))


# --- scores and rules --------------------------------------------------------------------

@query(
    "quality_score",
    with_ctes(
        """SELECT round(greatest(0, least(100, 100 - 100.0 * (4 * count(*) - count(event_id) - count(ts) - count(event_type)
             - count(value)) / (4 * count(*)) + 5)), 6) + 0.0 AS quality_score FROM gapticks""",
        "gapticks",
    ),
)
def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    df = quality.quality_score(p.gap_ticks(spark, sf))
    return df.select(rounded(F.col("quality_score"), 6).alias("quality_score"))


@query(
    "completeness",
    with_ctes(
        """SELECT round(100.0 * (count(event_id) + count(ts) + count(event_type) + count(value)) / (4 * count(*)), 6) + 0.0
             AS completeness_score FROM gapticks""",
        "gapticks",
    ),
)
def completeness(spark: SparkSession, sf: str) -> DataFrame:
    df = quality.completeness(p.gap_ticks(spark, sf))
    return df.select(rounded(F.col("completeness_score"), 6).alias("completeness_score"))


@query(
    "duplicates",
    """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, round(100.0 * sum(n - 1) / sum(n), 6) + 0.0 AS duplicate_percentage
       FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, n_chars)""",
)
def duplicates(spark: SparkSession, sf: str) -> DataFrame:
    df = quality.duplicates(p.table(spark, sf, "documents").select("text", "lang", "n_chars"))
    return df.withColumn("duplicate_percentage", rounded(F.col("duplicate_percentage"), 6))


@query(
    "export_rules",
    with_ctes(
        """SELECT * FROM (
             SELECT 'not_empty' AS rule, NULL AS "column", 'error' AS severity, n > 0 AS passed FROM c
             UNION ALL SELECT 'required_column', 'ts', 'error', true FROM c
             UNION ALL SELECT 'required_column', 'ipc_general', 'error', false FROM c
             UNION ALL SELECT 'dates_parse', 'ts', 'error', ts > 0 FROM c
             UNION ALL SELECT 'not_all_missing', 'event_id', 'warning', event_id > 0 FROM c
             UNION ALL SELECT 'at_most_80_percent_missing', 'event_id', 'warning', n - event_id = n OR n - event_id <= n * 0.8 FROM c
             UNION ALL SELECT 'at_most_50_percent_missing', 'event_id', 'warning', n - event_id > n * 0.8 OR n - event_id <= n * 0.5 FROM c
             UNION ALL SELECT 'not_all_missing', 'value', 'warning', value > 0 FROM c
             UNION ALL SELECT 'at_most_80_percent_missing', 'value', 'warning', n - value = n OR n - value <= n * 0.8 FROM c
             UNION ALL SELECT 'at_most_50_percent_missing', 'value', 'warning', n - value > n * 0.8 OR n - value <= n * 0.5 FROM c
             UNION ALL SELECT 'quality_score_50', NULL, 'warning',
               100 - 100.0 * (4 * n - event_id - ts - event_type - value) / (4 * n) + 5 >= 50 FROM c)""",
        "gapticks",
        c="""SELECT count(*) AS n, count(event_id) AS event_id, count(ts) AS ts, count(event_type) AS event_type,
             count(value) AS value FROM gapticks""",
    ),
)
def export_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.export_rules(p.gap_ticks(spark, sf), ["ts", "ipc_general"], "ts")


# --- dates ----------------------------------------------------------------------------------

# Each type of event writes its time in another way, and one not at all.
_DATE_TEXT = """SELECT event_id, ts, CASE event_type
    WHEN 'click' THEN CAST(epoch_us(ts) // 1000 AS VARCHAR)
    WHEN 'error' THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)
    WHEN 'purchase' THEN strftime(ts, '%Y-%m-%d') WHEN 'signup' THEN strftime(ts, '%d/%m/%Y')
    ELSE 'unknown' END AS written FROM events"""


def _written_dates(spark: SparkSession, sf: str) -> DataFrame:
    since = "timestampdiff({}, timestamp_ntz'1970-01-01', ts)"
    at, kind = F.col("ts"), F.col("event_type")
    text = (
        F.when(kind == "click", F.expr(since.format("MILLISECOND")).cast("string"))
        .when(kind == "error", F.expr(since.format("SECOND")).cast("string"))
        .when(kind == "purchase", F.date_format(at, "yyyy-MM-dd"))
        .when(kind == "signup", F.date_format(at, "dd/MM/yyyy"))
        .otherwise("unknown")
    )
    return p.table(spark, sf, "events").select("event_id", text.alias("written"))


@query(
    "epoch_dates",
    f"""SELECT event_id, CASE
          WHEN written LIKE '%-%' OR written LIKE '%/%' THEN CAST(CAST(CAST(ts AS DATE) AS TIMESTAMP) AS VARCHAR)
          WHEN written <> 'unknown' THEN CAST((make_timestamp(
            CASE WHEN CAST(written AS DOUBLE) > 1e12 THEN CAST(written AS BIGINT) * 1000 ELSE CAST(written AS BIGINT) * 1000000 END)
            AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Madrid' AS VARCHAR) END AS t
        FROM ({_DATE_TEXT})""",
)
def epoch_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Epoch milliseconds, seconds and two text formats; numbers are read in the zone of the source."""
    at = times.any_to_ntz(F.col("written"), "Europe/Madrid").cast("string")
    return _written_dates(spark, sf).select("event_id", at.alias("t"))


_IS_DATE = "(written LIKE '%-%' OR written LIKE '%/%')"


@query(
    "parse_dates",
    f"SELECT event_id, CASE WHEN {_IS_DATE} THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS written FROM ({_DATE_TEXT})",
)
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    df = quality.normalise_dates(_written_dates(spark, sf), ["written"])
    return df.withColumn("written", F.col("written").cast("date").cast("string"))


@query(
    "date_failures",
    f"""SELECT 'written' AS "column", count(*) FILTER (NOT {_IS_DATE}) AS failed FROM ({_DATE_TEXT})""",
)
def date_failures(spark: SparkSession, sf: str) -> DataFrame:
    return quality.date_failures(_written_dates(spark, sf), ["written"])


@query(
    "detect_dates",
    "SELECT o_orderkey, o_orderpriority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders",
)
def detect_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Only the text column that holds dates is converted."""
    orders = p.table(spark, sf, "orders")
    texts = orders.select("o_orderkey", "o_orderpriority", F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"))
    df = quality.normalise_dates(texts)
    return df.withColumn("day", F.col("day").cast("date").cast("string"))


@query(
    "date_range",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders
       WHERE o_orderdate BETWEEN DATE '1996-03-01' AND DATE '1998-02-28'""",
)
def date_range(spark: SparkSession, sf: str) -> DataFrame:
    df = quality.date_range(p.table(spark, sf, "orders"), "o_orderdate", "1996-03-01", "1998-02-28")
    return df.select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("day"))


# --- names, roles, rounding ---------------------------------------------------------------------


@query(
    "rename_general",
    with_ctes("SELECT CAST(t AS VARCHAR) AS fecha, round(value, 2) + 0.0 AS ipc_general FROM total", "total"),
)
def rename_general(spark: SparkSession, sf: str) -> DataFrame:
    df = p.total_series(spark, sf).select(
        F.col("t").cast("string").alias("Fecha"), rounded(F.col("value"), 2).alias("Valor")
    )
    return quality.standard_names(df, quality.GENERAL_NAMES)


@query(
    "rename_harmonised",
    with_ctes("SELECT CAST(t AS VARCHAR) AS fecha, round(value, 2) + 0.0 AS ipca FROM total", "total"),
)
def rename_harmonised(spark: SparkSession, sf: str) -> DataFrame:
    df = p.total_series(spark, sf).select(
        F.col("t").cast("string").alias("Date"), rounded(F.col("value"), 2).alias("Indice")
    )
    return quality.standard_names(df, quality.HARMONISED_NAMES)


@query(
    "sector_panel",
    with_ctes(
        " UNION ALL ".join(
            f"SELECT CAST(t AS VARCHAR) AS fecha, '{quality.SECTOR_NAMES[s]}' AS sector, round(s{i}, 2) + 0.0 AS value FROM sectors"
            for i, s in enumerate(p.SECTORS)
        ),
        "sectors",
    ),
)
def sector_panel(spark: SparkSession, sf: str) -> DataFrame:
    """All twelve sectors under their standard names."""
    df = quality.sectors_to_panel(p.sector_table(spark, sf).withColumnRenamed("t", "Fecha"))
    return df.select(F.col("fecha").cast("string").alias("fecha"), "sector", rounded(F.col("value"), 2).alias("value"))


@query(
    "column_roles",
    """SELECT 'o_orderkey' AS "column", 'bigint' AS dtype, count(o_orderkey) AS non_null, 0.0 AS date_share,
              round(avg(o_orderkey), 4) AS mean, false AS is_date, true AS is_value, false AS is_price_index, true AS is_target FROM orders
       UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus), 0.0, NULL, false, false, false, false FROM orders
       UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice), 0.0, round(avg(o_totalprice), 4), false, false, true, false FROM orders
       UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', count(o_orderdate), 1.0, NULL, true, false, false, false FROM orders
       UNION ALL SELECT 'day', 'string', count(*), 1.0, NULL, false, false, false, false FROM orders
       UNION ALL SELECT 'epoch', 'double', count(*), 1.0, round(avg(epoch_ms(o_orderdate)), 4), false, false, false, false FROM orders""",
)
def column_roles(spark: SparkSession, sf: str) -> DataFrame:
    orders = p.table(spark, sf, "orders")
    millis = F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01', o_orderdate)").cast("double")
    df = orders.select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        F.date_format("o_orderdate", "yyyyMMdd").alias("day"), millis.alias("epoch"),
    )
    return quality.column_roles(df).withColumns(
        {"date_share": rounded(F.col("date_share"), 6), "mean": rounded(F.col("mean"), 4)}
    )


@query(
    "round_numbers",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice / 7, 4) AS unit, round(l_discount * l_tax, 4) AS both
       FROM lineitem""",
)
def round_numbers(spark: SparkSession, sf: str) -> DataFrame:
    lines = p.table(spark, sf, "lineitem")
    df = lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_extendedprice") / 7).alias("unit"), (F.col("l_discount") * F.col("l_tax")).alias("both"),
    )
    return quality.round_numbers(df, 4)
