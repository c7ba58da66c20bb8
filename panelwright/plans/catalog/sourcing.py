"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators import features as fe
from panelwright.operators.checks import forecast_checks
from panelwright.operators.quality import SECTOR_NAMES
from panelwright.plans import panels as p
from panelwright.plans.catalog import query
from panelwright.plans.panels import rounded, with_ctes
from panelwright.session import scratch_path
from panelwright.sources import documents, sinks, tables
from panelwright.streaming import landing

_STAMP = "2024-06-30 12:00:00"
DOC_SIZE = 16  # events per document

# --- documents built from the events table ---------------------------------------------------


def _records(spark: SparkSession, sf: str) -> DataFrame:
    events = p.table(spark, sf, "events")
    millis = F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01', ts)")
    record = F.struct(millis.alias("Fecha"), F.col("value").alias("Valor"), F.col("event_id").alias("Id"))
    return events.select(
        F.floor(F.col("event_id") / DOC_SIZE).alias("doc"), "event_type", "event_id", record.alias("record")
    )


def _lists(spark: SparkSession, sf: str) -> DataFrame:
    """(doc, list): the records of up to sixteen events as JSON text."""
    listed = _records(spark, sf).groupBy("doc").agg(F.collect_list("record").alias("records"))
    return listed.select("doc", F.to_json("records").alias("list"))


def _arrays(spark: SparkSession, sf: str) -> DataFrame:
    """(doc, json): one named series per event type."""
    series = _records(spark, sf).groupBy("doc", "event_type").agg(F.collect_list("record").alias("Data"))
    whole = series.groupBy("doc").agg(F.collect_list(F.struct(F.col("event_type").alias("Nombre"), "Data")).alias("all"))
    return whole.select("doc", F.to_json("all").alias("json"))


def _wrapped(before: str, after: str) -> Column:
    return F.concat(F.lit(before), F.col("list"), F.lit(after)).alias("json")


_KNOWN = ('{"unit":"index","Data":[],"datos":', "}")
_BEST = ('{"codes":[1,2,3],"rows":', ',"total":7}')


def _read(records: DataFrame, zone: str = "Europe/Madrid") -> DataFrame:
    fields = {"t": ("Fecha", "string"), "value": ("Valor", "double"), "event_id": ("Id", "bigint")}
    typed = documents.record_fields(records, fields)
    return typed.withColumn("t", documents.any_to_ntz(F.col("t"), zone).cast("string"))


_LOCAL = """CAST((make_timestamp(epoch_us(ts) // 1000 * 1000) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Madrid' AS VARCHAR)"""


def _document_sql(strategy: str, series: str = "NULL") -> str:
    return f"""SELECT event_id, event_id // {DOC_SIZE} AS doc, '{strategy}' AS strategy, {series} AS series, {_LOCAL} AS t, value
        FROM events"""


@query("json_array_of_objects", _document_sql("array_of_objects", "event_type"))
def json_array_of_objects(spark: SparkSession, sf: str) -> DataFrame:
    return _read(documents.parse_documents(_arrays(spark, sf), "json")[0])


@query("json_direct_list", _document_sql("direct_list"))
def json_direct_list(spark: SparkSession, sf: str) -> DataFrame:
    docs = _lists(spark, sf).withColumnRenamed("list", "json")
    return _read(documents.parse_documents(docs, "json")[0])


@query("json_known_key", _document_sql("known_key"))
def json_known_key(spark: SparkSession, sf: str) -> DataFrame:
    docs = _lists(spark, sf).select("doc", _wrapped(*_KNOWN))
    return _read(documents.parse_documents(docs, "json")[0])


@query("json_best_list", _document_sql("best_list"))
def json_best_list(spark: SparkSession, sf: str) -> DataFrame:
    docs = _lists(spark, sf).select("doc", _wrapped(*_BEST))
    return _read(documents.parse_documents(docs, "json")[0])


def _mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of every shape, one in six cut off in the middle; in one in six every event is an object of its own."""
    shape = F.pmod(F.col("doc"), F.lit(6))
    both = _lists(spark, sf).join(_arrays(spark, sf), "doc")
    broken = F.substring("list", 1, 20)
    text = (
        F.when(shape == 0, F.col("json"))
        .when(shape == 1, F.col("list"))
        .when(shape == 2, F.concat(F.lit(_KNOWN[0]), "list", F.lit(_KNOWN[1])))
        .when(shape == 3, F.concat(F.lit(_BEST[0]), "list", F.lit(_BEST[1])))
        .otherwise(broken)
    )
    single = F.to_json(F.col("record").withField("note", F.struct(F.col("event_type").alias("kind"))))
    singles = _records(spark, sf).where(shape == 4).select("doc", single.alias("json"))
    return both.where(shape != 4).select("doc", text.alias("json")).unionByName(singles)


_SHAPES = "CASE event_id // 16 % 6 WHEN 0 THEN 'array_of_objects' WHEN 1 THEN 'direct_list' WHEN 2 THEN 'known_key' WHEN 3 THEN 'best_list' WHEN 4 THEN 'normalise' END"


@query(
    "json_cascade",
    f"""SELECT event_id, event_id // {DOC_SIZE} AS doc, {_SHAPES} AS strategy,
          CASE WHEN event_id // 16 % 6 = 0 THEN event_type END AS series, {_LOCAL} AS t, value
        FROM events WHERE event_id // 16 % 6 < 5""",
)
def json_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Each document is read by the first strategy that fits it."""
    return _read(documents.parse_documents(_mixed(spark, sf), "json")[0])


@query("json_quarantine", "SELECT DISTINCT event_id // 16 AS doc FROM events WHERE event_id // 16 % 6 = 5")
def json_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return documents.parse_documents(_mixed(spark, sf), "json")[1].select("doc")


@query(
    "json_flatten",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS info_k, event_type AS info_kind, event_id % 10 AS digit
       FROM events""",
)
def json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Nested properties as columns with dotted names."""
    info = F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"), F.col("event_type").alias("kind"))
    nested = F.to_json(F.struct(info.alias("info"), F.pmod("event_id", F.lit(10)).alias("digit")))
    flat = documents.flatten_json(p.table(spark, sf, "events").select("event_id", nested.alias("json")), "json")
    return flat.withColumnsRenamed({"info.k": "info_k", "info.kind": "info_kind"})


@query(
    "json_leaves",
    """SELECT event_id, 'info.k' AS path, json_extract_string(props, '$.k') AS value FROM events
       UNION ALL SELECT event_id, 'info.kind', event_type FROM events
       UNION ALL SELECT event_id, 'digits[' || i || ']', CAST((event_id + i) % 10 AS VARCHAR) FROM events, range(2) r(i)""",
)
def json_leaves(spark: SparkSession, sf: str) -> DataFrame:
    """Nested properties as rows of path and value, without a common schema."""
    info = F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"), F.col("event_type").alias("kind"))
    digits = F.array(*[F.pmod(F.col("event_id") + i, F.lit(10)) for i in range(2)])
    nested = F.to_json(F.struct(info.alias("info"), digits.alias("digits")))
    return documents.json_leaves(p.table(spark, sf, "events").select("event_id", nested.alias("json")), "json")


# --- CSV ----------------------------------------------------------------------------------------

_ORDER_SCHEMA = "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"


@query(
    "csv_scan",
    """SELECT o_orderkey, round(o_totalprice, 2) + 0.0 AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
       FROM orders""",
)
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    columns = [c.split()[0] for c in _ORDER_SCHEMA.split(", ")]
    p.table(spark, sf, "orders").select(*columns).write.option("header", True).csv(path)
    df = tables.read_csv(spark, path, _ORDER_SCHEMA)
    return df.withColumns(
        {"o_totalprice": rounded(F.col("o_totalprice"), 2), "o_orderdate": F.col("o_orderdate").cast("string")}
    )


_LANDING_SCHEMAS = {
    "general": "Fecha date, Valor double",
    "groups": "Fecha date, " + ", ".join(f"`{s}` double" for s in p.SECTORS),
    "ipca": "Fecha date, IPCA double",
}


def _land(spark: SparkSession, sf: str) -> str:
    root = scratch_path(spark, "landing")
    total, wide = p.total_series(spark, sf), p.sector_table(spark, sf)
    parts = {
        "general": total.select(F.col("t").alias("Fecha"), F.col("value").alias("Valor")),
        "groups": wide.withColumnRenamed("t", "Fecha"),
        "ipca": total.where(F.month("t").isin(1, 4, 7, 10)).select(F.col("t").alias("Fecha"), F.col("value").alias("IPCA")),
    }
    for name, df in parts.items():
        df.write.option("header", True).csv(f"{root}/{name}")
    return root


_SECTOR_COLUMNS = [SECTOR_NAMES[s] for s in p.SECTORS]
_NO_SECTOR = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in _SECTOR_COLUMNS)


@query(
    "landing_ingest",
    with_ctes(
        f"""SELECT 'general' AS data_type, CAST(t AS VARCHAR) AS fecha, round(value, 2) AS ipc_general, {_NO_SECTOR}, CAST(NULL AS DOUBLE) AS ipca FROM total
           UNION ALL SELECT 'groups', CAST(t AS VARCHAR), NULL, {', '.join(f"round(s{i}, 2)" for i in range(len(p.SECTORS)))}, NULL FROM sectors
           UNION ALL SELECT 'ipca', CAST(t AS VARCHAR), NULL, {', '.join('NULL' for _ in p.SECTORS)}, round(value, 2) FROM total
             WHERE month(t) IN (1, 4, 7, 10)""",
        "total",
        "sectors",
    ),
)
def landing_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Three data sets of a landing folder in one table, named by their folder; twelve sectors in one of them."""
    df = tables.read_landing(spark, _land(spark, sf), _LANDING_SCHEMAS)
    numbers = {c: F.round(c, 2) for c in ("ipc_general", *_SECTOR_COLUMNS, "ipca")}
    return df.withColumns({"fecha": F.col("fecha").cast("string"), **numbers})


@query(
    "landing_incremental",
    with_ctes("SELECT CAST(t AS VARCHAR) AS fecha, round(value, 2) AS valor FROM total", "total"),
)
def landing_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Files that arrive in two portions are each ingested once."""
    root, total = scratch_path(spark, "incremental"), p.total_series(spark, sf)
    schema = spark.createDataFrame([], "Fecha date, Valor double").schema
    rows = total.select(F.col("t").alias("Fecha"), F.col("value").alias("Valor"))
    for early in (True, False):
        part = rows.where((F.col("Fecha") < "1998-01-01") == F.lit(early))
        part.write.mode("append").option("header", True).csv(f"{root}/in")
        landing.ingest_new_files(spark, f"{root}/in", schema, f"{root}/state", landing.append_batches(f"{root}/out"))
    df = spark.read.parquet(f"{root}/out")
    return df.select(F.col("Fecha").cast("string").alias("fecha"), F.round("Valor", 2).alias("valor"))


# --- sinks ----------------------------------------------------------------------------------------


@query(
    "raw_export",
    with_ctes(
        f"""SELECT CAST(t AS VARCHAR) AS fecha, round(value, 4) + 0.0 AS ipc_general, 'general' AS data_type,
              '{_STAMP}' AS extraction_date FROM total""",
        "total",
    ),
)
def raw_export(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    df = p.total_series(spark, sf).select(F.col("t").cast("string").alias("fecha"), F.col("value").alias("ipc_general"))
    sinks.write_raw(df, path, "general", _STAMP)
    return tables.read_csv(
        spark, path, "fecha string, ipc_general double, data_type string, extraction_date string"
    )


@query(
    "export_prepare",
    f"""SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000000 * 1000000), '%Y-%m-%d') AS fecha, 'general' AS data_type,
        '{_STAMP}' AS extraction_date FROM events""",
)
def export_prepare(spark: SparkSession, sf: str) -> DataFrame:
    """Epoch dates become texts; rows are spread by date range and sorted in each part."""
    seconds = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01', ts)")
    df = p.table(spark, sf, "events").select("event_id", seconds.alias("fecha"))
    return sinks.prepare_export(df, "general", _STAMP)


@query(
    "features_parquet",
    with_ctes(
        "SELECT k, CAST(t AS VARCHAR) AS t, round(lag(value, 1) OVER (PARTITION BY k ORDER BY t), 2) + 0.0 AS value_lag_1 FROM panel",
        "panel",
    ),
)
def features_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """Features written by nation and read back."""
    path = scratch_path(spark, "features")
    sinks.write_features(fe.lags(p.nation_panel(spark, sf).select("k", "t", "value"), p.NATION, [1]), path, ["k"])
    df = spark.read.parquet(path)
    return df.select("k", F.col("t").cast("string").alias("t"), rounded(F.col("value_lag_1"), 2).alias("value_lag_1"))


_FORECAST_SCHEMA = "k string, t string, prediction double, lower double, upper double, model string, level double"
_EXPORTED = """SELECT k, CAST(t AS VARCHAR) AS t, round(prediction, 4) + 0.0 AS prediction, round(lower, 4) + 0.0 AS lower,
    round(upper, 4) + 0.0 AS upper, model, 0.95 AS level FROM chosen"""


def _forecast(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    forecast, metrics = p.chosen_forecast(p.written_prices(spark, sf))
    return forecast.select("k", "t", "prediction", "lower", "upper", "model", "level"), metrics


@query("forecast_csv", with_ctes(_EXPORTED, "chosen"))
def forecast_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The forecast as CSV with '#' metadata lines, read back without them."""
    path = scratch_path(spark, "forecast")
    sinks.write_forecast_csv(_forecast(spark, sf)[0], path, {"Generated": _STAMP, "Confidence Level": "0.95"})
    df = tables.read_csv(spark, path, _FORECAST_SCHEMA, comment="#")
    return df.withColumns({c: F.col(c) + F.lit(0.0) for c in ("prediction", "lower", "upper")})


_DOC = "struct<predictions:array<struct<t:string,prediction:double,lower:double,upper:double,model:string,level:double>>>"


@query("forecast_json", with_ctes(_EXPORTED, "chosen"))
def forecast_json(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON document per key, written and read back."""
    path = scratch_path(spark, "forecast")
    docs = sinks.forecast_documents(_forecast(spark, sf)[0], p.RATE, _STAMP)
    keyed = docs.select(F.to_json(F.struct("k", "document")).alias("document"))
    sinks.write_documents(keyed, path)
    back = spark.read.schema("k string, document string").json(path)
    rows = back.select("k", F.inline(F.from_json("document", _DOC)["predictions"]))
    return rows.withColumns({c: F.col(c) + F.lit(0.0) for c in ("prediction", "lower", "upper")})


@query(
    "forecast_report",
    with_ctes(
        """SELECT k, 12 AS predictions, 8 AS checks, any_value(models) AS models, round(avg(prediction), 4) + 0.0 AS mean_prediction
           FROM chosen JOIN (SELECT k, count(*) AS models FROM metrics GROUP BY k) USING (k) GROUP BY k""",
        "chosen",
    ),
)
def forecast_report(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions, summary, validation and model scores of a key in one document."""
    forecast, metrics = _forecast(spark, sf)
    docs = sinks.report_documents(forecast, forecast_checks(forecast, ["k"]), metrics, p.RATE, _STAMP)
    size = lambda path: F.size(F.from_json(F.get_json_object("document", path), "array<string>"))
    return docs.select(
        "k",
        size("$.forecast.predictions").alias("predictions"),
        size("$.report.validation").alias("checks"),
        size("$.report.models").alias("models"),
        (F.get_json_object("document", "$.forecast.metadata.summary.mean_prediction").cast("double") + 0.0).alias("mean_prediction"),
    )
