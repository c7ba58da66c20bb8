"""Writers for raw tables, features, forecasts, reports and analyses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.times import any_to_ntz
from panelwright.operators.layout import join_on
from panelwright.operators.profile import prediction_statistics
from panelwright.operators.quality import export_rules, round_numbers
from panelwright.spec import SeriesSpec

DECIMALS = 4
DATE_FORMAT = "yyyy-MM-dd"
# Columns a data set must have to be exported.
REQUIRED = {"general": ("fecha", "ipc_general"), "groups": ("fecha",), "ipca": ("fecha", "ipca")}


class ExportRefused(ValueError):
    """The table breaks an export rule of severity 'error'."""


def prepare_export(df: DataFrame, data_type: str, extracted_at: str, time: str = "fecha", zone: str = "UTC") -> DataFrame:
    """Dates as texts, rows in date order, with data set name and extraction time.

    Rows are range-partitioned by date, so the written parts are in order
    without a single task seeing all rows.
    """
    if isinstance(df.schema[time].dataType, (T.StringType, T.NumericType)):
        at: Column = any_to_ntz(F.col(time).cast("string"), zone)
    else:
        at = F.col(time).cast("timestamp_ntz")
    out = df.withColumn("_at", at).repartitionByRange("_at").sortWithinPartitions("_at")
    return out.withColumns(
        {
            time: F.date_format("_at", DATE_FORMAT),
            "data_type": F.lit(data_type),
            "extraction_date": F.lit(extracted_at),
        }
    ).drop("_at")


def write_raw(df: DataFrame, path: str, data_type: str, extracted_at: str, time: str = "fecha", fmt: str = "csv") -> None:
    """Checks, prepares, rounds and writes a raw table."""
    broken = export_rules(df, REQUIRED[data_type], time).where("severity = 'error' AND NOT passed")
    names = [(r["rule"], r["column"]) for r in broken.collect()]  # at most one row per rule and column
    if names:
        raise ExportRefused(f"{data_type}: {names}")
    out = round_numbers(prepare_export(df, data_type, extracted_at, time), DECIMALS)
    writer = out.write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path)


def write_features(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Features as Parquet; partition columns must have few values, keys of a large panel do not."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def forecast_rows(df: DataFrame, time: str = "t") -> DataFrame:
    """A forecast as it is exported: dates as texts, numbers rounded."""
    return round_numbers(df, DECIMALS).withColumn(time, F.date_format(time, DATE_FORMAT))


def write_forecast_csv(df: DataFrame, path: str, metadata: dict[str, str] | None = None, time: str = "t") -> None:
    """CSV parts; the metadata goes into a part of '#' lines that readers skip."""
    forecast_rows(df, time).write.mode("overwrite").option("header", True).csv(path)
    if metadata:
        lines = [(f"# {k}: {v}",) for k, v in metadata.items()]
        df.sparkSession.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(path)


def forecast_documents(df: DataFrame, spec: SeriesSpec, exported_at: str) -> DataFrame:
    """(keys, document): one JSON text per key with its predictions and their summary."""
    keys = list(spec.keys)
    others = [spec.time, *[c for c in df.columns if c not in (*keys, spec.time)]]
    rows = F.array_sort(F.collect_list(F.struct(*others)))  # one key's horizon, in date order
    listed = forecast_rows(df, spec.time).groupBy(*keys).agg(rows.alias("predictions"))
    summary = prediction_statistics(df, spec)
    stats = [c for c in summary.columns if c not in keys]
    both = join_on(listed, round_numbers(summary, DECIMALS).select(*keys, F.struct(*stats).alias("summary")), keys)
    meta = F.struct(F.lit(exported_at).alias("export_timestamp"), F.col("summary"))
    return both.select(*keys, F.to_json(F.struct("predictions", meta.alias("metadata"))).alias("document"))


def report_documents(
    df: DataFrame, checks: DataFrame, metrics: DataFrame, spec: SeriesSpec, generated_at: str
) -> DataFrame:
    """(keys, document): predictions, summary, validation and model scores of each key."""
    keys = list(spec.keys)
    body = forecast_documents(df, spec, generated_at)
    validation = checks.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("check", "severity", "passed"))).alias("validation")
    )
    models = round_numbers(metrics, DECIMALS).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("model", "mae", "rmse", "mape"))).alias("models")
    )
    out = join_on(join_on(body, validation, keys, "left"), models, keys, "left")
    parts = F.to_json(F.struct(F.lit(generated_at).alias("generated_at"), "validation", "models"))
    return out.select(*keys, F.concat(F.lit('{"report":'), parts, F.lit(',"forecast":'), "document", F.lit("}")).alias("document"))


def write_documents(df: DataFrame, path: str) -> None:
    """One document per line."""
    df.select("document").write.mode("overwrite").text(path)


def write_analysis(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
