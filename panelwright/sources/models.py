"""Saved Spark ML models and the table that lists them."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "name string, model_type string, path string, parameters string, saved_at timestamp"


def save_model(
    model: PipelineModel, root: str, name: str, model_type: str, spark: SparkSession, parameters: Mapping | None = None
) -> str:
    """Writes the model below ``root`` and adds its row to the models table."""
    path = f"{root}/{name}"
    model.write().overwrite().save(path)
    row = spark.createDataFrame(
        [(name, model_type, path, json.dumps(dict(parameters or {}), sort_keys=True), None)], SCHEMA
    )
    row.withColumn("saved_at", F.current_timestamp()).write.mode("append").parquet(f"{root}/_models_table")
    return path


def saved_models(spark: SparkSession, root: str) -> DataFrame:
    """The newest row of each model name."""
    table = spark.read.parquet(f"{root}/_models_table")
    newest = F.max_by(F.struct("model_type", "path", "parameters", "saved_at"), "saved_at").alias("_m")
    return table.groupBy("name").agg(newest).select("name", "_m.*")


def load_model(spark: SparkSession, root: str, name: str) -> PipelineModel:
    row = saved_models(spark, root).where(F.col("name") == name).first()
    if row is None:
        raise FileNotFoundError(f"no model {name!r} under {root}")
    return PipelineModel.load(row["path"])
