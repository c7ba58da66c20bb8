"""CSV tables and a landing folder of several data sets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.operators.quality import GENERAL_NAMES, HARMONISED_NAMES, SECTOR_NAMES, standard_names


class EmptyInputError(ValueError):
    """The input exists but holds no rows."""


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, comment: str | None = None, required: bool = True
) -> DataFrame:
    """Typed CSV with header; rows that do not fit the schema fail the job that reads them."""
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("encoding", "UTF-8")
    if comment:
        reader = reader.option("comment", comment)
    try:
        df = reader.csv(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from missing
        raise
    if required and df.isEmpty():
        raise EmptyInputError(path)
    return df


# The data sets of a landing folder and their column names.
DATASET_NAMES: Mapping[str, Mapping[str, str]] = {
    "general": GENERAL_NAMES,
    "groups": SECTOR_NAMES,
    "ipca": HARMONISED_NAMES,
}


def read_landing(spark: SparkSession, root: str, schemas: Mapping[str, T.StructType | str]) -> DataFrame:
    """All data sets under ``root/<data_type>/`` in one table.

    ``data_type`` comes from the path of each file, columns one data set lacks
    are NULL in its rows.
    """
    out = None
    for data_type, schema in schemas.items():
        if data_type not in DATASET_NAMES:
            raise ValueError(f"unknown data set {data_type!r}")
        raw = read_csv(spark, f"{root}/{data_type}", schema, required=False)
        folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
        part = standard_names(raw.select("*", folder.alias("data_type")), DATASET_NAMES[data_type])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
