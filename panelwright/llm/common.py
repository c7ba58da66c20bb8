"""What several operators share: white space, row keys, hashes, shared tables."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def whole_row(docs: DataFrame) -> Column:
    """All columns in one, so that none clashes with the columns an operator adds; ``select("_row.*")`` undoes it."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def without_white(text: Column) -> Column:
    return F.translate(text, WHITE, "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def matched(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match; the right-hand keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    joined = left.join(renamed, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys], how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
