"""Supervised data sets: alignment, chronological splits, scaling, folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.layout import POS, join_on, number_rows, settled
from panelwright.spec import SeriesSpec

TEST_SIZE = 0.2


def align(features: DataFrame, target: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows that have both features and a target."""
    return join_on(features, target, [*spec.keys, *spec.order])


def _sized(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Adds the position of each row and the length of its series."""
    keys = list(spec.keys)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    sizes = sizes if spec.bounded else settled(sizes, "sizes")
    return join_on(number_rows(df, spec), sizes, keys)


def chrono_split(df: DataFrame, spec: SeriesSpec, test_size: float = TEST_SIZE) -> DataFrame:
    """Adds ``part``: the oldest rows of each series are 'train', the rest 'test'."""
    cut = F.floor(F.col("_size") * (1.0 - test_size))
    return (
        _sized(df, spec)
        .withColumn("part", F.when(F.col(POS) <= cut, "train").otherwise("test"))
        .drop(POS, "_size")
    )


def scale_statistics(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation of each column; a zero deviation counts as one."""
    aggs = []
    for c in columns:
        sd = F.stddev_pop(c)
        aggs += [F.avg(c).alias(f"mean_{c}"), F.when(sd == 0, 1.0).otherwise(sd).alias(f"sd_{c}")]
    return df.groupBy(*by).agg(*aggs)


def standardise(df: DataFrame, statistics: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(x - mean) / sd with statistics of the training rows."""
    out = join_on(df, statistics, by)
    return out.withColumns({c: (F.col(c) - F.col(f"mean_{c}")) / F.col(f"sd_{c}") for c in columns}).select(
        *df.columns
    )


def unstandardise(df: DataFrame, statistics: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    out = join_on(df, statistics, by)
    return out.withColumns({c: F.col(c) * F.col(f"sd_{c}") + F.col(f"mean_{c}") for c in columns}).select(*df.columns)


def expanding_folds(df: DataFrame, spec: SeriesSpec, folds: int = 5) -> DataFrame:
    """(row, fold, part): every fold trains on all rows before its test block.

    Test blocks hold size // (folds + 1) rows each and end at the last row.
    """
    width = F.floor(F.col("_size") / (folds + 1)).cast("long")
    start = [F.col("_size") - (folds - i) * width for i in range(folds)]
    rows = [
        F.struct(
            F.lit(i + 1).alias("fold"),
            F.when(F.col(POS) <= start[i], "train").when(F.col(POS) <= start[i] + width, "test").alias("part"),
        )
        for i in range(folds)
    ]
    return (
        _sized(df, spec)
        .select(*df.columns, F.inline(F.array(*rows)))
        .where(F.col("part").isNotNull())
    )
