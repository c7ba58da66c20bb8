"""Feature selection on wide or long feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.operators.features import to_long
from panelwright.operators.profile import correlations
from panelwright.operators.quantiles import column_name, quantiles

MIN_CORRELATION = 0.1
VARIANCE_SHARE = 0.01
MAX_CORRELATION = 0.9


def by_correlation(long: DataFrame, target: str, threshold: float = MIN_CORRELATION) -> DataFrame:
    """(feature, r) with |r| to the target above the threshold; ``long`` has (target, feature, x)."""
    scored = long.groupBy("feature").agg(F.abs(F.corr("x", target)).alias("r"))
    return scored.where(F.col("r") > threshold)


def by_variance(long: DataFrame, share: float = VARIANCE_SHARE) -> DataFrame:
    """(feature, variance) above a share of the largest variance."""
    scored = long.groupBy("feature").agg(F.var_samp("x").alias("variance"))
    largest = F.max("variance").over(Window.partitionBy(F.lit(0)))  # one row per feature
    return scored.withColumn("_max", largest).where(F.col("variance") > F.col("_max") * share).drop("_max")


def mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int = 8) -> DataFrame:
    """(feature, mi): mutual information with the target over quantile bins, in nats.

    A binned estimate; a bin is the number of cut points below the value, so
    equal values always share one.
    """
    columns = [*features, target]
    probs = [i / bins for i in range(1, bins)]
    cuts = quantiles(df, [], columns, probs)
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).withColumn("_one", F.lit(1)).join(
        F.broadcast(cuts.withColumn("_one", F.lit(1))), "_one"
    )

    def binned(c: str):
        x = F.col(c)
        below = sum((x > F.col(column_name(c, i))).cast("int") for i in range(len(probs)))
        return F.when(x.isNotNull(), below).alias(c)

    long = wide.select(*[binned(c) for c in columns]).unpivot([target], list(features), "feature", "xb")
    cells = (
        long.where(F.col("xb").isNotNull() & F.col(target).isNotNull())
        .groupBy("feature", "xb", F.col(target).alias("yb"))
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    over = lambda *c: F.sum("n").over(Window.partitionBy(*c))  # noqa: E731  at most bins * bins rows per feature
    shares = cells.select(
        "feature", "n", over("feature").alias("total"), over("feature", "xb").alias("nx"),
        over("feature", "yb").alias("ny"),
    )
    return shares.groupBy("feature").agg(
        F.sum(F.col("n") / F.col("total") * F.log(F.col("n") * F.col("total") / (F.col("nx") * F.col("ny")))).alias("mi")
    )


def by_mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int = 8) -> DataFrame:
    """Features whose score lies above the median score."""
    scored = mutual_information(df, features, target, bins)
    middle = F.percentile("mi", F.lit(0.5)).over(Window.partitionBy(F.lit(0)))  # one row per feature
    return scored.withColumn("_m", middle).where(F.col("mi") > F.col("_m")).drop("_m")


def prune_collinear(df: DataFrame, features: Sequence[str], threshold: float = MAX_CORRELATION) -> DataFrame:
    """(feature) without those that correlate above the threshold with any earlier one."""
    drop = correlations(df, features).where(F.abs("r") > threshold).select(F.col("b").alias("feature")).distinct()
    names = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return names.join(drop, "feature", "left_anti")


def long_with_target(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    return to_long(df.select(F.col(target).cast("double").alias(target), *features), [target], features)
