"""Exact linear-interpolated quantiles, also for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.operators.layout import join_on, settled

ACCURACY = 10_000
CANDIDATES = 20_000  # different values that one window sees at most
PARTS = 64


def column_name(column: str, i: int) -> str:
    return f"q{i}_{column}"


def quantiles(
    df: DataFrame,
    by: Sequence[str],
    columns: Sequence[str],
    probs: Sequence[float],
    bounded: bool = False,
    accuracy: int = ACCURACY,
    candidates: int = CANDIDATES,
) -> DataFrame:
    """One row per group with ``q{i}_{column}`` for the i-th probability.

    ``bounded=True`` says that groups are small (calendar series): the built-in
    ``percentile``, which holds a group's values in memory, is used. Otherwise:

    1. one wide aggregate of mergeable sketches gives each group, column and probability a value range that surely
       encloses the wanted rank (its rank error is below 1/accuracy, the range spans four of these on either side);
    2. one pass over the rows counts the values below each range; another keeps the different values inside with their
       counts, a few ten-thousandths of the group;
    3. while a range holds more than ``candidates`` different values, it is cut at quantiles of these, the counts of the
       parts tell which one holds the rank, and only its values stay;
    4. a running count over at most ``candidates`` values finds the exact neighbours of the rank.
    """
    by, probs = list(by), [float(p) for p in probs]
    if bounded:
        aggs = [F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias(c) for c in columns]
        return df.groupBy(*by).agg(*aggs).select(
            *by, *[F.col(c)[i].alias(column_name(c, i)) for c in columns for i in range(len(probs))]
        )
    rows = df.select(*by, *[F.col(c).cast("double").alias(f"_x{j}") for j, c in enumerate(columns)])
    ranges, inside = _enclosures(rows, by, len(columns), probs, accuracy)
    found = _ranked(*_refined(ranges, inside, by, candidates), by)
    at = lambda j, i: (F.col("_j") == j) & (F.col("_i") == i)
    cells = [F.max(F.when(at(j, i), F.col("q"))).alias(column_name(c, i)) for j, c in enumerate(columns) for i in range(len(probs))]
    out = found.groupBy(*by).agg(*cells)
    return join_on(df.select(*by).distinct(), out, by, "left") if by else out  # groups without any value too


def _enclosures(rows: DataFrame, by: list[str], k: int, probs: list[float], accuracy: int) -> tuple[DataFrame, DataFrame]:
    """((by, _j, _i, below, rank, share) of every column and probability, (by, _j, _i, x, c): the values in its range)."""
    margin, ids = 4.0 / accuracy, range(len(probs))
    ends = [p for pair in ((max(p - margin, 0.0), min(p + margin, 1.0)) for p in probs) for p in pair]
    aggs = []
    for j in range(k):
        x = F.col(f"_x{j}")
        aggs += [F.count(x).alias(f"_n{j}"), F.min(x).alias(f"_min{j}"), F.max(x).alias(f"_max{j}"), F.percentile_approx(x, ends, accuracy).alias(f"_ends{j}")]
    sketch = rows.groupBy(*by).agg(*aggs)
    # Groups of up to ``accuracy`` values are ranked whole.
    whole = lambda j: F.col(f"_n{j}") <= accuracy
    low = lambda j, i: F.when(whole(j) if probs[i] > margin else F.lit(True), F.col(f"_min{j}")).otherwise(F.col(f"_ends{j}")[2 * i])
    high = lambda j, i: F.when(whole(j) if probs[i] + margin < 1 else F.lit(True), F.col(f"_max{j}")).otherwise(F.col(f"_ends{j}")[2 * i + 1])
    cells = [(j, i) for j in range(k) for i in ids]
    ranges = sketch.select(*by, *[f"_n{j}" for j in range(k)], *[c.alias(f"{n}{j}_{i}") for j, i in cells for n, c in (("_lo", low(j, i)), ("_hi", high(j, i)))])
    ranges = settled(ranges, "ranges")
    placed = join_on(rows, ranges, by)
    x = lambda j: F.col(f"_x{j}")
    below = placed.groupBy(*by).agg(*[F.count_if(x(j) < F.col(f"_lo{j}_{i}")).alias(f"_b{j}_{i}") for j, i in cells])
    held = [F.when(x(j).between(F.col(f"_lo{j}_{i}"), F.col(f"_hi{j}_{i}")), F.struct(F.lit(j).alias("_j"), F.lit(i).alias("_i"), x(j).alias("x"))) for j, i in cells]
    inside = placed.select(*by, F.explode(F.array_compact(F.array(*held))).alias("_v")).groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("c"))

    def wanted(j, i):
        at = (F.col(f"_n{j}") - 1) * F.lit(probs[i])
        values = {"_j": F.lit(j), "_i": F.lit(i), "below": F.col(f"_b{j}_{i}"), "rank": F.floor(at).cast("long"), "share": at - F.floor(at)}
        return F.when(F.col(f"_n{j}") > 0, F.struct(*[c.alias(n) for n, c in values.items()]))

    known = join_on(ranges, below, by)
    known = known.select(*by, F.inline(F.array_compact(F.array(*[wanted(j, i) for j, i in cells]))))
    return known, inside.select(*by, "_v.*", "c")


def _refined(ranges: DataFrame, inside: DataFrame, by: list[str], candidates: int) -> tuple[DataFrame, DataFrame]:
    """Both tables, cut until no range holds more than ``candidates`` different values."""
    keys = [*by, "_j", "_i"]
    inside = settled(inside, "candidates")
    while True:
        sizes = inside.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"), F.percentile_approx("x", [i / PARTS for i in range(1, PARTS)], 100 * PARTS).alias("_cuts"))
        large = settled(sizes.where(F.col("_m") > candidates).drop("_m"), "large-ranges")
        if large.isEmpty():
            return ranges, inside
        # Part i has the values above cut i - 1 and up to cut i.
        cut = join_on(inside, large, keys, "left")
        part = F.when(F.col("_cuts").isNull(), -1).otherwise(F.size(F.filter("_cuts", lambda c: c < F.col("x"))))
        cut = settled(cut.select(*keys, "x", "c", part.alias("_part")), "range-parts")
        counts = cut.where("_part >= 0").groupBy(*keys, "_part").agg(F.sum("c").alias("_c"), F.min("x").alias("_first"))
        upto = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
        counts = join_on(counts.withColumn("_to", F.sum("_c").over(upto)), ranges, keys)
        # The part that holds the rank, and with the neighbour above it at the end of a part, the first value of the next one.
        start, end = F.col("below") + F.col("_to") - F.col("_c"), F.col("below") + F.col("_to")
        has = (start <= F.col("rank")) & (F.col("rank") < end)
        nexts = F.lead("_first").over(Window.partitionBy(*keys).orderBy("_part"))
        chosen = counts.select(*keys, "_part", (start).alias("_below"), has.alias("_has"), nexts.alias("_next")).where("_has").drop("_has")
        chosen = settled(chosen, "range-chosen")
        both = join_on(cut, chosen.withColumnRenamed("_part", "_own"), keys, "left")
        stays = F.col("_own").isNull() | (F.col("_part") == F.col("_own")) | F.coalesce(F.col("x") == F.col("_next"), F.lit(False))
        inside = settled(both.where(stays).select(*keys, "x", "c"), "candidates")
        moved = join_on(ranges, chosen.select(*keys, "_below"), keys, "left")
        ranges = settled(moved.withColumn("below", F.coalesce("_below", "below")).drop("_below"), "ranges")


def _ranked(ranges: DataFrame, inside: DataFrame, by: list[str]) -> DataFrame:
    """(by, _j, _i, q) from the values in each range."""
    keys = [*by, "_j", "_i"]
    upto = Window.partitionBy(*keys).orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = join_on(inside, ranges, keys).withColumn("_upto", F.col("below") + F.sum("c").over(upto))
    found = ranked.groupBy(*keys).agg(
        F.max("share").alias("_share"),
        F.max(F.col("below") > F.col("rank")).alias("_missed"),
        F.min(F.when(F.col("_upto") > F.col("rank"), F.col("x"))).alias("_a"),
        F.min(F.when(F.col("_upto") > F.col("rank") + 1, F.col("x"))).alias("_b"),
    )
    a, b, share = F.col("_a"), F.col("_b"), F.col("_share")
    exact = F.when(share == 0, a).otherwise(a + (b - a) * share)
    sound = ~F.col("_missed") & a.isNotNull() & ((share == 0) | b.isNotNull())
    return found.select(*keys, F.when(sound, exact).otherwise(F.raise_error(F.lit("quantile range missed its rank"))).alias("q"))


def aggregate_with_quantiles(
    df: DataFrame, by: Sequence[str], aggs: Sequence[Column], column: str, probs: Sequence[float], bounded: bool
) -> DataFrame:
    """Aggregates and quantiles of one column side by side; one aggregation where groups are bounded."""
    by = list(by)
    if not bounded:
        return join_on(df.groupBy(*by).agg(*aggs), quantiles(df, by, [column], probs), by)
    cells = [F.percentile(column, F.lit(float(p))).alias(column_name(column, i)) for i, p in enumerate(probs)]
    return df.groupBy(*by).agg(*aggs, *cells)
