"""How the rows of a series are spread over tasks.

A calendar series (``spec.freq`` set), or one declared ``short``, has few rows
per key: its windows are partitioned by the keys and cost one shuffle. Any other series may be one key
with a third of the table, so it is cut into blocks of ``block_rows``
consecutive rows. A block also receives copies of the rows next to it (its
halo), as many as the widest frame needs; the copies are dropped after the
windows ran. No task ever sees more than one block plus its halo of a series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from math import ceil

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelwright.session import cut_lineage
from panelwright.spec import SeriesSpec

POS, BLOCK, HALO, SLICE = "_pos", "_block", "_halo", "_slice"
BLOCK_ROWS = 4096  # blocks with a halo: small next to memory, large next to the halo
CARRY_BLOCK_ROWS = 262_144  # blocks that hand one row on: few blocks, so short carry windows
SLICE_ROWS = 200_000

Stage = dict[str, Column]


class Frame:
    """The window of one series (or one block of it) in its order."""

    def __init__(self, partition: Sequence[str], order: Sequence[str]):
        self._base = Window.partitionBy(*partition)
        self._order = list(order)
        self.ordered: WindowSpec = self._base.orderBy(*self._order)

    def trailing(self, n: int) -> WindowSpec:
        return self.ordered.rowsBetween(-(n - 1), 0)

    def between(self, lo: int, hi: int) -> WindowSpec:
        return self.ordered.rowsBetween(lo, hi)

    def running(self) -> WindowSpec:
        return self.ordered.rowsBetween(Window.unboundedPreceding, 0)

    def running_back(self) -> WindowSpec:
        """From the end backwards; linear, unlike a frame to unboundedFollowing."""
        back = [F.col(c).desc() for c in self._order]
        return self._base.orderBy(*back).rowsBetween(Window.unboundedPreceding, 0)


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches NULL keys; right-hand key columns are dropped.

    Without keys the right side is an aggregate of the whole table: one row.
    """
    if not keys:
        one = F.broadcast(right.withColumn("_one", F.lit(1)))
        return left.withColumn("_one", F.lit(1)).join(one, "_one", how).drop("_one")
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    joined = left.join(renamed, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{k}" for k in keys])


def settled(df: DataFrame, name: str) -> DataFrame:
    """An aggregate written once, to be joined to the rows it came from.

    Spark knows the size of a written table and broadcasts it below its own limit, so that the large side is not
    shuffled; beyond, both sides are plain exchanges, which it splits where a key is frequent. Written also because a
    second evaluation of a sketch may differ from the first.
    """
    return cut_lineage(df, name)


def slice_count(df: DataFrame, slice_rows: int = SLICE_ROWS) -> int:
    """Slices of about ``slice_rows`` rows, and as many as there are shuffle partitions at least."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, ceil(df.select(F.lit(1)).count() / slice_rows))


def with_slices(df: DataFrame, spec: SeriesSpec, slice_rows: int = SLICE_ROWS) -> SeriesSpec:
    """The spec with the number of slices of ``df``, so that operators on derived tables need not count again."""
    if spec.bounded or spec.slices is not None:
        return spec
    return replace(spec, slices=slice_count(df, slice_rows))


def in_slices(df: DataFrame, spec: SeriesSpec, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds ``_slice``: rows dealt out by ranges of (keys, time, tiebreak), at every size.

    Written, so that the slice a row is in does not change. Only rows that agree in all those columns have to be in one.
    """
    slices = with_slices(df, spec, slice_rows).slices
    ranged = df.repartitionByRange(slices, *[F.col(c) for c in (*spec.keys, *spec.order)])
    return cut_lineage(ranged.withColumn(SLICE, F.spark_partition_id()), "slices")


def number_rows(df: DataFrame, spec: SeriesSpec, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds ``_pos``: the 1-based position of each row in its series.

    Rows are ranked inside their slice and shifted by the row counts of the earlier slices of the key.
    """
    keys = list(spec.keys)
    if spec.bounded:
        return df.withColumn(POS, F.row_number().over(Frame(keys, spec.order).ordered).cast("long"))
    sliced = in_slices(df, spec, slice_rows)
    counts = sliced.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys, SLICE, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    ranked = sliced.withColumn("_rank", F.row_number().over(Frame([*keys, SLICE], spec.order).ordered))
    return (
        join_on(ranked, settled(offsets, "offsets"), [*keys, SLICE])
        .withColumn(POS, F.col("_offset") + F.col("_rank"))
        .drop("_offset", "_rank", SLICE)
    )


def in_blocks(
    df: DataFrame,
    spec: SeriesSpec,
    before: int = 0,
    after: int = 0,
    block_rows: int = BLOCK_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Adds ``_pos``, ``_block`` and ``_halo`` and copies each block's halo rows into it."""
    size = max(block_rows, before, after, 1)
    numbered = number_rows(df, spec, slice_rows)
    if spec.bounded:
        return numbered.withColumns({BLOCK: F.lit(0).cast("long"), HALO: F.lit(False)})
    own = F.floor((F.col(POS) - 1) / size).cast("long")
    numbered = numbered.withColumn("_own", own)
    if not before and not after:
        return numbered.withColumnRenamed("_own", BLOCK).withColumn(HALO, F.lit(False))
    inside = F.pmod(F.col(POS) - 1, F.lit(size))
    homes = [F.col("_own")]
    if before:
        homes.append(F.when(inside >= size - before, F.col("_own") + 1))
    if after:
        homes.append(F.when((inside < after) & (F.col("_own") > 0), F.col("_own") - 1))
    return (
        numbered.withColumn(BLOCK, F.explode(F.array_compact(F.array(*homes))))
        .withColumn(HALO, F.col(BLOCK) != F.col("_own"))
        .drop("_own")
    )


def over_series(
    df: DataFrame,
    spec: SeriesSpec,
    build: Callable[[Frame], Stage | list[Stage]],
    before: int = 0,
    after: int = 0,
    block_rows: int = BLOCK_ROWS,
    slice_rows: int = SLICE_ROWS,
    pos_as: str | None = None,
) -> DataFrame:
    """Adds window columns whose frames reach ``before`` rows back and ``after`` ahead.

    ``build`` gets the frame and returns one stage of named columns, or a list
    of stages when a column needs an earlier window column. Columns whose names
    start with ``_`` are dropped at the end. ``pos_as`` keeps the position in
    the series under that name.
    """
    if spec.bounded:
        laid, frame = df, Frame(spec.keys, spec.order)
        if pos_as:
            laid = laid.withColumn(pos_as, F.row_number().over(frame.ordered).cast("long"))
    else:
        laid = in_blocks(df, spec, before, after, block_rows, slice_rows)
        frame = Frame([*spec.keys, BLOCK], [POS])
        if pos_as:
            laid = laid.withColumn(pos_as, F.col(POS))
    stages = build(frame)
    stages = [stages] if isinstance(stages, dict) else stages
    made: list[str] = []
    for stage in stages:
        laid = laid.select("*", *[c.alias(n) for n, c in stage.items()])
        made += list(stage)
    if not spec.bounded:
        laid = laid.where(~F.col(HALO)).drop(POS, BLOCK, HALO)
    return laid.drop(*[n for n in made if n.startswith("_")])


def with_carry(
    df: DataFrame,
    spec: SeriesSpec,
    block_aggs: Stage,
    carry: Callable[[WindowSpec, WindowSpec], Stage],
) -> DataFrame:
    """Joins to every block what the other blocks of its series hand over.

    ``df`` comes from ``in_blocks`` without halo. ``block_aggs`` summarises one
    block; ``carry`` receives the windows over all earlier and all later
    blocks (latest first, so both are running frames) and turns summaries into
    carried values. A series of n rows has n / ``CARRY_BLOCK_ROWS`` summary rows.
    """
    keys = list(spec.keys)
    summary = df.groupBy(*keys, BLOCK).agg(*[c.alias(n) for n, c in block_aggs.items()])
    over = Window.partitionBy(*keys)
    earlier = over.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    later = over.orderBy(F.col(BLOCK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(*keys, BLOCK, *[c.alias(n) for n, c in carry(earlier, later).items()])
    return join_on(df, settled(carried, "carried"), [*keys, BLOCK])
