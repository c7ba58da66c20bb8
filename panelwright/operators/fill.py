"""Gaps: interpolation, directional fills, missing periods, running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.operators.layout import BLOCK, CARRY_BLOCK_ROWS, HALO, POS, SLICE_ROWS, Frame, in_blocks, join_on, with_carry
from panelwright.spec import SeriesSpec


def _points(
    df: DataFrame, spec: SeriesSpec, block_rows: int = CARRY_BLOCK_ROWS, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Adds, per value column, the nearest known point before and after each row.

    A point is (position, value). Inside a block two running frames find it;
    the first and last known point of every block are carried over to the
    other blocks of the series, so a gap may span any number of blocks.
    """
    laid = in_blocks(df, spec, block_rows=block_rows, slice_rows=slice_rows).drop(HALO)
    frame = Frame([*spec.keys, BLOCK], [POS])
    point = {
        v: F.when(F.col(v).isNotNull(), F.struct(F.col(POS).alias("p"), F.col(v).alias("v"))) for v in spec.values
    }
    if not spec.bounded:
        laid = with_carry(
            laid,
            spec,
            {f"_first_{v}": F.min(point[v]) for v in spec.values}
            | {f"_last_{v}": F.max(point[v]) for v in spec.values},
            lambda earlier, later: {
                f"_cp_{v}": F.last(f"_last_{v}", True).over(earlier) for v in spec.values
            }
            | {f"_cn_{v}": F.last(f"_first_{v}", True).over(later) for v in spec.values},
        )
    cols = []
    for v in spec.values:
        prev = F.last(point[v], True).over(frame.running())
        nxt = F.last(point[v], True).over(frame.running_back())
        if not spec.bounded:
            prev, nxt = F.coalesce(prev, F.col(f"_cp_{v}")), F.coalesce(nxt, F.col(f"_cn_{v}"))
        cols += [prev.alias(f"_prev_{v}"), nxt.alias(f"_next_{v}")]
    return laid.select("*", *cols)


def _between(v: str) -> Column:
    p, n = F.col(f"_prev_{v}"), F.col(f"_next_{v}")
    share = F.try_divide((F.col(POS) - p["p"]).cast("double"), (n["p"] - p["p"]).cast("double"))
    return F.coalesce(F.col(v).cast("double"), p["v"] + (n["v"] - p["v"]) * share)


def _finish(df: DataFrame, source: DataFrame, filled: dict[str, Column]) -> DataFrame:
    return df.select(*[filled.get(c, F.col(c)).alias(c) for c in source.columns])


def interpolate(df: DataFrame, spec: SeriesSpec, ends: str = "both", **layout) -> DataFrame:
    """Linear by position. ``ends='both'`` extends the nearest value to both ends,
    ``'forward'`` only past the last known value."""
    if ends not in ("both", "forward"):
        raise ValueError(f"unknown ends {ends!r}")
    filled = {}
    for v in spec.values:
        sources = [_between(v), F.col(f"_prev_{v}")["v"]]
        if ends == "both":
            sources.append(F.col(f"_next_{v}")["v"])
        filled[v] = F.coalesce(*sources)
    return _finish(_points(df, spec, **layout), df, filled)


def fill_neighbours(df: DataFrame, spec: SeriesSpec, default=None, **layout) -> DataFrame:
    """Last known value, else the next one, else ``default``."""
    filled = {}
    for v in spec.values:
        sources = [F.col(f"_prev_{v}")["v"], F.col(f"_next_{v}")["v"]]
        if default is not None:
            sources.append(F.lit(default))
        filled[v] = F.coalesce(*sources)
    return _finish(_points(df, spec, **layout), df, filled)


def prepare_matrix(df: DataFrame, spec: SeriesSpec, target: str, **layout) -> DataFrame:
    """Features filled (then 0), target filled, rows that still miss a target dropped."""
    features = spec.with_values(*[v for v in spec.values if v != target])
    out = fill_neighbours(df, features, default=0.0, **layout)
    return fill_neighbours(out, spec.with_values(target), **layout).dropna(subset=[target])


def regularise(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per key and month (quarter, year) between its first and last; gaps get NULLs."""
    keys = list(spec.keys)
    step = F.expr(f"interval {spec.months_per_period} month")
    ends = df.groupBy(*keys).agg(F.min(spec.time).alias("_lo"), F.max(spec.time).alias("_hi"))
    grid = ends.select(
        *[F.col(k).alias(f"_g_{k}") for k in keys], F.explode(F.sequence("_lo", "_hi", step)).alias("_g_t")
    )
    on = [F.col(f"_g_{k}").eqNullSafe(F.col(k)) for k in keys] + [F.col("_g_t") == F.col(spec.time)]
    joined = grid.join(df, on, "left")
    named = {k: F.col(f"_g_{k}") for k in keys} | {spec.time: F.col("_g_t")}
    return joined.select(*[named.get(c, F.col(c)).alias(c) for c in df.columns])


def cumulative(df: DataFrame, spec: SeriesSpec, block_rows: int = CARRY_BLOCK_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Running total of each value as ``{v}_cumsum``; totals of earlier blocks are carried in."""
    laid = in_blocks(df, spec, block_rows=block_rows, slice_rows=slice_rows).drop(HALO)
    if not spec.bounded:
        laid = with_carry(
            laid,
            spec,
            {f"_sum_{v}": F.sum(v) for v in spec.values},
            lambda earlier, later: {f"_base_{v}": F.sum(f"_sum_{v}").over(earlier) for v in spec.values},
        )
    frame = Frame([*spec.keys, BLOCK], [POS])
    cols = []
    for v in spec.values:
        total = F.sum(v).over(frame.running())
        if not spec.bounded:
            total = F.coalesce(F.col(f"_base_{v}") + total, total, F.col(f"_base_{v}"))
        cols.append(total.alias(f"{v}_cumsum"))
    return laid.select(*df.columns, *cols)


def integrate(df: DataFrame, spec: SeriesSpec, levels: DataFrame, **layout) -> DataFrame:
    """Undo a first difference: running total plus the level before the first row.

    ``levels`` holds one row per key with ``{v}_level``.
    """
    keys = list(spec.keys)
    out = join_on(cumulative(df, spec, **layout), levels, keys, "left")
    return out.withColumns(
        {f"{v}_integrated": F.col(f"{v}_level") + F.col(f"{v}_cumsum") for v in spec.values}
    ).drop(*[f"{v}_cumsum" for v in spec.values], *[f"{v}_level" for v in spec.values])
