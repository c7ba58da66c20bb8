"""Blocks, halos and carried values give what one window per key gives."""

import re
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from panelwright import SeriesSpec
from panelwright.operators import features as fe
from panelwright.operators import fill, layout, profile, quantiles, selection
from panelwright.operators import seasonal as se

PLAIN = SeriesSpec("k", "t", "value", "day", "id")
OPEN = SeriesSpec("k", "t", "value", None, "id")
SF = "/root/testdata/sf0.001"
SMALL = {"block_rows": 40, "slice_rows": 150}


@pytest.fixture(scope="module")
def table(spark):
    """Three series, one of which holds nine tenths of the rows; bursts, ties in time and NULLs."""
    rng = np.random.default_rng(7)
    n = 2000
    at = np.sort(np.concatenate([rng.integers(0, 50, n // 2), rng.integers(0, 100_000, n - n // 2)]))
    rows = [
        ("hot" if rng.random() < 0.9 else f"k{i % 2}", datetime(2024, 1, 1) + timedelta(seconds=int(at[i])), i,
         None if i % 11 < 3 or i < 30 else float(np.round(rng.normal(100, 9), 2)))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, id long, value double").cache()


def same(a, b):
    left, right = (x.toPandas().sort_values("id").reset_index(drop=True) for x in (a, b))
    pd.testing.assert_frame_equal(left[right.columns], right, rtol=1e-9, check_dtype=False)


@pytest.mark.parametrize(
    "op",
    [
        fe.lags,
        fe.rolling,
        fe.trends,
        fe.indicators,
        fe.rolling_full,
        fe.period_rate,
        lambda d, s, **k: fe.difference(d, s, 2, **k),
        fill.interpolate,
        lambda d, s, **k: fill.interpolate(d, s, ends="forward", **k),
        fill.fill_neighbours,
        fill.cumulative,
        se.decompose,
        lambda d, s, **k: se.sequences(d.where("value IS NOT NULL"), s, 5, **k),
    ],
)
def test_blocks_change_nothing(table, op):
    same(op(table, OPEN, **SMALL), op(table, PLAIN))


def test_tail(table):
    same(se.tail(table, OPEN, 7), se.tail(table, PLAIN, 7))


def test_positions_over_slices(table):
    got = layout.number_rows(table, OPEN, slice_rows=100)
    same(got.select("id", "_pos"), layout.number_rows(table, PLAIN).select("id", "_pos"))


def test_no_task_sees_more_than_a_block_and_its_halo(table):
    sizes = layout.in_blocks(table, OPEN, before=24, after=6, **SMALL).groupBy("k", "_block").count()
    assert sizes.agg(F.max("count")).first()[0] <= 40 + 24 + 6


def test_one_key_and_one_moment_are_spread(spark):
    """A burst in one series is cut by the tiebreak."""
    burst = spark.range(3000).select(F.lit("hot").alias("k"), F.lit(datetime(2024, 1, 1)).alias("t"), F.col("id"), F.col("id").cast("double").alias("value"))
    sliced = layout.in_slices(burst, OPEN, slice_rows=300).groupBy("_slice").count().toPandas()["count"]
    assert len(sliced) >= 8 and sliced.max() <= 900
    got = layout.number_rows(burst, OPEN, slice_rows=300)
    assert got.where("_pos <> id + 1").count() == 0


def test_blocks_are_exchanged_by_default(spark):
    plan = entry.queries()["indicators_shipments"](spark, SF)._jdf.queryExecution().toString()
    assert re.search(r"Exchange hashpartitioning\(l_returnflag#\d+, _block#\d+L", plan)


def test_one_key_alone_gives_the_same(table):
    alone = fe.indicators(table.where("k = 'k1'"), OPEN, **SMALL)
    same(alone, fe.indicators(table, OPEN, **SMALL).where("k = 'k1'"))


def test_bounded_windows_share_one_shuffle(spark, table):
    plan = fe.feature_matrix(table, PLAIN)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


@pytest.mark.parametrize("accuracy", [20, 200, 10_000])
def test_exact_quantiles(spark, accuracy):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(
        {
            "k": np.where(rng.random(5000) < 0.7, "hot", rng.choice(list("abc"), 5000)),
            "x": np.round(rng.lognormal(3, 2, 5000), 1),
            "y": rng.integers(0, 3, 5000).astype(float),
        }
    )
    pdf.loc[pdf.k == "c", "y"] = np.nan
    probs = [0.0, 0.025, 0.25, 0.5, 0.75, 1.0]
    df = spark.createDataFrame(pdf).withColumn("y", F.nanvl("y", F.lit(None).cast("double")))
    for by in ([], ["k"]):
        got = quantiles.quantiles(df, by, ["x", "y"], probs, accuracy=accuracy).toPandas()
        groups = pdf.groupby("k") if by else [("", pdf)]
        for name, part in groups:
            row = got[got["k"] == name].iloc[0] if by else got.iloc[0]
            for c in ("x", "y"):
                want = part[c].dropna().quantile(probs).to_numpy() if part[c].notna().any() else [np.nan] * len(probs)
                have = [row[quantiles.column_name(c, i)] for i in range(len(probs))]
                np.testing.assert_allclose(np.array(have, float), np.array(want, float), rtol=1e-12)


def test_correlations_do_not_depend_on_the_number_of_columns(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(1e6, 3, (400, 1))
    values = np.concatenate([base + rng.normal(0, 1, (400, 30)), np.full((400, 1), np.nan)], axis=1)
    values[rng.random(values.shape) < 0.2] = np.nan
    pdf = pd.DataFrame(values, columns=[f"c{i}" for i in range(31)]).assign(k=np.where(np.arange(400) % 3, "a", None))
    df = spark.createDataFrame(pdf)
    names = list(pdf.columns[:31])
    for columns in (names[:5], names[:30], names):
        got = {(r["a"], r["b"]): r["r"] for r in profile.correlations(df, columns).collect()}
        want = pdf[columns].corr(min_periods=2)
        assert len(got) == len(columns) * (len(columns) - 1) // 2
        assert all((r is None and np.isnan(want[a][b])) or abs(r - want[a][b]) < 1e-9 for (a, b), r in got.items())
    by = {(r["k"], r["a"], r["b"]): r["r"] for r in profile.correlations(df, names[:3], ["k"]).collect()}
    assert len(by) == 6
    assert abs(by[(None, "c0", "c2")] - pdf[pdf.k.isna()][["c0", "c2"]].corr().iloc[0, 1]) < 1e-9
    pruned = [{r["feature"] for r in selection.prune_collinear(df, c, 0.9).collect()} for c in (names[:30], names)]
    assert pruned[1] - {"c30"} == pruned[0]


def test_seasonal_parts_add_up(table):
    df = se.decompose(table, OPEN, **SMALL).where("residual IS NOT NULL")
    assert df.where(F.abs(F.col("trend") + F.col("seasonal") + F.col("residual") - F.col("value")) > 1e-9).count() == 0
    assert df.count() > 0
