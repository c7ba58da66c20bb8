"""Small inputs with results worked out by hand."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from panelwright import SeriesSpec
from panelwright.functions import times
from panelwright.operators import features as fe
from panelwright.operators import fill, quality
from panelwright.operators import seasonal as se

MONTHLY = SeriesSpec((), "t", "value", "month")


def series(spark, values, start=date(2020, 1, 1)):
    months = [(start.year * 12 + start.month - 1 + i) for i in range(len(values))]
    rows = [(date(m // 12, m % 12 + 1, 1), None if v is None else float(v)) for m, v in zip(months, values)]
    return spark.createDataFrame(rows, "t date, value double")


def column(df, name, order="t"):
    return [r[0] for r in df.orderBy(order).select(name).collect()]


def test_rates(spark):
    df = fe.inflation_rates(series(spark, range(100, 113)), MONTHLY)
    assert column(df, "value_monthly_rate")[1] == pytest.approx(1.0)
    annual = column(df, "value_annual_rate")
    assert annual[:12] == [None] * 12 and annual[12] == pytest.approx(12.0)


def test_rate_from_zero_is_null(spark):
    assert column(fe.period_rate(series(spark, [0, 1]), MONTHLY), "value_rate_1") == [None, None]


def test_lags(spark):
    df = fe.lags(series(spark, range(10, 101, 10)), MONTHLY, [1, 2])
    assert column(df, "value_lag_1")[:3] == [None, 10, 20]
    assert column(df, "value_lag_2")[:3] == [None, None, 10]


def test_lags_of_short_and_empty_series(spark):
    df = fe.lags(series(spark, [100, 101]), MONTHLY, [1, 3, 6])
    assert column(df, "value_lag_3") == [None, None] == column(df, "value_lag_6")
    assert column(fe.lags(series(spark, [None] * 4), MONTHLY, [1]), "value_lag_1") == [None] * 4
    assert fe.lags(series(spark, []), MONTHLY).count() == 0


def test_rolling_mean_uses_partial_windows(spark):
    df = fe.rolling(series(spark, range(10, 101, 10)), MONTHLY, [3])
    assert column(df, "value_ma_3")[:4] == [10, 15, 20, 30]
    assert column(df, "value_std_3")[0] is None


def test_rolling_full_window(spark):
    df = fe.rolling_full(series(spark, range(1, 14)), MONTHLY, 12)
    assert column(df, "value_mean_12")[:11] == [None] * 11 and column(df, "value_mean_12")[11] == 6.5


def test_trend_and_indicators(spark):
    df = fe.indicators(series(spark, range(100, 120, 2)), MONTHLY)
    slopes = column(df, "value_trend_6")
    assert slopes[0] is None and slopes[1:] == pytest.approx([2.0] * 9)
    assert all(r > 0 for r in column(df, "value_roc_1")[1:])
    assert column(df, "value_acceleration")[2:] == [0] * 8
    assert column(df, "value_position_6") == [0.5] + [1.0] * 9


def test_constant_series(spark):
    df = fe.indicators(series(spark, [5] * 4), MONTHLY)
    assert column(df, "value_zscore_6") == [None, 0, 0, 0]
    assert column(df, "value_position_6") == [0.5] * 4


def test_calendar(spark):
    rows = [(date(2020, m, 1),) for m in (1, 4, 7, 10)]
    df = fe.seasonal_features(spark.createDataFrame(rows, "t date"), "t")
    assert column(df, "month") == [1, 4, 7, 10] and column(df, "quarter") == [1, 2, 3, 4]
    assert column(df, "is_summer") == [0, 0, 1, 0] and column(df, "month_4") == [0, 1, 0, 0]
    assert column(df, "month_sin")[1] == pytest.approx(0.8660254037844386)


def test_interpolation(spark):
    values = [None, 10, None, None, 40, None]
    assert column(fill.interpolate(series(spark, values), MONTHLY), "value") == [10, 10, 20, 30, 40, 40]
    forward = fill.interpolate(series(spark, values), MONTHLY, ends="forward")
    assert column(forward, "value") == [None, 10, 20, 30, 40, 40]


def test_fill_categories(spark):
    df = series(spark, range(4)).withColumn("c", F.when(F.col("value").isin(1, 3), F.lit("A")))
    assert column(fill.fill_neighbours(df, MONTHLY.with_values("c")), "c") == ["A"] * 4


def test_regularise(spark):
    df = series(spark, [1, 2, 3, 4]).where("month(t) <> 3")
    assert column(fill.regularise(df, MONTHLY), "value") == [1, 2, None, 4]


def test_difference_and_back(spark):
    df = series(spark, [1, 4, 9, 16])
    diffs = fe.difference(df, MONTHLY)
    assert column(diffs, "value_diff_1") == [3, 5, 7]
    assert column(fe.difference(df, MONTHLY, 2), "value_diff_2") == [2, 2]
    start = spark.createDataFrame([(1.0,)], "value_level double")
    again = fill.integrate(diffs.select("t", F.col("value_diff_1").alias("value")), MONTHLY, start)
    assert column(again, "value_integrated") == [4, 9, 16]


def test_planted_outliers(spark):
    values = [100 + 0.1 * i for i in range(48)]
    values[10] = 200
    rows = column(quality.outlier_rows(series(spark, values), MONTHLY), "value")
    assert rows == [200]
    unbounded = SeriesSpec((), "t", "value")
    assert column(quality.outlier_rows(series(spark, values), unbounded), "value") == [200]


def test_duplicates_and_completeness(spark):
    df = series(spark, range(4))
    assert quality.duplicates(df).first()[0] == 0
    assert quality.duplicates(df.union(df.limit(1))).first()[0] == 1
    assert quality.completeness(df).first()[0] == 100


def test_trailing_comparison_of_short_series(spark):
    row = se.trailing_comparison(series(spark, range(18)), MONTHLY).first()
    assert (row["recent_avg"], row["previous_avg"], row["trend_direction"]) == (11.5, 5.5, "increasing")
    assert se.trailing_comparison(series(spark, range(5)), MONTHLY).first()["recent_avg"] is None


def test_epoch_in_the_zone_of_the_source(spark):
    df = spark.createDataFrame([("1009839600000",), ("1009839600",), ("12",), ("2002-01-01",)], "x string")
    got = df.select(times.any_to_ntz(F.col("x"), "Europe/Madrid").cast("string")).collect()
    assert [r[0] for r in got] == ["2002-01-01 00:00:00", "2002-01-01 00:00:00", None, "2002-01-01 00:00:00"]


def test_dates_must_be_iso(spark):
    with pytest.raises(ValueError):
        quality.date_range(series(spark, [1]), "t", "01/02/2020", "2020-03-01")


# Quarterly index, change to the quarter before and to twelve quarters before.
GOLDEN = [
    (145.935, None, None), (150.103, 2.856066056806106, None), (151.719, 1.0765940720705025, None),
    (150.640, -0.7111831741574925, None), (150.082, -0.3704195432819968, None), (149.618, -0.3091643235031527, None),
    (147.134, -1.6602280474274589, None), (142.511, -3.1420337923253605, None), (138.693, -2.679091438555614, None),
    (138.082, -0.44054133950525154, None), (136.845, -0.8958444981967184, None), (136.313, -0.38876100697871063, None),
    (134.626, -1.2375928928275215, -7.749340459793741), (136.790, 1.6074161009017374, -8.869243119724468),
    (133.846, -2.1522041084874544, -11.780330743018341), (133.718, -0.09563229383023897, -11.233404142326076),
]


def test_golden_rates(spark):
    rows = [(date(2007 + i // 4, i % 4 * 3 + 1, 1), v) for i, (v, _, _) in enumerate(GOLDEN)]
    spec = SeriesSpec((), "t", "ipca", "quarter")
    df = spark.createDataFrame(rows, "t date, ipca double")
    both = df.transform(fe.period_rate, spec, 1).transform(fe.period_rate, spec, 12)
    for name, i in (("ipca_rate_1", 1), ("ipca_rate_12", 2)):
        assert column(both, name) == [g[i] if g[i] is None else pytest.approx(g[i], rel=1e-12) for g in GOLDEN]
    yearly = column(fe.inflation_rates(df, spec), "ipca_annual_rate")
    assert yearly[:4] == [None] * 4 and yearly[4] == pytest.approx((150.082 / 145.935 - 1) * 100)
