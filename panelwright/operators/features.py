"""Rates, lags, rolling statistics, indicators and calendar features."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import windowed as w
from panelwright.operators.layout import Frame, over_series
from panelwright.spec import SeriesSpec

# Default lags, windows and periods of the feature set.
LAGS = (1, 3, 6, 12)
WINDOWS = (3, 6, 12)
TREND_WINDOWS = (6, 12, 24)
ROC_PERIODS = (1, 3, 6, 12)
VOLATILITY_WINDOWS = (3, 6, 12)
CV_WINDOWS = (6, 12)
POSITION_WINDOWS = (6, 12, 24)
DEVIATION_WINDOWS = (6, 12)
MIN_ROWS_FOR_TREND = 2


def _all(values: Iterable[str], make) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for v in values:
        out |= make(v, F.col(v))
    return out


def period_rate(df: DataFrame, spec: SeriesSpec, periods: int = 1, suffix: str | None = None, **layout) -> DataFrame:
    """Percentage change over ``periods`` rows of the series."""
    suffix = suffix or f"rate_{periods}"
    return over_series(
        df, spec, lambda f: _all(spec.values, lambda v, c: {f"{v}_{suffix}": w.pct_change(c, periods, f)}),
        before=periods, **layout,
    )


def inflation_rates(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Period-on-period and year-on-year change; a year follows the frequency."""
    year = spec.periods_per_year

    def build(f: Frame):
        return _all(
            spec.values,
            lambda v, c: {
                f"{v}_monthly_rate": w.pct_change(c, 1, f),
                f"{v}_annual_rate": w.pct_change(c, year, f),
            },
        )

    return over_series(df, spec, build, before=year)


def _lag_columns(spec: SeriesSpec, f: Frame, steps: Sequence[int] = LAGS) -> dict[str, Column]:
    return _all(spec.values, lambda v, c: {f"{v}_lag_{k}": w.lagged(c, k, f) for k in steps})


def lags(df: DataFrame, spec: SeriesSpec, steps: Sequence[int] = LAGS, **layout) -> DataFrame:
    return over_series(df, spec, lambda f: _lag_columns(spec, f, steps), before=max(steps), **layout)


def check_lags(df: DataFrame, spec: SeriesSpec, steps: Sequence[int] = LAGS) -> DataFrame:
    """One row per lag column: how many rows break its definition.

    ``early_values`` counts rows that have no predecessor yet a value,
    ``mismatches`` rows whose lag differs from the value ``k`` positions back.
    """
    checks = [(i, v, k) for i, (v, k) in enumerate((v, k) for v in spec.values for k in steps)]
    laid = over_series(df, spec, lambda f: {f"expected{i}": w.lagged(F.col(v), k, f) for i, v, k in checks}, before=max(steps), pos_as="series_pos")
    pos = F.col("series_pos")
    counts = []
    for i, v, k in checks:
        got = F.col(f"{v}_lag_{k}")
        counts.append(F.count_if((pos <= k) & got.isNotNull()).alias(f"_e{i}"))
        counts.append(F.count_if((pos > k) & ~got.eqNullSafe(F.col(f"expected{i}"))).alias(f"_m{i}"))
    rows = [F.struct(F.lit(f"{v}_lag_{k}").alias("feature"), F.col(f"_e{i}").alias("early_values"), F.col(f"_m{i}").alias("mismatches")) for i, v, k in checks]
    return laid.agg(*counts).select(F.inline(F.array(*rows)))


_ROLLING = {"ma": w.rolling_mean, "std": w.rolling_std, "min": w.rolling_min, "max": w.rolling_max}


def _rolling_columns(
    spec: SeriesSpec, f: Frame, windows: Sequence[int] = WINDOWS, stats: Sequence[str] = tuple(_ROLLING)
) -> dict[str, Column]:
    return _all(
        spec.values, lambda v, c: {f"{v}_{s}_{n}": _ROLLING[s](c, n, f) for n in windows for s in stats}
    )


def lags_and_rolling(df: DataFrame, spec: SeriesSpec, stats: Sequence[str] = tuple(_ROLLING), **layout) -> DataFrame:
    """Both column sets from one layout of the series."""
    return over_series(
        df, spec, lambda f: _lag_columns(spec, f) | _rolling_columns(spec, f, stats=stats),
        before=max(*LAGS, *WINDOWS), **layout,
    )


def rolling(
    df: DataFrame, spec: SeriesSpec, windows: Sequence[int] = WINDOWS, stats: Sequence[str] = tuple(_ROLLING), **layout
) -> DataFrame:
    """Moving statistics; windows at the start of a series hold the rows there are."""
    return over_series(
        df, spec, lambda f: _rolling_columns(spec, f, windows, stats), before=max(windows), **layout
    )


def rolling_full(df: DataFrame, spec: SeriesSpec, window: int = 12, **layout) -> DataFrame:
    """Moving mean and deviation, NULL until the window is full."""

    def build(f: Frame):
        return _all(
            spec.values,
            lambda v, c: {
                f"{v}_mean_{window}": w.full_window(w.rolling_mean(c, window, f), c, window, f),
                f"{v}_sd_{window}": w.full_window(w.rolling_std(c, window, f), c, window, f),
            },
        )

    return over_series(df, spec, build, before=window, **layout)


def trends(df: DataFrame, spec: SeriesSpec, windows: Sequence[int] = TREND_WINDOWS, **layout) -> DataFrame:
    def build(f: Frame):
        return [
            _all(spec.values, lambda v, c: {f"_c_{v}": w.running_count(c, f)}),
            _all(
                spec.values,
                lambda v, c: {f"{v}_trend_{n}": w.trend_slope(c, F.col(f"_c_{v}"), n, f) for n in windows},
            ),
        ]

    return over_series(df, spec, build, before=max(windows), **layout)


def _indicator_stages(spec: SeriesSpec, f: Frame) -> list[dict[str, Column]]:
    """Window columns, each computed once, then slopes and plain projections of them."""
    ma_windows = sorted({*CV_WINDOWS, *DEVIATION_WINDOWS})
    sd_windows = sorted({*VOLATILITY_WINDOWS, *CV_WINDOWS, *DEVIATION_WINDOWS})

    def base(v: str, c: Column) -> dict[str, Column]:
        out = {f"_c_{v}": w.running_count(c, f), f"{v}_acceleration": w.second_difference(c, f)}
        out |= {f"{v}_roc_{k}": w.pct_change(c, k, f) for k in ROC_PERIODS}
        out |= {f"_ma{n}_{v}": w.rolling_mean(c, n, f) for n in ma_windows}
        out |= {f"_sd{n}_{v}": w.rolling_std(c, n, f) for n in sd_windows}
        out |= {f"_lo{n}_{v}": w.rolling_min(c, n, f) for n in POSITION_WINDOWS}
        out |= {f"_hi{n}_{v}": w.rolling_max(c, n, f) for n in POSITION_WINDOWS}
        return out

    def derived(v: str, c: Column) -> dict[str, Column]:
        part = lambda p, n: F.col(f"_{p}{n}_{v}")
        out = {f"{v}_trend_{n}": w.trend_slope(c, F.col(f"_c_{v}"), n, f) for n in TREND_WINDOWS}
        out |= {f"{v}_volatility_{n}": part("sd", n) for n in VOLATILITY_WINDOWS}
        out |= {f"{v}_cv_{n}": F.try_divide(part("sd", n), part("ma", n)) for n in CV_WINDOWS}
        out |= {f"{v}_position_{n}": w.position_in_range(c, part("lo", n), part("hi", n)) for n in POSITION_WINDOWS}
        for n in DEVIATION_WINDOWS:
            out[f"{v}_ma_deviation_{n}"] = c - part("ma", n)
            out[f"{v}_zscore_{n}"] = w.zscore(c, part("ma", n), part("sd", n))
        return out

    return [_all(spec.values, base), _all(spec.values, derived)]


INDICATOR_REACH = max(*TREND_WINDOWS, *ROC_PERIODS)


def indicators(df: DataFrame, spec: SeriesSpec, **layout) -> DataFrame:
    """Trend, momentum, volatility, position and deviation columns of each value, in one sort."""
    return over_series(df, spec, lambda f: _indicator_stages(spec, f), before=INDICATOR_REACH, **layout)


def difference(df: DataFrame, spec: SeriesSpec, order: int = 1, **layout) -> DataFrame:
    """``order``-th difference; the first ``order`` rows of a series have none and go."""

    def one(v: str, source: Column, d: int, f: Frame) -> dict[str, Column]:
        return {f"{'' if d == order else '_'}{v}_diff_{d}": source - w.lagged(source, 1, f)}

    def build(f: Frame):
        first = _all(spec.values, lambda v, c: one(v, c, 1, f))
        later = [
            _all(spec.values, lambda v, c, d=d: one(v, F.col(f"_{v}_diff_{d - 1}"), d, f)) for d in range(2, order + 1)
        ]
        return [first, *later]

    out = over_series(df, spec, build, before=order, pos_as="series_pos", **layout)
    return out.where(F.col("series_pos") > order).drop("series_pos")


# --- calendar -----------------------------------------------------------------

# Months that carry their own flag.
SEASON_MONTHS = {
    "is_january": (1,),
    "is_summer": (7, 8),
    "is_christmas": (12,),
    "is_back_to_school": (9,),
}


def calendar_parts(df: DataFrame, time: str) -> DataFrame:
    t = F.col(time)
    return df.withColumns(
        {"month": F.month(t), "quarter": F.quarter(t), "year": F.year(t), "day_of_year": F.dayofyear(t)}
    )


def cyclical(df: DataFrame, time: str) -> DataFrame:
    month = F.month(time) * (2 * pi / 12)
    quarter = F.quarter(time) * (2 * pi / 4)
    return df.withColumns(
        {
            "month_sin": F.sin(month), "month_cos": F.cos(month),
            "quarter_sin": F.sin(quarter), "quarter_cos": F.cos(quarter),
        }
    )


def one_hot(df: DataFrame, time: str) -> DataFrame:
    """0/1 columns for the twelve months and four quarters."""
    t = F.col(time)
    cols = {f"month_{m}": (F.month(t) == m).cast("int") for m in range(1, 13)}
    cols |= {f"quarter_{q}": (F.quarter(t) == q).cast("int") for q in range(1, 5)}
    return df.withColumns(cols)


def season_flags(df: DataFrame, time: str) -> DataFrame:
    return df.withColumns({n: F.month(time).isin(*ms).cast("int") for n, ms in SEASON_MONTHS.items()})


def seasonal_features(df: DataFrame, time: str) -> DataFrame:
    for op in (calendar_parts, cyclical, one_hot, season_flags):
        df = op(df, time)
    return df


# --- long layout ---------------------------------------------------------------


def to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(ids, feature, x): one row per cell, all values as double."""
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(ids), list(columns), "feature", "x"
    )


def cascade_long(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Features of features: indicators of every base value and of its lags and moving statistics.

    The wide form needs a column per combination (thousands). Here the first
    level is unpivoted and the indicators run once over (keys, feature).
    """
    first = lags_and_rolling(df, spec)
    ids = [*spec.keys, *spec.order]
    columns = [c for c in first.columns if c not in ids]
    long = to_long(first, ids, columns)
    inner = SeriesSpec((*spec.keys, "feature"), spec.time, ("x",), spec.freq, spec.tiebreak)
    return indicators(long, inner)


def feature_matrix(df: DataFrame, spec: SeriesSpec, **layout) -> DataFrame:
    """Lags, moving statistics, indicators and calendar columns of the base values, side by side."""

    def build(f: Frame) -> list[dict[str, Column]]:
        base, derived = _indicator_stages(spec, f)
        return [_lag_columns(spec, f) | _rolling_columns(spec, f) | base, derived]

    reach = max(INDICATOR_REACH, *LAGS, *WINDOWS)
    return over_series(df, spec, build, before=reach, **layout).transform(seasonal_features, spec.time)
