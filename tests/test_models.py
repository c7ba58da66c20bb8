"""Selection, models, intervals, rules."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from panelwright import SeriesSpec
from panelwright.operators import analysis, autoregressive as ar, dataset, scoring, selection, sequence, trees
from panelwright.operators.forecast import ar1_fit, baseline_forecasts, future_calendar
from panelwright.operators.intervals import add_interval
from panelwright.sources import models as store

DAILY = SeriesSpec("k", "t", "value", "day")


def simulated(spark, phi, theta, n=600, keys=6, level=5.0, seed=0):
    rng, parts = np.random.default_rng(seed), []
    for k in range(keys):
        e, y = rng.normal(size=n), np.zeros(n)
        for t in range(1, n):
            y[t] = phi * y[t - 1] + e[t] + theta * e[t - 1]
        parts.append(pd.DataFrame({"k": k, "t": [date(2000, 1, 1) + timedelta(i) for i in range(n)], "value": y + level}))
    return spark.createDataFrame(pd.concat(parts), "k long, t date, value double")


@pytest.fixture(scope="module")
def arma(spark):
    df = simulated(spark, 0.6, 0.4)
    return df, *ar.arima_fit(df, DAILY)


def test_ar1_recovery(spark):
    rows = ar1_fit(simulated(spark, 0.7, 0.0, n=2000), DAILY).collect()
    assert np.mean([r["phi"] for r in rows]) == pytest.approx(0.7, abs=0.03)
    assert np.mean([r["sigma2"] for r in rows]) == pytest.approx(1.0, abs=0.05)


def test_arma_recovery(spark, arma):
    df, _, rows = arma
    got = ar.order_search(rows, DAILY).where("p = 1 AND q = 1").collect()
    assert np.mean([r["ar"][0] for r in got]) == pytest.approx(0.6, abs=0.06)
    assert np.mean([r["ma"][0] for r in got]) == pytest.approx(0.4, abs=0.08)
    assert np.mean([r["sigma2"] for r in got]) == pytest.approx(1.0, abs=0.06)


def test_arima_forecast_and_diagnostics(arma):
    df, models, rows = arma
    assert models.count() == 6 and models.where("d <> 0").count() == 0
    ahead = ar.arima_forecast(models, rows, DAILY, 40)
    assert ahead.where("NOT (lower < prediction AND prediction < upper)").count() == 0
    far = ahead.where("step = 40").agg(F.avg("prediction"), F.avg((F.col("upper") - F.col("lower")) / 2 / 1.96)).first()
    assert far[0] == pytest.approx(5.0, abs=0.4)
    assert far[1] == pytest.approx(np.sqrt((1 + 2 * 0.6 * 0.4 + 0.4**2) / (1 - 0.36)), abs=0.25)
    tests = ar.diagnostics(models, rows, DAILY)
    assert tests.where("autocorrelated").count() <= 1


def test_differencing_and_its_forecast(spark):
    walk = simulated(spark, 1.0, 0.0, n=400, level=100.0, seed=4)
    orders = [r["d"] for r in ar.differencing_order(walk, DAILY).collect()]
    assert sum(d == 1 for d in orders) >= 5
    line = spark.createDataFrame(
        [("a", date(2000, 1, 1) + timedelta(i), 3.0 * i + (1 if i % 7 == 0 else -0.3) * ((i * 37) % 11) / 11) for i in range(300)],
        "k string, t date, value double",
    )
    models, rows = ar.arima_fit(line, DAILY)
    ahead = ar.arima_forecast(models, rows, DAILY, 10).orderBy("step").collect()
    assert ahead[-1]["prediction"] == pytest.approx(3.0 * 309, abs=6)


def test_short_series_have_a_small_model(spark):
    models = ar.arima_fit(simulated(spark, 0.5, 0.0, n=12, keys=2), DAILY)[0].collect()
    assert len(models) == 2 and all(r["p"] <= 1 and r["q"] == 0 and r["n"] <= 12 for r in models)


def test_adf_forms_agree(spark):
    df = simulated(spark, 0.5, 0.0, n=300)
    a = {r["k"]: r["tau"] for r in ar.adf_lag0(df, DAILY).collect()}
    b = {r["k"]: r["tau"] for r in ar.adf(df, DAILY, 0).collect()}
    assert a == pytest.approx(b, rel=1e-6)


def test_unit_root_sweep(spark):
    """Each number of lags gives the single test's value; the criterion sees the second-order term."""
    df = simulated(spark, 0.5, 0.0, n=300, keys=3)
    sweep = ar.unit_root_sweep(df, DAILY, max_lags=3, max_d=1)
    for lags in range(4):
        got = {r["k"]: (r["tau"], r["n"]) for r in sweep.where(F.col("lags") == lags).collect()}
        want = {r["k"]: (r["tau"], r["n"]) for r in ar.adf(df, DAILY, lags).collect()}
        assert {k: n for k, (_, n) in got.items()} == {k: n for k, (_, n) in want.items()}
        assert {k: t for k, (t, _) in got.items()} == pytest.approx({k: t for k, (t, _) in want.items()}, rel=1e-5)
    assert sweep.where("chosen").count() == 3
    rng, y = np.random.default_rng(3), [0.0, 0.0]
    for _ in range(800):
        y.append(y[-1] + 0.6 * (y[-1] - y[-2]) + rng.normal())
    walk = spark.createDataFrame([(1, date(2000, 1, 1) + timedelta(i), v) for i, v in enumerate(y)], "k long, t date, value double")
    chosen = {r["d"]: r for r in ar.unit_root_sweep(walk, DAILY).where("chosen").collect()}
    assert chosen[0]["lags"] >= 1 and chosen[0]["tau"] > -2.9 and chosen[1]["tau"] < -5
    assert ar.differencing_order(walk, DAILY).first()["d"] == 1


def test_unit_root_sweep_on_odd_series(spark):
    """Gaps, a constant, a single row, only NULLs: a result each, and the widest difference where no test is possible."""
    day = lambda i: date(2000, 1, 1) + timedelta(i)
    rng = np.random.default_rng(7)
    rows = [("gaps", day(i), None if i % 11 == 0 else float(rng.normal())) for i in range(200)]
    rows += [("flat", day(i), 2.0) for i in range(50)] + [("one", day(0), 1.0)] + [("none", day(i), None) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, t date, value double")
    assert {r["k"]: r["d"] for r in ar.differencing_order(df, DAILY).collect()} == {"gaps": 0, "flat": 2, "one": 2, "none": 2}
    assert ar.differencing_order(df.where("false"), DAILY).count() == 0


def test_kpss(spark):
    """Against the formula; tiny blocks change nothing; a walk is not stationary, noise is."""
    noise, walk = simulated(spark, 0.3, 0.0, n=300, keys=3), simulated(spark, 1.0, 0.0, n=300, keys=3, seed=2)

    def plain(y):
        r, n = y - y.mean(), len(y)
        lags = min(int(12 * (n / 100) ** 0.25), ar.MAX_KPSS_LAGS)
        spread = (r @ r + 2 * sum((1 - k / (lags + 1)) * (r[k:] @ r[:-k]) for k in range(1, lags + 1))) / n
        return (np.cumsum(r) ** 2).sum() / n**2 / spread

    ticks = SeriesSpec("k", "t", "value", None)
    for df, stationary in ((noise, True), (walk, False)):
        want = {k: plain(own.sort_values("t")["value"].to_numpy()) for k, own in df.toPandas().groupby("k")}
        for spec, layout in ((DAILY, {}), (ticks, {}), (ticks, {"block_rows": 40, "slice_rows": 100})):
            got = {r["k"]: r for r in ar.kpss(df, spec, **layout).collect()}
            assert {k: r["statistic"] for k, r in got.items()} == pytest.approx(want)
        assert sum(r["stationary"] == stationary for r in got.values()) >= 2
    flat = spark.createDataFrame([("a", date(2000, 1, 1), 1.0), ("a", date(2000, 1, 2), 1.0), ("b", date(2000, 1, 1), None)], "k string, t date, value double")
    assert [(r["k"], r["statistic"], r["stationary"]) for r in ar.kpss(flat, DAILY).collect()] == [("a", None, True)]


def test_bootstrap_scores(spark):
    """Reruns and other partitions agree; intervals hold the truth about as often as they say."""
    from panelwright.operators.intervals import bootstrap_scores

    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"k": np.repeat(np.arange(200), 60), "i": np.tile(np.arange(60), 200), "error": rng.normal(size=12000)})
    df = spark.createDataFrame(pdf)
    found = {(r["k"], r["metric"]): r for r in bootstrap_scores(df, ["k"], ["i"], "error").collect()}
    again = {(r["k"], r["metric"]): r for r in bootstrap_scores(df.repartition(7), ["k"], ["i"], "error").collect()}
    assert len(found) == 600
    for key, r in found.items():
        assert (again[key]["lower"], again[key]["upper"]) == pytest.approx((r["lower"], r["upper"]))
    for metric, truth in (("bias", 0.0), ("mae", np.sqrt(2 / np.pi)), ("rmse", 1.0)):
        assert 0.85 < np.mean([found[k, metric]["lower"] <= truth <= found[k, metric]["upper"] for k in range(200)]) < 0.99
    own = pdf.groupby("k")["error"]
    assert {k: found[k, "rmse"]["value"] for k in range(200)} == pytest.approx(np.sqrt(own.apply(lambda e: (e**2).mean())).to_dict())
    whole = bootstrap_scores(df.withColumn("error", F.when(F.col("i") > 0, F.col("error"))), [], ["k", "i"], "error", replicates=60).collect()
    assert len(whole) == 3 and all(r["lower"] < r["value"] < r["upper"] for r in whole)


def test_unstable_polynomials_are_refused():
    assert ar._stable(np.array([[0.5, 0.2], [1.2, 0.1]])).tolist() == [True, False]


def test_chi2_tail(spark):
    row = spark.range(1).select(ar.chi2_tail(F.lit(18.307), 10)).first()
    assert row[0] == pytest.approx(0.05, abs=1e-5)


def test_future_starts_on_the_next_month(spark):
    df = spark.createDataFrame([("a", date(2024, 12, 31), 1.0)], "k string, t date, value double")
    days = [r["t"] for r in future_calendar(df, SeriesSpec("k", "t", "value", "month"), 2).orderBy("step").collect()]
    assert days == [date(2025, 1, 1), date(2025, 2, 1)]


def test_folds_grow(spark):
    df = simulated(spark, 0.1, 0.0, n=17, keys=1)
    folds = dataset.expanding_folds(df, DAILY, 5).groupBy("fold").pivot("part").count().orderBy("fold").collect()
    assert [(r["train"], r["test"]) for r in folds] == [(7, 2), (9, 2), (11, 2), (13, 2), (15, 2)]


def test_selection(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=2000)
    pdf = pd.DataFrame({"y": x + rng.normal(size=2000) * 0.1, "a": x, "b": x * 2 + 1, "c": rng.normal(size=2000) * 0.01})
    df = spark.createDataFrame(pdf)
    long = selection.long_with_target(df, ["a", "b", "c"], "y")
    names = lambda d: {r["feature"] for r in d.collect()}
    assert names(selection.by_correlation(long, "y")) == {"a", "b"}
    assert names(selection.by_variance(long)) == {"a", "b"}
    assert names(selection.prune_collinear(df, ["a", "b", "c"])) == {"a", "c"}
    mi = {r["feature"]: r["mi"] for r in selection.mutual_information(df, ["a", "c"], "y").collect()}
    assert mi["a"] > 1 and mi["c"] < 0.05


def test_forests_grow(spark):
    """Sets that differ in the number of trees share their trees; the first size is the forest fitted alone."""
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.random(300), "b": rng.random(300)}).assign(value=lambda d: 10 * d.a + d.b)
    pdf["k"], pdf["t"] = 1, [date(2000, 1, 1) + timedelta(i) for i in range(300)]
    df = spark.createDataFrame(pdf)
    grid = trees.parameter_grid(numTrees=(4, 8), maxDepth=(2, 5))
    assert [(r["maxDepth"], n) for r, n in trees.growing_forests(grid)] == [(2, [4, 8]), (5, [4, 8])]
    train, test = df.where("a < 0.7"), df.where("a >= 0.7")
    errors = trees.prefix_errors(train, test, ["a", "b"], "value", [4, 8], maxDepth=5)
    alone = trees.fit_forest(train, ["a", "b"], "value", numTrees=4, maxDepth=5).transform(test)
    more = trees.fit_forest(train, ["a", "b"], "value", numTrees=4, maxDepth=5, seed=43).transform(test.drop("features"))
    assert errors[0] == pytest.approx(alone.agg(F.avg(F.abs(F.col("prediction") - F.col("value")))).first()[0])
    both = alone.select("t", "value", "prediction").join(more.select("t", F.col("prediction").alias("_p")), "t")
    assert errors[1] == pytest.approx(both.agg(F.avg(F.abs((F.col("prediction") + F.col("_p")) / 2 - F.col("value")))).first()[0])
    model, params, table = trees.tune(df, DAILY, ["a", "b"], "value", grid, 3)
    assert table.count() == 4 and table.where("cv_folds <> 3").count() == 0
    assert model.stages[-1].getNumTrees == params["numTrees"] and params in grid


def test_recursive_forest(spark):
    """Each step reads the predictions before it."""
    monthly, day = SeriesSpec("k", "t", "value", "month"), lambda i: date(2000 + i // 12, i % 12 + 1, 1)
    df = spark.createDataFrame([(k, day(i), float(10 * k + (i % 4))) for k in (1, 2) for i in range(60)], "k long, t date, value double")
    df = df.unionByName(spark.createDataFrame([(9, day(0), 1.0)], df.schema))
    from panelwright.operators import features as fe

    names = [f"value_lag_{k}" for k in (1, 2, 4)] + ["odd"]
    parts = lambda d, t: d.withColumn("odd", (F.month(t) % 2).cast("double"))
    model = trees.fit_forest(parts(fe.lags(df, monthly, (1, 2, 4)), "t").dropna(), names, "value", numTrees=20, maxDepth=6)
    calendar = future_calendar(df, monthly, 6)
    got = {(r["k"], r["step"]): r for r in trees.recursive_forecast(model, df, calendar, monthly, (1, 2, 4), parts, horizon=6).collect()}
    assert set(got) == {(k, s) for k in (1, 2) for s in range(1, 7)}
    for k in (1, 2):
        values = [float(10 * k + (i % 4)) for i in range(60)]
        for s in range(1, 7):
            t = got[k, s]["t"]
            row = spark.createDataFrame([(*[values[-j] for j in (1, 2, 4)], float(t.month % 2))], ", ".join(f"{n} double" for n in names))
            assert t == day(59 + s) and model.transform(row).first()["prediction"] == got[k, s]["prediction"]
            values.append(got[k, s]["prediction"])


def test_correlations_keep_their_digits(spark):
    """Keys around 0, 1e7 and 1e9, short keys, NULLs, constants; few and many columns."""
    from panelwright.operators import profile

    rng = np.random.default_rng(2)
    parts = []
    for k, offset in (("a", 0.0), ("b", 1e7), ("c", 1e9), (None, -1e9)):
        x = rng.normal(size=1000)
        pdf = pd.DataFrame({"x": x, "y": 0.8 * x + 0.6 * rng.normal(size=1000), "z": rng.normal(size=1000), "flat": np.zeros(1000)}) + offset
        pdf.loc[::3, "z"] = np.nan
        parts.append(pdf.assign(k=k))
    parts.append(pd.DataFrame({"x": [1.0, 2.0], "y": [3.0, 1.0], "z": [np.nan, 1.0], "flat": [1.0, 1.0], "k": "short"}))
    pdf = pd.concat(parts)
    df = spark.createDataFrame(pdf[["k", "x", "y", "z", "flat"]], "k string, x double, y double, z double, flat double").repartition(5)
    want = {}
    for k, own in pdf.groupby("k", dropna=False):
        for i, a in enumerate(["x", "y", "z", "flat"]):
            for b in ["x", "y", "z", "flat"][i + 1 :]:
                both = own[[a, b]].dropna()
                u, v = (both[c] - both[c].mean() for c in (a, b))
                s = np.sqrt((u * u).sum() * (v * v).sum())
                want[None if k != k else k, a, b] = None if s == 0 or len(both) < 2 else float((u * v).sum() / s)
    for narrow in (4, 1):
        profile.NARROW_COLUMNS, before = narrow, profile.NARROW_COLUMNS
        try:
            got = {(r["k"], r["a"], r["b"]): r["r"] for r in profile.correlations(df, ["x", "y", "z", "flat"], ["k"]).collect()}
            whole = {(r["a"], r["b"]): r["r"] for r in profile.correlations(df.where("k = 'c'"), ["x", "y", "z", "flat"]).collect()}
        finally:
            profile.NARROW_COLUMNS = before
        assert set(got) == set(want)
        for key, r in want.items():
            assert got[key] is None if r is None else got[key] == pytest.approx(r, abs=1e-9), key
        assert whole["x", "y"] == pytest.approx(want["c", "x", "y"], abs=1e-9)


@pytest.mark.parametrize(("accuracy", "candidates"), [(10_000, 20_000), (100, 20_000), (100, 30), (50, 3)])
def test_quantiles(spark, accuracy, candidates):
    """Ties, NULLs, few values, heavy tails; also where ranges are cut again and again."""
    from panelwright.operators.quantiles import column_name, quantiles

    rng = np.random.default_rng(9)
    pdf = pd.concat([
        pd.DataFrame({"k": "tails", "x": np.exp(rng.normal(size=4000) * 8), "y": rng.integers(0, 3, 4000).astype(float)}),
        pd.DataFrame({"k": "ties", "x": np.repeat(rng.normal(size=50), 60), "y": np.where(rng.random(3000) < 0.5, np.nan, rng.normal(size=3000))}),
        pd.DataFrame({"k": None, "x": [1.0, 2.0, 5.0], "y": [np.nan] * 3}),
    ])
    df = spark.createDataFrame(pdf, "k string, x double, y double").replace(float("nan"), None).repartition(6)
    probs = (0.0, 0.25, 0.5, 0.9, 0.999, 1.0)
    got = {r["k"]: r for r in quantiles(df, ["k"], ["x", "y"], probs, accuracy=accuracy, candidates=candidates).collect()}
    for k, own in pdf.groupby("k", dropna=False):
        for c in ("x", "y"):
            known = own[c].dropna()
            for i, q in enumerate(probs):
                value = got[None if k != k else k][column_name(c, i)]
                assert value is None if known.empty else value == pytest.approx(np.quantile(known, q), rel=1e-12), (k, c, q)
    one = quantiles(df, [], ["x"], [0.5], accuracy=accuracy, candidates=candidates).first()
    assert one[0] == pytest.approx(np.quantile(pdf["x"], 0.5), rel=1e-12)
    assert quantiles(df.where("false"), [], ["x"], [0.5]).first()[0] is None and quantiles(df.where("false"), ["k"], ["x"], [0.5]).count() == 0


def test_best_model_ignores_failures_and_breaks_ties_by_name(spark):
    rows = [("a", "z", 1.0, 1.0, 5.0, 3), ("a", "b", 1.0, 2.0, 4.0, 3), ("a", "failed", None, None, None, 0)]
    metrics = spark.createDataFrame(rows, "k string, model string, mae double, rmse double, mape double, n_test int")
    assert scoring.best_model(metrics, ["k"]).first()["model"] == "b"
    per = {r["metric"]: r["model"] for r in scoring.best_per_metric(metrics, ["k"]).collect()}
    assert per == {"mae": "b", "rmse": "z", "mape": "b"}


def test_interval_methods(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, "LSTM"), ("a", 3.0, 2.0, "LSTM")], "k string, prediction double, rmse double, model_type string")
    wide = add_interval(df.withColumns({"lower": F.lit(0.0), "upper": F.lit(9.0)}), ["k"], "auto")
    assert wide.first()["upper"] - wide.first()["prediction"] == pytest.approx(1.959964 * 2, abs=1e-4)
    spread = add_interval(df, ["k"], "bootstrap").first()
    assert spread["upper"] - spread["prediction"] == pytest.approx(1.959964, abs=1e-4)
    with pytest.raises(ValueError):
        add_interval(df, ["k"], "guess")


def test_forest(spark, tmp_path):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.random(400), "b": rng.random(400)}).assign(value=lambda d: 10 * d.a)
    pdf["k"], pdf["t"] = 1, [date(2000, 1, 1) + timedelta(i) for i in range(400)]
    df = spark.createDataFrame(pdf)
    model = trees.fit_forest(df, ["a", "b"], "value", numTrees=12, maxDepth=5)
    assert trees.importances(model)[0][0] == "a" and trees.select_by_forest(df, ["a", "b"], "value", numTrees=5) == ["a"]
    banded = trees.tree_interval(model, trees.score_last(model, df, DAILY, 5))
    assert banded.count() == 5 and banded.where("NOT (lower <= prediction AND prediction <= upper)").count() == 0
    with pytest.raises(ValueError):
        trees.score(model, df.drop("a"))
    store.save_model(model, str(tmp_path), "forest", "RandomForest", spark, {"numTrees": 12})
    again = store.load_model(spark, str(tmp_path), "forest")
    a, b = (m.transform(df).agg(F.sum("prediction")).first()[0] for m in (model, again))
    assert a == b
    with pytest.raises(FileNotFoundError):
        store.load_model(spark, str(tmp_path), "none")


def test_sequence_forecast_paths_agree(spark):
    df = dataset.chrono_split(simulated(spark, 0.8, 0.0, n=120, keys=3), DAILY)
    rows, stats = sequence.training_sequences(df, DAILY, 4)
    model = sequence.fit_sequence_model(rows, DAILY, LinearRegression())
    last = sequence.last_sequences(df, DAILY, stats, 4)
    quick = sequence.recursive_forecast(model, last, stats, DAILY, 3)
    steps = sequence._stepwise_path(model, last, 3)
    slow = {r["k"]: r["_path"][-3:] for r in steps.collect()}
    scale = {r["k"]: (r["mean_value"], r["sd_value"]) for r in stats.collect()}
    for r in quick.collect():
        m, s = scale[r["k"]]
        assert r["prediction"] == pytest.approx(slow[r["k"]][r["step"] - 1] * s + m)


def test_baselines(spark):
    df = spark.createDataFrame([("a", date(2020, m, 1), float(2**m)) for m in range(1, 7)], "k string, t date, value double")
    spec = SeriesSpec("k", "t", "value", "month")
    got = {(r["model"], r["step"]): r["prediction"] for r in baseline_forecasts(future_calendar(df, spec, 2), df, spec).collect()}
    assert got[("random_walk", 2)] == 64 and got[("historic_mean", 1)] == 21 and got[("ar1", 2)] == pytest.approx(256)


def test_rules(spark):
    rows = [("calm", 1.5, 1.5, 1.2, 1.8, "increasing", 0.1, 1.0), ("hot", 2.5, 5.0, 3.0, 6.0, "increasing", 0.6, 3.0),
            ("cold", 0.5, -0.5, -1.0, 0.2, "decreasing", 0.25, 1.0)]
    df = spark.createDataFrame(
        rows, "k string, hist_mean double, pred_mean double, pred_min double, pred_max double, overall_trend string, "
        "step_volatility double, mean_width double",
    )
    for step in (analysis.classify_regimes, analysis.outlook, analysis.policy_implications, analysis.risk_flags,
                 analysis.conclusions, analysis.recommendations):
        df = step(df)
    got = {r["k"]: r for r in df.collect()}
    assert got["calm"]["risk_level"] == "low" and not got["calm"]["regime_change"] and got["calm"]["stability"] == "stable"
    assert got["hot"]["predicted_regime"] == "high" and got["hot"]["risk_level"] == "high"
    assert got["hot"]["structural_risks"] == ["structural_uncertainty", "wide_intervals"]
    assert got["cold"]["outlook"] == "deflation_risk" and "consider_stimulus" in got["cold"]["recommendations"]
