import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossgrid.functions.calendar import month_shift
from lossgrid.operators import evaluate, forecast, learners, linear, reserving, splits, transforms, tuning


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    x1, x2 = rng.normal(5, 2, 900), rng.normal(-1, 1, 900)
    y = 3 + 2 * x1 - 4 * x2 + rng.normal(0, 0.1, 900)
    data = [(i, "hot" if i % 3 else ("b" if i % 2 else "c"), float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x1, x2, y))]
    return spark.createDataFrame(data, "id long, seg string, x1 double, x2 double, y double").cache()


def _xy(rows, seg=None):
    pdf = rows.toPandas()
    pdf = pdf if seg is None else pdf[pdf.seg == seg]
    return pdf[["x1", "x2"]].to_numpy(), pdf["y"].to_numpy()


def _ridge(x, y, alpha):
    mx, my = x.mean(0), y.mean()
    w = np.linalg.solve((x - mx).T @ (x - mx) + alpha * np.eye(x.shape[1]), (x - mx).T @ (y - my))
    return np.concatenate([[my - mx @ w], w])


@pytest.mark.parametrize("alpha", [0.0, 10.0])
def test_segment_fit_equals_ridge(rows, alpha):
    for r in linear.segment_fit(rows, ["seg"], ["x1", "x2"], "y", alpha).collect():
        assert np.allclose(r["coef"], _ridge(*_xy(rows, r["seg"]), alpha), atol=1e-6)


def test_unseen_segment_raises(rows):
    models = linear.segment_fit(rows.where("seg <> 'c'"), ["seg"], ["x1"], "y")
    with pytest.raises(Exception, match="no model for segment c"):
        linear.segment_predict(rows, models, ["seg"], ["x1"]).collect()


def test_config_keys(spark):
    segs = spark.createDataFrame([("A", "1"), ("B", "1"), ("C", "1")], "s string, t string")
    configs = spark.createDataFrame([("('A', '1')", "tuple"), ("B__1", "joined")], "segment_key string, config string")
    assert {r["s"]: r["config"] for r in linear.segment_config(segs, configs, ["s", "t"], "default").collect()} == {"A": "tuple", "B": "joined", "C": "default"}
    single = spark.createDataFrame([("('A',)", "tuple"), ("B", "scalar")], "segment_key string, config string")
    assert {r["s"]: r["config"] for r in linear.segment_config(segs, single, ["s"], "default").collect()} == {"A": "tuple", "B": "scalar", "C": "default"}


def test_huber_ignores_outliers(rows):
    spoilt = rows.withColumn("y", F.when(F.col("id") % 25 == 0, F.col("y") + 500).otherwise(F.col("y")))
    models = reserving.huber_fit(spoilt, ["x1", "x2"], "y", ["seg"])
    scored = reserving.huber_predict(rows, models, ["x1", "x2"], "y", ["seg"])
    robust = scored.agg(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0]
    plain = linear.segment_predict(rows, linear.segment_fit(spoilt, ["seg"], ["x1", "x2"], "y"), ["seg"], ["x1", "x2"])
    squared = plain.agg(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0]
    assert robust < 1.0 < squared


def test_chain_ladder_by_hand(spark):
    triangle = [(date(2020, m, 1), lag, v) for m, vs in ((1, (100.0, 150.0, 165.0)), (2, (200.0, 300.0)), (3, (0.0,))) for lag, v in enumerate(vs)]
    df = spark.createDataFrame([("s", *r) for r in triangle], "seg string, treatment_date date, lag int, cumulative double")
    factors = reserving.chain_ladder_fit(df, "cumulative", ["seg"])
    found = {r["lag"]: (r["factor"], r["to_ultimate"]) for r in factors.collect()}
    assert found[0] == pytest.approx((1.5, 1.65)) and found[1] == pytest.approx((1.1, 1.1)) and found[2] == (1.0, 1.0)
    new = spark.createDataFrame([("s", 0, 10.0), ("unknown", 0, 10.0), ("s", 1, None)], "seg string, lag int, cumulative double")
    predicted = [r["prediction"] for r in reserving.chain_ladder_predict(new, factors, "cumulative", ["seg"]).orderBy("seg", "lag").collect()]
    assert predicted == [pytest.approx(16.5), None, 10.0]


def test_cross_validation_equals_refitting(rows):
    folded = rows.withColumn("fold", (F.col("id") % 4).cast("int")).cache()
    pdf = folded.toPandas()
    for r in tuning.cross_validate(folded, "fold", ["x1", "x2"], "y", [0.0, 50.0, 5000.0]).collect():
        errors = []
        for f in range(4):
            train, held = pdf[pdf.fold != f], pdf[pdf.fold == f]
            coef = _ridge(train[["x1", "x2"]].to_numpy(), train["y"].to_numpy(), r["alpha"])
            errors.append(math.sqrt(np.mean((held["y"] - coef[0] - held[["x1", "x2"]].to_numpy() @ coef[1:]) ** 2)))
        assert r["rmse"] == pytest.approx(np.mean(errors), rel=1e-5)
        assert r["best"] == (r["alpha"] == 0.0)


def test_halving_keeps_the_best_share(rows):
    folded = rows.withColumn("fold", (F.col("id") % 3).cast("int"))
    alphas = [0.0, 1.0, 10.0, 100.0, 1e3, 1e4, 1e5, 1e6, 1e7]
    found = {r["alpha"]: r["rung"] for r in tuning.successive_halving(folded, ["id"], "fold", ["x1", "x2"], "y", alphas).collect()}
    assert len(found) == 9 and sum(r >= 1 for r in found.values()) == 3 and sum(r == 2 for r in found.values()) == 1
    assert found[1e7] == 0


def test_sampled_space_is_reproducible():
    space = {"a": ("uniform", 0, 1), "b": ("loguniform", 1e-3, 1e3), "c": ("quniform", 0, 10, 2), "d": ("int", 1, 5)}
    one = tuning.sample_space(space, 20, 7)
    assert one == tuning.sample_space(space, 20, 7)
    assert all(c["c"] % 2 == 0 and 1 <= c["d"] < 5 and 1e-3 <= c["b"] <= 1e3 for c in one)


# --- splits -------------------------------------------------------------------------------------------


def test_random_split_is_exact_and_complete(rows):
    split = splits.random_split(rows, ["id"], 3, 0.1, 0.1)
    sizes = {r["split_name"]: r["count"] for r in split.groupBy("split_name").count().collect()}
    assert sizes == {"test": 90, "val": 81, "train": 729}
    assert {r["id"] for r in split.where("split_name = 'test'").collect()} == {r["id"] for r in splits.random_split(rows, ["id"], 3, 0.1).where("split_name = 'test'").collect()}


def test_stratified_split_keeps_the_shares(rows):
    split = splits.random_split(rows, ["id"], 3, 0.2, 0.25, stratify="seg")
    for r in split.groupBy("seg").agg(F.count("*").alias("n"), F.count_if(F.col("split_name") == "test").alias("t"), F.count_if(F.col("split_name") == "val").alias("v")).collect():
        assert r["t"] == math.ceil(r["n"] * 0.2) and r["v"] == math.ceil((r["n"] - r["t"]) * 0.25)


def test_time_split_never_cuts_a_date(spark):
    df = spark.createDataFrame([(date(2020, 1, 1 + i % 10), i) for i in range(95)], "d date, i int")
    named = splits.time_split(df, "d", 0.75, 0.1).select("d", "split_name").distinct().collect()
    found = {r["d"].day: r["split_name"] for r in named}
    assert found == {**{d: "train" for d in range(1, 7)}, 7: "val", **{d: "test" for d in range(8, 11)}}


@pytest.mark.parametrize(
    "wrong",
    [
        {"train_size": 0.5, "test_size": 0.5, "seed": 1}, {"val_size": 0.1, "seed": 1}, {"kind": "time", "date_col": "d", "stratify": True},
        {"kind": "time"}, {"seed": None}, {"kind": "time", "date_col": "d", "cutoff": "2020-01-01", "train_size": 0.5},
    ],
)
def test_contradictory_arguments(wrong):
    with pytest.raises(ValueError):
        splits.check_arguments(**wrong)


def test_seed_zero_is_a_seed():
    splits.check_arguments(seed=0, test_size=0.1)


def test_stratified_folds_share_out_the_classes(spark):
    labels = [0] * 10 + [1] * 7 + [0] * 3 + [2] * 4
    df = spark.createDataFrame(list(enumerate(labels)), "i long, y int")
    counts = {(r["y"], r["fold"]): r["count"] for r in splits.stratified_k_folds(df, "y", "i", 3).groupBy("y", "fold").count().collect()}
    ordered = sorted(labels)
    expected = {}
    for place, label in enumerate(ordered):
        expected[label, place % 3] = expected.get((label, place % 3), 0) + 1
    assert counts == expected


# --- transformers -------------------------------------------------------------------------------------


def test_quantile_transform_follows_the_empirical_distribution(spark):
    values = [float(v) for v in np.random.default_rng(1).exponential(2, 400)] + [1.0] * 100
    df = spark.createDataFrame([(v,) for v in values], "x double")
    out = [r["x"] for r in transforms.fit_quantile(df, ["x"], 50).transform(df).collect()]
    assert min(out) == 0.0 and max(out) == 1.0 and abs(float(np.mean(out)) - 0.5) < 0.05
    order = np.argsort(values)
    assert np.all(np.diff(np.array(out)[order]) >= -1e-12)


def test_zero_spread_scales_by_one(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r["x"] for r in transforms.fit_robust(df, ["x"]).transform(df).collect()] == [0.0, 0.0]


def test_clip_fits_on_finite_values_and_keeps_null(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(float("inf"),), (None,)], "x double")
    out = [r["x"] for r in transforms.fit_clip(df, ["x"]).transform(df).collect()]
    assert out[0] == 1.0 and out[100] == 99.0 and out[101] == 99.0 and out[102] is None


def test_feature_used_twice_is_refused(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    with pytest.raises(ValueError):
        transforms.column_transformer(df, [([transforms.fit_min_max], ["a"]), ([transforms.fit_standard], ["a", "b"])])


# --- scores -------------------------------------------------------------------------------------------


def test_auc_with_ties_equals_pair_counting(spark):
    rng = np.random.default_rng(2)
    rows = [(int(rng.random() < 0.3), float(rng.integers(0, 12))) for _ in range(400)] + [(0, 5.0)] * 300
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    pairs = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert evaluate.roc_auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()[0] == pytest.approx(pairs)


def test_one_label_has_no_false_counts(spark):
    row = evaluate.classification_metrics(spark.createDataFrame([(1, 1), (1, 1)], "y int, p int"), "y", "p").first()
    assert row["false_positives"] == 0 and row["false_negatives"] == 0 and row["accuracy"] == 1.0


def test_gate_reports_all_failures(spark):
    metrics = spark.createDataFrame([("r2", 0.5), ("bad", float("nan"))], "metric_name string, metric_value double")
    rules = spark.createDataFrame([("r2", ">=", 0.9), ("bad", ">", 0.0), ("absent", "<", 1.0), ("r2", "~", 1.0)], "metric_name string, op string, bound double")
    with pytest.raises(ValueError) as error:
        evaluate.metric_gate(metrics, rules)
    assert all(text in str(error.value) for text in ("failed", "not a number", "missing metric", "unknown operator"))
    evaluate.metric_gate(metrics, spark.createDataFrame([("r2", "<=", 1.0)], "metric_name string, op string, bound double"))


def test_sweep_counts_greater_scores(spark):
    rows = [(1, 0.3), (0, 0.3), (1, 0.75), (0, 1.0), (1, 0.0)]
    sweep = {round(r["threshold"], 2): r for r in evaluate.threshold_sweep(spark.createDataFrame(rows, "y int, s double"), "y", "s").collect()}
    assert len(sweep) == 99
    for t, r in sweep.items():
        assert r["false_positives"] == sum(y == 0 and s > t for y, s in rows), t
        assert r["false_negatives"] == sum(y == 1 and s <= t for y, s in rows), t


def test_probability_columns_must_match_the_classes(spark):
    df = spark.createDataFrame([(0.2, 0.8)], "a double, b double")
    with pytest.raises(ValueError):
        evaluate.with_probabilities(df, ["0"], ["a", "b"])
    row = evaluate.with_probabilities(df, ["0", "1"], ["a", "b"]).first()
    assert row["prediction"] == "1" and row["prediction_proba"] == {"0": 0.2, "1": 0.8}


def test_latest_version_is_numeric(spark):
    df = spark.createDataFrame([("m", "9", None), ("m", "10", None), ("n", "3", "champion"), ("n", "4", None)], "model_name string, version string, alias string")
    found = {r["model_name"]: (r["latest"], r["chosen"]) for r in evaluate.chosen_versions(df, "champion").collect()}
    assert found == {"m": (10, 10), "n": (4, 3)}


# --- forecasts ----------------------------------------------------------------------------------------


def _panel(spark):
    rows = []
    for s, base in (("a", 100.0), ("b", 10.0)):
        for i in range(72):
            month = month_shift(date(2015, 1, 1), i)
            rows.append((s, month, base + base * 0.02 * i + base * 0.3 * math.sin(2 * math.pi * month.month / 12) + base * 0.1 * (i % 5), float(i % 5)))
    return spark.createDataFrame(rows, "series string, month date, y double, driver double")


def _rmse(df, value):
    return df.agg(F.sqrt(F.avg((F.col("y") - value) ** 2))).first()[0]


def test_trend_and_season_beat_the_mean(spark):
    panel = _panel(spark)
    config = F.create_map(*[F.lit(x) for x in ("yearly_seasonality", "true", "changepoint_nb_per_year", "1")])
    configs = panel.select("series").distinct().withColumn("config", config)
    history = panel.where("month < '2020-01-01'")
    models = forecast.trend_seasonal_fit(history, ["series"], "month", "y", {"driver": 10.0}, configs)
    for series in ("a", "b"):
        future = forecast.trend_seasonal_predict(panel.where(f"month >= '2020-01-01' AND series = '{series}'"), models, ["series"], "month", ["driver"])
        mean = history.where(f"series = '{series}'").agg(F.avg("y")).first()[0]
        assert _rmse(future, F.col("prediction")) < 0.3 * _rmse(future, F.lit(mean))


def test_censored_months_do_not_move_the_fit(spark):
    panel = _panel(spark).where("series = 'a'")
    spoilt = panel.withColumn("y", F.when(F.col("month") >= "2020-11-01", 1e6).otherwise(F.col("y")))
    configs = panel.select("series").distinct().withColumn("config", F.create_map(F.lit("changepoint_nb_months_censored"), F.lit("2")))
    row = forecast.trend_seasonal_fit(spoilt, ["series"], "month", "y", configs=configs).first()
    assert row["rows"] == 70 and row["scale"] < 1e4


def test_autoregression_beats_the_mean(spark):
    panel = _panel(spark)
    history = panel.where("month < '2020-10-01'")
    models = forecast.ar_fit(history, "series", "month", "y", lags=12, steps=3, alpha=1e-3)
    ahead = forecast.ar_forecast(history, models, "series", "month", "y", lags=12, steps=3)
    joined = ahead.join(panel, ["series", "month"])
    assert joined.count() == 6
    for series in ("a", "b"):
        part = joined.where(f"series = '{series}'")
        mean = history.where(f"series = '{series}'").agg(F.avg("y")).first()[0]
        assert _rmse(part, F.col("prediction")) < 0.5 * _rmse(part, F.lit(mean))


def test_short_series_and_unknown_series_raise(spark):
    panel = _panel(spark)
    short = panel.where("series = 'a' OR month < '2015-03-01'")
    with pytest.raises(ValueError):
        forecast.ar_fit(short, "series", "month", "y")
    models = forecast.ar_fit(panel.where("series = 'a'"), "series", "month", "y")
    with pytest.raises(ValueError):
        forecast.ar_forecast(panel, models, "series", "month", "y")


# --- learners -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("kind,params", [("ridge", {"regParam": 0.01}), ("random_forest", {"numTrees": 10, "seed": 1}), ("gradient_boosting", {"maxIter": 10, "seed": 1})])
def test_regressors_beat_the_mean(rows, kind, params):
    scored = learners.predict(learners.fit_learner(rows, ["x1", "x2"], "y", "regression", kind, **params), rows)
    assert evaluate.regression_metrics(scored, "y", "prediction").first()["r2"] > 0.7


def test_early_stopping_uses_fewer_trees(rows):
    split = splits.random_split(rows.withColumn("y", F.round(F.col("x1"))), ["id"], 1, 0.1, 0.3)
    model = learners.fit_early_stopping(split, ["x1"], "y", "regression", maxIter=30, maxDepth=4, tolerance=0.05)
    assert model.stages[-1].getNumTrees < 30


def test_tuning_prefers_the_better_setting(rows):
    best = learners.tune_learner(rows, ["x1", "x2"], "y", "regression", "ridge", {"regParam": [0.01, 100.0]})
    assert best.avgMetrics[0] < best.avgMetrics[1]


def test_transformers_read_the_source_per_level_not_per_column(spark, monkeypatch):
    df = spark.createDataFrame([(float(i), float(i % 7), i % 3 if i % 5 else None, "xy"[i % 2], float("nan")) for i in range(200)], "a double, b double, c int, d string, e double")
    calls = []
    monkeypatch.setattr(transforms, "even_knots", lambda d, columns, knots, f=transforms.even_knots: calls.append(columns) or f(d, columns, knots))
    fitted = transforms.fit_quantile(df, ["a", "b", "e"], 50)
    assert calls == [["e"], ["a", "b"]]
    found = fitted.transform(df).agg(F.max("a"), F.min("b"), F.count("e")).first()
    assert found[0] == 1.0 and 0 <= found[1] < 0.13  # equal values share a rank
    assert transforms.most_frequent_values(df, ["a", "c", "d", "e"]) == {"a": 0.0, "c": 0, "d": "x", "e": None}

    def counting(fit):
        return lambda d, columns: calls.append((fit.__name__, columns)) or fit(d, columns)

    clip, standard, span = counting(transforms.fit_clip), counting(transforms.fit_standard), counting(transforms.fit_min_max)
    calls.clear()
    out, steps = transforms.column_transformer(df, [([clip, standard], ["a"]), ([clip, span], ["b"]), ([standard], ["c"])], ["d"])
    assert calls == [("fit_clip", ["a", "b"]), ("fit_standard", ["c"]), ("fit_standard", ["a"]), ("fit_min_max", ["b"])]
    alone = transforms.column_transformer(df.select("a"), [([transforms.fit_clip, transforms.fit_standard], ["a"])])[0]
    assert sorted(r[0] for r in out.select("a").collect()) == sorted(r[0] for r in alone.collect())
    assert len(steps) == 5 and out.columns == ["a", "b", "c", "e"]


def test_one_hot_refuses_too_many_categories(spark, monkeypatch):
    monkeypatch.setattr(transforms, "MAX_CATEGORIES", 5)
    df = spark.range(6).selectExpr("cast(id as string) as k")
    with pytest.raises(ValueError, match="one_hot_vector"):
        transforms.one_hot(df, "k")
    assert len(transforms.one_hot(df.where("k < '5'"), "k").columns) == 6
