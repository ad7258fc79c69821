"""Histogram boosting against a naive version that looks at every row, missing values, classes, early stopping."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossgrid.operators import boosting


def naive_trees(x, y, rounds, depth, rate, l2):
    """Squared-error boosting by trying every value of every feature with the rows at hand."""
    score, out = np.full(len(y), y.mean()), []
    for _ in range(rounds):
        g, leaves = score - y, [(np.arange(len(y)), 0)]
        value = np.zeros(len(y))
        cuts = []
        while leaves:
            rows, level = leaves.pop(0)
            value[rows] = -g[rows].sum() / (len(rows) + l2)
            if level == 0:
                value[rows] = 0.0
            best = None
            if level < depth:
                whole = g[rows].sum() ** 2 / (len(rows) + l2)
                for f in range(x.shape[1]):
                    for c in np.unique(x[rows, f][~np.isnan(x[rows, f])]):
                        for missing_left in (True, False):
                            goes = np.where(np.isnan(x[rows, f]), missing_left, x[rows, f] <= c)
                            left, right = rows[goes], rows[~goes]
                            if len(left) and len(right):
                                gain = 0.5 * (g[left].sum() ** 2 / (len(left) + l2) + g[right].sum() ** 2 / (len(right) + l2) - whole)
                                if best is None or gain > best[0] + 1e-9:
                                    best = gain, f, c, left, right
            if best and best[0] > 1e-9:
                cuts.append((best[1], best[2]))
                leaves += [(best[3], level + 1), (best[4], level + 1)]
        score = score + rate * value
        out.append(cuts)
    return out, score


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 12, (600, 3)).astype(float)
    x[rng.random((600, 3)) < 0.15] = np.nan
    y = np.where(np.isnan(x[:, 0]), 6.0, np.nan_to_num(x[:, 0])) + 3 * (np.nan_to_num(x[:, 1]) > 7) + rng.normal(0, 0.5, 600)
    return x, y


def frame(spark, x, y, extra=None):
    extra = extra if extra is not None else ["train"] * len(y)
    rows = [(*(None if np.isnan(v) else float(v) for v in row), float(t), s) for row, t, s in zip(x, y, extra)]
    return spark.createDataFrame(rows, "a double, b double, c double, y double, split_name string").repartition(5)


FEATURES = ["a", "b", "c"]


def test_trees_equal_a_naive_exact_version(spark, points, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
    monkeypatch.setattr(boosting, "REFRESH", 2)
    x, y = points
    df = frame(spark, x, y)
    model = boosting.fit_boosted(df, FEATURES, "y", rounds=5, depth=3, bins=200, rate=0.3, l2=1.0)
    cuts, score = naive_trees(x, y, 5, 3, 0.3, 1.0)
    ours = [[(t.feature[n], model.cuts[t.feature[n]][t.cut[n]]) for n in range(len(t.feature)) if t.left[n] >= 0] for (t,) in model.trees]
    assert ours == cuts
    found = {(r.a, r.b, r.c, r.y): r.prediction for r in boosting.predict_boosted(df, model).collect()}
    for row, t, s in zip(x, y, score):
        assert found[(*(None if np.isnan(v) else v for v in row), t)] == pytest.approx(s, abs=1e-9)
    assert [h[0] for h in model.history] == list(range(6))
    assert all(b[1] < a[1] for a, b in zip(model.history, model.history[1:]))


def test_early_stopping_restores_the_best_round(spark):
    rng = np.random.default_rng(9)
    x = rng.integers(0, 40, (400, 3)).astype(float)
    y = 0.05 * x[:, 0] + rng.normal(0, 2, 400)  # little to learn: validation error soon rises
    splits = ["val" if i % 3 == 0 else "test" if i % 3 == 1 and i % 2 else "train" for i in range(400)]
    df = frame(spark, x, y, splits)
    model = boosting.fit_boosted(df, FEATURES, "y", rounds=60, depth=4, bins=40, rate=0.3, split_col="split_name", patience=4)
    judged = [v for _, _, v in model.history]
    assert len(judged) < 60 and judged[-1] > min(judged)  # it rose, and the fit ended
    assert model.best == int(np.argmin(judged)) == len(model.trees) == len(judged) - 1 - 4
    again = boosting.fit_boosted(df.where("split_name <> 'test'"), FEATURES, "y", rounds=max(model.best, 1), depth=4, bins=40, rate=0.3, split_col="split_name")
    assert again.history[-1][2] == pytest.approx(min(judged), rel=1e-6) or model.best == 0
    with pytest.raises(ValueError):
        boosting.fit_boosted(df, FEATURES, "y", patience=3)


@pytest.mark.parametrize("classes", [2, 4])
def test_classes(spark, classes):
    rng = np.random.default_rng(classes)
    x = rng.normal(0, 1, (900, 3))
    label = np.clip(((x[:, 0] + x[:, 1] + 2) / 4 * classes).astype(int), 0, classes - 1)
    x[rng.random((900, 3)) < 0.05] = np.nan
    df = frame(spark, x, label).withColumn("label", F.concat(F.lit("class "), F.col("y").cast("int").cast("string")))
    model = boosting.fit_boosted(df, FEATURES, "label", task="classification", rounds=12, depth=3, rate=0.4)
    assert len(model.classes) == classes and len(model.trees[0]) == (1 if classes == 2 else classes)
    scored = boosting.predict_boosted(df, model)
    assert scored.where("prediction = label").count() > 0.85 * 900
    assert scored.where(f"abs(aggregate(probability, cast(0 as double), (a, b) -> a + b) - 1) > 1e-9 or size(probability) <> {classes}").count() == 0
    losses = [t for _, t, _ in model.history]
    assert losses[-1] < 0.5 * losses[0]


@pytest.mark.parametrize("task,k", [("regression", 1), ("classification", 1), ("classification", 3)])
def test_gradients_equal_finite_differences(task, k):
    rng = np.random.default_rng(1)
    scores = rng.normal(size=(20, k))
    y = rng.normal(size=20) if task == "regression" else rng.integers(0, max(k, 2), 20).astype(float)
    _, g, h = boosting.loss_terms(task, scores.copy(), y)
    for c in range(k):
        step = np.zeros((20, k))
        step[:, c] = 1e-5
        up, gu, _ = boosting.loss_terms(task, scores + step, y)
        down, gd, _ = boosting.loss_terms(task, scores - step, y)
        assert np.allclose(g[:, c], (up - down) / 2e-5, atol=1e-6)
        assert np.allclose(h[:, c], (gu[:, c] - gd[:, c]) / 2e-5, atol=1e-5)


def test_constant_features_and_labels(spark):
    df = frame(spark, np.ones((30, 3)), np.full(30, 5.0))
    model = boosting.fit_boosted(df, FEATURES, "y", rounds=3)
    assert model.trees == [] and boosting.predict_boosted(df, model).where("prediction = 5").count() == 30
    gaps = frame(spark, np.full((40, 3), np.nan), np.arange(40.0))
    assert boosting.predict_boosted(gaps, boosting.fit_boosted(gaps, FEATURES, "y", rounds=3)).where("abs(prediction - 19.5) < 1e-9").count() == 40
