"""Search over ranges and promotion through rungs: fixed functions, reproducibility, real learners."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossgrid.operators import search

SPACE = {
    "a": ("uniform", -5.0, 5.0), "b": ("loguniform", 1e-4, 1e2), "c": ("int", 0, 20), "d": ("quniform", 0.0, 10.0, 0.5), "e": ("choice", ["x", "y", "z"]),
    "f": ("qint", 0, 100, 5), "g": ("qloguniform", 1.0, 1000.0, 1.0),
}


def bowl(config):
    return (
        (config["a"] - 2) ** 2 + (math.log10(config["b"]) + 1) ** 2 + 0.05 * (config["c"] - 13) ** 2 + 0.2 * (config["d"] - 7.5) ** 2
        + {"x": 2.0, "y": 0.0, "z": 1.0}[config["e"]] + 0.002 * (config["f"] - 40) ** 2 + (math.log10(config["g"]) - 2) ** 2
    )


def random_best(trials, seed):
    ranges = search._ranges(SPACE)
    rng = np.random.default_rng(seed)
    return min(bowl({n: r.value(r.draw(rng)) for n, r in ranges.items()}) for _ in range(trials))


def test_proposals_beat_random_search():
    ours = [search.density_search(bowl, SPACE, 80, seed)[0].scores[0] for seed in range(8)]
    chance = [random_best(80, seed) for seed in range(8)]
    assert np.median(ours) < 0.5 * np.median(chance)
    assert sum(a < b for a, b in zip(ours, chance)) >= 6


def test_reproducible_whatever_the_timing_and_values_keep_to_their_ranges():
    def slow(config):
        time.sleep(0.002 * (int(config["a"] * 1000) % 5))
        return bowl(config)

    one, two = search.density_search(bowl, SPACE, 40, 5), search.density_search(slow, SPACE, 40, 5)
    assert [(t.number, t.config, t.scores) for t in one] == [(t.number, t.config, t.scores) for t in two]
    assert [t.config for t in search.density_search(bowl, SPACE, 40, 6)] != [t.config for t in one]
    for t in one:
        c = t.config
        assert -5 <= c["a"] <= 5 and 1e-4 <= c["b"] <= 100 and c["c"] in range(20) and c["d"] * 2 == int(c["d"] * 2) and c["e"] in "xyz"
        assert isinstance(c["f"], int) and c["f"] % 5 == 0 and 0 <= c["f"] <= 100 and c["g"] == int(c["g"]) and 1 <= c["g"] <= 1000


def test_failed_trials_come_last_and_more_can_be_better():
    found = search.density_search(lambda c: None if c["a"] < 0 else c["a"], {"a": ("uniform", -1.0, 1.0)}, 30, 1, larger=True)
    assert found[0].scores[0] == max(t.scores[0] for t in found if t.scores[0] is not None)
    assert found[-1].scores[0] is None
    for bad in (("uniform", 1, 1), ("loguniform", 0, 1), ("quniform", 0, 1), ("nothing", 0, 1)):
        with pytest.raises(ValueError):
            search.Range(*bad)


def test_densities_integrate_to_one():
    r = search.Range("loguniform", 0.01, 10.0)
    seen = np.array([math.log(v) for v in (0.011, 0.5, 0.52, 9.0)])
    grid = np.linspace(r.low, r.high, 20001)
    assert np.trapezoid(np.exp(r.log_density(grid, seen)), grid) == pytest.approx(1, abs=1e-3)


def test_promotion_keeps_the_best_of_each_rung():
    configs = [{"q": i} for i in range(27)]
    order = np.random.default_rng(3).permutation(27)
    calls = []

    def trial(config, rung):
        calls.append((config["q"], rung))
        return float(order[config["q"]]) + 0.1 / (rung + 1)

    found = search.promote(trial, configs, rungs=4, factor=3)
    assert found[0].config["q"] == int(np.argmin(order)) and len(found[0].scores) == 4
    for rung in range(3):
        below, above = ({t.number for t in found if len(t.scores) > r} for r in (rung, rung + 1))
        assert above <= below and len(above) <= max(1, len(below) // 3) + 3  # a few are sent up before better ones are seen
    best_nine = {int(i) for i in np.argsort(order)[:9]}
    assert best_nine <= {t.number for t in found if len(t.scores) > 1}
    assert len(calls) == len(set(calls)) == sum(len(t.scores) for t in found)
    again = search.promote(trial, configs, rungs=4, factor=3)
    assert [(t.number, t.scores, t.stopped) for t in again] == [(t.number, t.scores, t.stopped) for t in found]


def test_median_rule_stops_the_worse_half():
    found = search.promote(lambda c, rung: c["q"], [{"q": float(i)} for i in (1, 2, 3, 9, 4, 0)], rungs=2, factor=2, parallel=1, median_after=3)
    stopped = {t.config["q"] for t in found if t.stopped == "median"}
    assert stopped == {9.0, 4.0} and found[0].config["q"] == 0.0 and len(found[0].scores) == 2


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (600, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    z = 3 * x[:, 0] + rng.normal(0, 0.1, 600)
    rows = [(i, float(a), float(b), float(c), float(d), i % 3, i % 4 == 0) for i, ((a, b), c, d) in enumerate(zip(x, y, z))]
    return spark.createDataFrame(rows, "id long, a double, b double, y double, z double, fold int, held boolean").repartition(3)


def test_search_over_a_boosted_learner(points):
    space = {"depth": ("int", 1, 4), "rate": ("loguniform", 0.01, 1.0)}
    found = search.search_learner(points, ["a", "b"], "y", "classification", "histogram_boosting", space, 5, "fold", "accuracy", seed=2, parallel=2, start=3, rounds=4, bins=16)
    assert len(found) == 5 and found[0].scores[0] >= found[-1].scores[0] > 0.3
    assert found[0].config["depth"] > 1  # one cut cannot tell the corners apart


def test_rungs_over_tree_and_logistic_learners(points):
    trees = search.halve_learner(points, ["a", "b"], "y", "classification", "random_forest", [{"maxDepth": d} for d in (1, 2, 5)], ["id"], "held", "accuracy", rungs=2, factor=3, numTrees=5, seed=4)
    assert trees[0].config["maxDepth"] > 1 and [len(t.scores) for t in trees] == [2, 1, 1] and trees[0].scores[1] > 0.75
    lines = search.halve_learner(points, ["a"], "y", "classification", "logistic", [{"regParam": r} for r in (0.0, 10.0)], ["id"], "held", "log_loss", rungs=2, factor=2, seed=4)
    assert len(lines[0].scores) == 2 and lines[1].stopped == "rung"


def test_rungs_are_nested_samples(points):
    share = points.select("id", search.row_share(["id"], 7).alias("s"))
    n = [share.where(F.col("s") < 3.0 ** (r - 2)).count() for r in range(3)]
    assert n[2] == 600 and 150 < n[1] < 250 and 40 < n[0] < 100
