import numpy as np
import pytest
from pyspark.sql import functions as F

from lossgrid.operators.order_stats import even_knots, exact_percentiles, running_totals, values_at_ranks


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of one group is a single value."""
    rng = np.random.default_rng(3)
    values = np.concatenate([np.full(500, 2.5), rng.normal(0, 10, 700), rng.exponential(3, 300)])
    rows = [(("a" if i % 3 else "b"), float(v)) for i, v in enumerate(values)] + [("a", None)]
    return spark.createDataFrame(rows, "g string, x double").cache(), rows


def test_percentiles_equal_numpy(skewed):
    df, rows = skewed
    found = {r["g"]: r for r in exact_percentiles(df, ["x"], [0.0, 0.01, 0.25, 0.5, 0.99, 1.0], ["g"]).collect()}
    for g in ("a", "b"):
        x = np.array([v for k, v in rows if k == g and v is not None])
        expected = np.percentile(x, [0, 1, 25, 50, 99, 100])
        assert np.allclose([found[g][f"p{i}"] for i in range(6)], expected)
        assert found[g]["n"] == len(x)


def test_running_totals_count_smaller_values(skewed):
    df, rows = skewed
    x = sorted(v for _, v in rows if v is not None)
    for row in running_totals(df, "x", {"n": F.count("*")}).collect():
        assert row["n_before"] == sum(v < row["x"] for v in x)
        assert row["n_all"] == len(x)


def test_running_totals_of_strings(spark):
    words = ["", "a", "aa", "prefix__long_1", "prefix__long_2", "é", "zebra", "zebra"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    found = {r["w"]: r["n_before"] for r in running_totals(df, "w", {"n": F.count("*")}).collect()}
    ordered = sorted(words, key=lambda w: w.encode())
    assert found == {w: ordered.index(w) for w in set(words)}


def test_long_common_prefix_is_spread(spark):
    """Strings that differ late fall into several ranges, and ranks hold across them."""
    df = spark.range(3000).select(F.concat(F.lit("https://www.example.org/"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("w"))
    ranked = running_totals(df, "w", {"n": F.count("*")})
    assert ranked.where("n_before <> int(right(w, 9))").isEmpty()


def test_many_small_groups(spark):
    df = spark.range(20_000).select((F.col("id") % 10_000).alias("g"), (F.col("id") * 1.0).alias("x"))
    found = exact_percentiles(df, ["x"], [0.5], ["g"])
    assert found.where("p0 <> g + 5000").isEmpty() and found.count() == 10_000


def test_values_at_ranks(skewed):
    df, rows = skewed
    x = sorted(v for _, v in rows if v is not None)
    found = {r["rank"]: r["x"] for r in values_at_ranks(df, "x", [0, 400, 401, 1499]).collect()}
    assert found == {r: x[r] for r in (0, 400, 401, 1499)}


@pytest.mark.parametrize("knots", [1, 2, 7, 100])
def test_even_knots_equal_numpy(skewed, knots):
    df, rows = skewed
    x = np.array([v for _, v in rows if v is not None])
    found = {r["knot"]: r["value"] for r in even_knots(df, ["x"], knots).collect()}
    expected = np.percentile(x, np.linspace(0, 100, knots)) if knots > 1 else [x.min()]
    assert np.allclose([found[k] for k in range(knots)], expected)
