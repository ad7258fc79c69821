import numpy as np
import pytest


from lossgrid.operators import sampling


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(4)
    return np.vstack([rng.normal(0, 1, (150, 3)), rng.normal(20, 0.1, (60, 3)), rng.uniform(-50, 50, (10, 3))])


def test_neighbours_equal_brute_force(spark, cloud, monkeypatch):
    monkeypatch.setattr(sampling, "BLOCK_ROWS", 16)  # several blocks per cell
    df = spark.createDataFrame([(f"p{i:03d}", *map(float, p)) for i, p in enumerate(cloud)], "_id string, a double, b double, c double")
    found = {r["_id"]: [n["id"] for n in r["near"]] for r in sampling.nearest_neighbours(df, ["a", "b", "c"], 5).collect()}
    distance = np.sqrt(((cloud[:, None] - cloud[None]) ** 2).sum(-1))
    np.fill_diagonal(distance, np.inf)
    assert found == {f"p{i:03d}": [f"p{j:03d}" for j in np.argsort(row, kind="stable")[:5]] for i, row in enumerate(distance)}


def test_neighbours_through_many_leaves(spark, cloud, monkeypatch):
    monkeypatch.setattr(sampling, "LEAF_ROWS", 8)
    grid = np.array([[float(i % 12), float(i // 12), 0.0] for i in range(144)])  # ties, a side without length
    for points in (cloud, grid, cloud[:1], np.array([[1.0, 2.0, 3.0]] * 1 + [[1.0, 2.0, 4.0]])):
        df = spark.createDataFrame([(f"p{i:03d}", *map(float, p)) for i, p in enumerate(points)], "_id string, a double, b double, c double")
        found = {r["_id"]: [(n["distance"], n["id"]) for n in r["near"]] for r in sampling.nearest_neighbours(df, ["a", "b", "c"], 5).collect()}
        distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
        np.fill_diagonal(distance, np.inf)
        expected = {f"p{i:03d}": [(row[j], f"p{j:03d}") for j in np.lexsort((np.arange(len(row)), row))[:5] if np.isfinite(row[j])] for i, row in enumerate(distance)}
        assert {k: v for k, v in found.items() if v} == {k: v for k, v in expected.items() if v}


def test_visits_per_point_stay_flat(spark, monkeypatch):
    monkeypatch.setattr(sampling, "LEAF_ROWS", 64)
    each = {}
    for n in (2_000, 32_000):
        points = spark.range(n).selectExpr("cast(id as string) as _id", "rand(1) as a", "rand(2) as b", "randn(3) as c")
        placed, tree = sampling._housed(points, ["a", "b", "c"])
        sizes = placed.groupBy("_cell").count().selectExpr("max(count)", "count(*)").first()
        assert sizes[0] <= 64
        own = placed.select("_id", "a", "b", "c", "_cell")
        first = sampling._merge_nearest(sampling._visit(own, own, sampling._blocks(own, own), ["a", "b", "c"], 5), 5)
        each[n] = sampling._visits(placed, first, ["a", "b", "c"], 5, tree).count() / n, sizes[1]
    assert each[32_000][0] < 1.5 * each[2_000][0]
    assert each[32_000][1] >= 8 * each[2_000][1]


def test_tree_cuts_columns_of_few_values():
    tree = sampling.BoxTree(2)
    tree.split(0, 1, [2.0, 5.0])
    tree.split(2, 0, [1.0])
    x = np.array([[0.0, 1.0], [0.0, 2.0], [1.0, 4.9], [9.0, 5.0]])
    assert tree.place(x).tolist() == [1, 4, 5, 3]


def test_smote_balances_between_neighbours(spark, cloud):
    rows = [(i, 1, *map(float, p)) for i, p in enumerate(cloud)]
    rows += [(1000 + i, 1, 7.0, 7.0, 7.0) for i in range(80)]  # copies
    rows += [(5000 + i, 0, 0.0, 0.0, float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double, c double")
    made = sampling.smote(df, ["a", "b", "c"], "y", 1, ["id"], k=5, seed=3)
    out = made.collect()
    assert len(out) == 1000 - 300 and all(r["y"] == 1 for r in out)
    assert sorted(map(tuple, out)) == sorted(map(tuple, sampling.smote(df.repartition(5), ["a", "b", "c"], "y", 1, ["id"], k=5, seed=3).collect()))
    # every synthetic row lies between a minority row and one of its five nearest minority rows
    points = np.array([r[2:] for r in rows if r[1] == 1])
    distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    others = distance + np.diag(np.full(len(points), np.inf))
    allowed = others <= np.sort(others, axis=1)[:, 4:5]
    for r in out:
        away = np.sqrt(((points - np.array([r["a"], r["b"], r["c"]])) ** 2).sum(1))
        detour = away[:, None] + away[None, :] - distance
        assert detour[allowed].min() < 1e-6
    # copies have five copies as their nearest rows, so they produce copies
    assert sum((r["a"], r["b"], r["c"]) == (7.0, 7.0, 7.0) for r in out) >= 80


def test_too_few_minority_rows_raise(spark):
    df = spark.createDataFrame([(i, int(i < 3), float(i)) for i in range(20)], "id long, y int, a double")
    with pytest.raises(ValueError):
        sampling.smote(df, ["a"], "y", 1, ["id"])
