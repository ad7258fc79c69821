"""Split windows, bucketed intervals and stored sketches against their plain forms."""

import time
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from lossgrid import session
from lossgrid.operators import intervals, portfolio, split_windows


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    out = [("hot", i, float(rng.normal()) if rng.random() < 0.3 else None) for i in range(900)]
    out += [("gap", i, 1.0 if i == 0 else None) for i in range(200)]  # one value carried over many parts
    out += [(None, i, float(i)) for i in range(7)] + [("none", i, None) for i in range(40)] + [("one", None, 3.0)]
    return spark.createDataFrame(out, "g string, t int, x double").repartition(5)


def sorted_rows(df):
    return sorted(map(tuple, df.select("g", "t", "x", "y").collect()), key=repr)


@pytest.mark.parametrize("parts", [1, 7, 60])
@pytest.mark.parametrize("order", [["t"], ["t desc"]])
def test_fill_sum_and_mean_equal_plain_windows(rows, parts, order):
    plain = Window.partitionBy("g").orderBy(*split_windows._ordered(order))
    so_far = plain.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    expected = sorted_rows(rows.withColumn("y", F.last("x", ignorenulls=True).over(so_far)))
    assert sorted_rows(split_windows.forward_fill(rows, ["g"], order, "x", "y", parts)) == expected
    whole = rows.withColumn("x", F.round(F.col("x") * 1000))
    expected = sorted_rows(whole.withColumn("y", F.sum("x").over(so_far)))
    assert sorted_rows(split_windows.running_sum(whole, ["g"], order, "x", "y", parts)) == expected
    for before, after in ((2, 2), (3, 0), (0, 1)):
        expected = sorted_rows(rows.withColumn("y", F.round(F.avg("x").over(plain.rowsBetween(-before, after)), 9)))
        found = split_windows.rolling(rows, ["g"], order, ["x"], {"y": F.avg("x")}, before, after, parts).withColumn("y", F.round("y", 9))
        assert sorted_rows(found) == expected


def test_fills_and_sums_share_one_written_deal(spark, rows, monkeypatch):
    written = []
    monkeypatch.setattr(split_windows, "materialise", lambda df, f=split_windows.materialise: written.append(f(df)) or written[-1])
    whole = rows.withColumn("x", F.round(F.col("x") * 1000)).withColumn("z", F.when(F.col("t") % 3 == 0, F.concat(F.lit("v"), "t")))
    found = split_windows.along(whole, ["g"], ["t"], {"fill": "z", "x_fill": "x"}, {"y": "x", "n": "t"}, 40)
    assert len(written) == 2 and written[0].count() == rows.count()
    ends = written[1].count()
    assert 0 < ends < 40 and ends == written[1].select("_part").distinct().count()  # one group at most goes on into a part
    assert found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") <= 1
    so_far = Window.partitionBy("g").orderBy(F.asc_nulls_first("t")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = whole.withColumns({"fill": F.last("z", True).over(so_far), "x_fill": F.last("x", True).over(so_far), "y": F.sum("x").over(so_far), "n": F.sum("t").over(so_far)})
    assert found.columns == plain.columns and sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect()))


def test_rows_alike_in_their_order_are_filled_in_one_order(spark):
    df = spark.createDataFrame([("a", i // 20, float(i) if i % 2 else None) for i in range(200)], "g string, t int, x double")
    found = split_windows.along(df, ["g"], ["t"], {"fill": "x"}, {"so_far": "x"}, 6).collect()
    # a row's own value, then the one of the row before it; what goes over a cut is the last value of the part before
    known = sorted((r.so_far, r.x) for r in found if r.x is not None)
    fills = {r.so_far: r.fill for r in found if r.so_far is not None}
    assert len(known) == 100 and all(fills[total] == value for total, value in known)


def test_writing_leaves_no_shuffle_files(spark):
    files = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ").count("shuffle_")
    was, setting = files(), spark.conf.get(session.CLEANUP)
    written = session.materialise(spark.range(20000).withColumn("x", F.rand(1)).repartition(7, "x"))
    for _ in range(50):
        if files() <= was:
            break
        time.sleep(0.2)
    assert files() <= was and written.count() == 20000 and spark.conf.get(session.CLEANUP) == setting


def test_one_segment_with_all_rows_spans_tasks(spark):
    df = spark.range(5000).selectExpr("'s' as g", "cast(id as int) as t", "cast(id % 5 as double) as x")
    dealt = split_windows.dealt(df, ["g"], ["t"], 8).groupBy("_part").count().collect()
    assert len(dealt) >= 6 and max(r["count"] for r in dealt) < 2500
    smoothed = split_windows.rolling(df, ["g"], ["t"], ["x"], {"y": F.avg("x")}, 2, 2, 8)
    assert smoothed.where("t between 2 and 4997 and abs(y - 2) > 1e-9").count() == 0 and smoothed.count() == 5000


def test_no_rows(spark):
    none = spark.createDataFrame([], "g string, t int, x double")
    assert split_windows.forward_fill(none, ["g"], ["t"], "x").count() == 0
    assert split_windows.rolling(none, ["g"], ["t"], ["x"], {"y": F.sum("x")}, 1, 1).count() == 0


@pytest.fixture(scope="module")
def daily(spark):
    rng = np.random.default_rng(3)
    first = date(1995, 1, 1)
    versions = []
    for i in range(400):
        start, length = int(rng.integers(0, 11000)), int(rng.choice([0, 1, 2, 3, 30, 364, 4000, 11000]))
        versions.append((i % 5 if i % 50 else None, i, first + timedelta(start), first + timedelta(start + length)))
    versions += [(1, 900, first, date(9999, 12, 31)), (1, 901, date(2000, 1, 2), date(2000, 1, 1)), (1, 902, None, date(2000, 1, 1)), (2, 903, date(1950, 1, 1), date(1996, 5, 5))]
    points = [(i % 6 if i % 40 else None, i, first + timedelta(int(rng.integers(-40, 11500)))) for i in range(500)] + [(1, 900, None)]
    return (
        spark.createDataFrame(versions, "k int, version int, low date, high date"),
        spark.createDataFrame(points, "k int, point int, day date"),
    )


def test_interval_join_equals_the_plain_one(daily):
    versions, points = daily
    plain = points.join(versions, "k").where("day between low and high")
    found = intervals.interval_join(points, versions, ["k"], "day", "low", "high")
    assert sorted(found.columns) == sorted(plain.columns)
    pairs = sorted((r.point, r.version) for r in found.collect())
    assert pairs == sorted((r.point, r.version) for r in plain.collect()) and len(pairs) > 1000
    for kind, number in (("timestamp", lambda c: f"cast({c} as timestamp)"), ("bigint", lambda c: f"cast(unix_date({c}) as bigint) * 1000 - 400000")):
        a = points.selectExpr("k", "point", f"{number('day')} as day")
        b = versions.selectExpr("k", "version", f"{number('low')} as low", f"{number('high')} as high")
        assert sorted((r.point, r.version) for r in intervals.interval_join(a, b, ["k"], "day", "low", "high").collect()) == pairs
    with pytest.raises(ValueError):
        intervals.interval_join(points, versions.withColumn("low", F.col("low").cast("timestamp")), ["k"], "day", "low", "high")


def test_rows_per_interval_do_not_grow_with_its_length(daily):
    versions, points = daily
    rows = intervals.bucketed(versions.where("version < 901"), "low", "high").groupBy("version").count()
    assert rows.agg(F.max("count"), F.min("count")).first() == (2, 1)
    assert intervals.interval_join(points, versions.limit(0), ["k"], "day", "low", "high").count() == 0
    plan = intervals.interval_join(points, versions, ["k"], "day", "low", "high")._jdf.queryExecution().optimizedPlan().toString()
    assert "_level" in plan and "sequence" not in plan


def test_interval_join_sends_neither_side_through_the_driver(spark, daily, tmp_path):
    versions, points = daily
    for name, df in (("versions", versions), ("points", points)):  # files are small, so their estimates are
        df.write.parquet(str(tmp_path / name))
    versions, points = (spark.read.parquet(str(tmp_path / name)) for name in ("versions", "points"))
    joined = intervals.interval_join(points, versions, ["k"], "day", "low", "high")
    assert joined.count() > 1000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.fixture(scope="module")
def members(spark):
    rng = np.random.default_rng(5)
    months = [date(2024, m, 1) for m in (1, 2, 3)]
    out = []
    for m, month in enumerate(months):
        for i in rng.choice(9000, 5000, replace=False):
            out.append((month, int(i), f"p{i % 3}", f"a{i % 5}" if i % 100 else None, "r" if m < 2 else "_"))
    out += out[:500] + [(months[0], None, "p1", "a1", "r")]
    return spark.createDataFrame(out, f"{portfolio.MONTH} date, member_id long, PolicySubType string, AgeBucket string, UKMemberRegion string")


def test_sketch_cube_stays_within_its_error(spark, members, tmp_path):
    exact = {tuple(r)[:-1]: r.nb_member for r in portfolio.census_cube(members.where("member_id is not null")).collect()}
    path = str(tmp_path / "sketches")
    for month in ("2024-01-01", "2024-02-01", "2024-03-01", "2024-03-01"):  # months are added one by one, one of them twice
        portfolio.census_sketches(members.where(F.col(portfolio.MONTH) == month)).write.mode("append").parquet(path)
    found = {tuple(r)[:-1]: r.nb_member for r in portfolio.sketch_cube(spark.read.parquet(path)).collect()}
    assert {k for k in exact} == {k for k in found}
    errors = np.array([abs(found[k] - exact[k]) / exact[k] for k in exact])
    bound = portfolio.sketch_error()
    assert errors.max() < 4 * bound and (errors <= 2 * bound).mean() > 0.9
    year = portfolio.sketch_cube(spark.read.parquet(path), F.trunc(portfolio.MONTH, "YEAR")).where("dims_kept = 0").first().nb_member
    assert year == pytest.approx(members.select("member_id").distinct().count() - 1, rel=4 * bound)
    rough = portfolio.sketch_cube(portfolio.census_sketches(members, 6)).where("dims_kept = 0").collect()
    assert all(abs(r.nb_member - 5000) < 4 * portfolio.sketch_error(6) * 5000 for r in rough)
