from datetime import date, datetime, timedelta
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossgrid.operators import portfolio
from lossgrid.sources import staging
from lossgrid.workload.portfolio import QUERIES, inflation_run

M1, M2 = date(2020, 1, 1), date(2020, 2, 1)


@pytest.fixture(scope="module")
def members(spark):
    rows = [(M1, i, "A" if i % 2 else "B", "0_20", "N" if i % 3 else "S") for i in range(30)]
    rows += [(M1, 1, "B", "21_35", "N")]  # one member in two combinations
    rows += [(M2, i, "A", "0_20", "N") for i in range(5)]
    return spark.createDataFrame(rows, "year_month_date date, member_id int, PolicySubType string, AgeBucket string, UKMemberRegion string")


def test_cube_counts_members_once_per_subset(spark, members):
    found = {(r["year_month_date"], r["PolicySubType"], r["AgeBucket"], r["UKMemberRegion"]): r["nb_member"] for r in portfolio.census_cube(members).collect()}
    rows = members.collect()
    expected = {}
    for keep in product([True, False], repeat=3):
        for r in rows:
            key = (r["year_month_date"], *[v if k else "_" for k, v in zip(keep, r[2:])])
            expected.setdefault(key, set()).add(r["member_id"])
    assert found == {k: len(v) for k, v in expected.items()}
    assert found[M1, "_", "_", "_"] == 30


def test_all_combinations_is_the_full_product(spark):
    left = spark.range(7).withColumnRenamed("id", "a")
    right = spark.range(5).withColumnRenamed("id", "b")
    pairs = portfolio.all_combinations(left, right, rows=2)
    assert pairs.count() == 35 and pairs.distinct().count() == 35


def test_latest_version_stays_open(spark):
    versions = spark.createDataFrame(
        [("p", 1, date(2019, 1, 1), date(2019, 6, 1)), ("p", 1, date(2019, 6, 1), None), ("q", 2, date(2019, 1, 1), date(2019, 2, 1))],
        "PolicyID string, member_id int, VersionStartDate date, VersionEndDate date",
    )
    ends = {(r["member_id"], r["VersionStartDate"]): r["VersionEndDate"] for r in portfolio.active_version(versions, "2020-03-15").collect()}
    assert ends == {(1, date(2019, 1, 1)): date(2019, 6, 1), (1, date(2019, 6, 1)): date(2020, 3, 15), (2, date(2019, 1, 1)): date(2020, 3, 15)}


def test_version_join_equals_the_range_test(spark):
    versions = [("p", m, date(2019, s, 5), date(2019, e, 20)) for m in (1, 2) for s, e in ((1, 3), (2, 7), (5, 5))]
    months = [("p", m, date(2019, k, d)) for m in (1, 2, 3) for k in range(1, 10) for d in (1, 15)]
    joined = portfolio.valid_version(
        spark.createDataFrame(versions, "PolicyID string, member_id int, VersionStartDate date, VersionEndDate date"),
        spark.createDataFrame(months, "PolicyID string, member_id int, year_month_date date"),
        "2019-07-01",
    )
    found = sorted((r["member_id"], r["year_month_date"], r["VersionStartDate"]) for r in joined.collect())
    assert found == sorted((m, d, s) for _, m, d in months for _, n, s, e in versions if m == n and s <= d <= e and d < date(2019, 7, 1))


def _invoices(spark):
    return spark.createDataFrame(
        [(M1, p, a, r, s, i, 10.0 * n, n, n + 1) for n, (p, a, r, s, i) in enumerate(product("AB", ["0_20", "21_35"], "NS", ["S1", "S2"], ["x", "y"]), 1)],
        "year_month_date date, PolicySubType string, AgeBucket string, UKMemberRegion string, SystemID string, MajorICDGroupingDescription string, amount_paid double, nb_claim long, nb_invoice long",
    )


CLUSTERS = [("all", None, None), ("A", "A", None), ("x", None, "x"), ("Bx", "B", "x"), ("AB", "A", None), ("AB", "B", None), ("none", "Z", None), ("no icd", None, "zzz")]


def test_cluster_series_equals_a_loop_over_clusters(spark, members):
    census, invoices = portfolio.census_cube(members).cache(), _invoices(spark)
    dense = portfolio.dense_portfolio(census, invoices)
    # every row twice: models share the clusters table
    clusters = spark.createDataFrame(CLUSTERS * 2, "cluster_id string, PolicySubType string, MajorICDGroupingDescription string")
    found = {
        (r["cluster_id"], r["year_month_date"]): (r["nb_member"], r["amount_paid"], r["nb_claim"])
        for r in portfolio.cluster_series(census, invoices, clusters).collect()
    }
    rows = dense.collect()
    expected = {}
    for cluster in {c for c, _, _ in CLUSTERS}:
        dims = [(p, i) for c, p, i in CLUSTERS if c == cluster]
        for month in (M1, M2):
            member_rows = {
                (r["PolicySubType"], r["nb_member"])
                for r in rows for p, i in dims
                if r["year_month_date"] == month and r["PolicySubType"] == (p or "_") and r["AgeBucket"] == "_" and r["UKMemberRegion"] == "_" and (i is None or r["MajorICDGroupingDescription"] == i)
            }
            if member_rows:
                facts = [
                    r for r in rows for p, i in dims
                    if r["year_month_date"] == month and "_" not in (r["PolicySubType"], r["AgeBucket"], r["UKMemberRegion"])
                    and p in (None, r["PolicySubType"]) and i in (None, r["MajorICDGroupingDescription"])
                ]
                expected[cluster, month] = (sum(n for _, n in member_rows), sum(r["amount_paid"] for r in facts), sum(r["nb_claim"] for r in facts))
    assert found == expected
    assert ("none", M1) not in found and ("no icd", M1) not in found


def test_zero_denominators_give_null(spark):
    df = spark.createDataFrame([(0.0, 0, 0, 0)], "amount_paid double, nb_claim long, nb_invoice long, nb_member long")
    row = portfolio.add_ratios(df).first()
    assert row["severity_claim"] is None and row["burning_cost"] is None


def test_coefficients_scale_only_matched_rows(spark):
    invoices = spark.createDataFrame([(M1, "A", 10.0, 2, 4), (M1, "B", 10.0, 2, 4)], "year_month_date date, PolicySubType string, amount_paid double, nb_claim long, nb_invoice long")
    coefs = spark.createDataFrame(
        [("A", M1, "ultimate_nb_claim_paid", None, 1.5, None), ("C", M1, "ultimate_nb_claim_paid", None, 2.0, None)],
        "PolicySubType string, treatment_date date, target string, coef_amount double, coef_nb_claim double, coef_nb_invoice double",
    )
    out = {r["PolicySubType"]: (r["amount_paid"], r["nb_claim"]) for r in portfolio.apply_coefficients(invoices, coefs, [["PolicySubType"]]).collect()}
    assert out == {"A": (10.0, 3.0), "B": (10.0, 2.0), "C": (None, None)}


def test_invoice_aggregate_needs_a_date(spark):
    with pytest.raises(ValueError):
        portfolio.monthly_invoices(spark.createDataFrame([(1,)], "x int"), "2020-01-01")


def test_grouping_sets_top_row_is_the_total(spark, members):
    totals = portfolio.grouping_sets_total(members, [], ["PolicySubType", "UKMemberRegion"], {"n": F.count("*")})
    assert totals.where("dims_kept = 0").first()["n"] == members.count()
    assert totals.where("dims_kept = 3").agg(F.sum("n")).first()[0] == members.count()


def test_invoices_in_shares_give_the_same_portfolio(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(8)
    day = lambda i: datetime(1996, 1, 1) + timedelta(int(i))
    pick = lambda values: values[int(rng.integers(len(values)))]
    orders = [(i if i % 41 else None, int(rng.integers(60)) if i % 37 else None, "F", float(i), day(rng.integers(1800)), pick(["1-URGENT", "5-LOW", "4-NOT SPECIFIED"])) for i in range(400)]
    lines = []
    for _ in range(2500):  # few numbers, so many lines have copies that differ, some of them with another state or part
        number, key = int(rng.integers(1, 8)), int(rng.integers(400))
        lines.append((key if rng.random() < 0.97 else None, int(rng.integers(80)), int(rng.integers(20)), number if rng.random() < 0.97 else None, float(rng.integers(50)), float(rng.integers(100, 999)), 0.1, 0.0, pick("ANR"), pick("FO"), day(1800 + rng.integers(300))))
    lines += lines[::9]
    tables = {
        "customer": ([(i, f"c{i}", i % 5, 1.0, "M") for i in range(60)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": ([(i, f"n{i}", i % 2) for i in range(5)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "EAST"), (1, "WEST")], "r_regionkey int, r_name string"),
        "part": ([(i, "p", "b", pick(["LARGE", "SMALL", None]), 1, 1.0) for i in range(80)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": (orders + orders[::50], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    found, written = [], []
    for size in (1, 1 << 40):
        monkeypatch.setattr(staging, "SHARE_BYTES", size)
        run = inflation_run(spark, str(tmp_path))
        assert len(run.shares) == (staging.SHARES if size == 1 else 0)
        months = run.invoice_months().collect()
        members = QUERIES["ag9_cluster_members"].run(spark, str(tmp_path)).collect()
        found.append([sorted(repr(r.asDict() | ({"amount_paid": round(r.amount_paid, 6)} if "amount_paid" in r else {})) for r in rows) for rows in (months, members)])
        if size == 1:
            written = [share.invoices().count() for share in run.shares]
    assert found[0] == found[1] and all(found[0]) and len(found[0][0]) > 100
    assert sum(written) == inflation_run(spark, str(tmp_path)).claims.invoices().count() and max(written) < 0.5 * sum(written)
