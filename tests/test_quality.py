import pytest
from pyspark.sql import functions as F

from lossgrid.operators import quality


@pytest.fixture(scope="module")
def copies(spark):
    """One key holds most rows, full copies included, spread over several partitions."""
    rows = [("hot", i % 7, "x") for i in range(300)] + [(f"k{i}", i, None) for i in range(40)] + [(None, 1, "n"), (None, 2, "n")]
    return spark.createDataFrame(rows, "k string, v int, w string").repartition(8)


def test_exactly_one_copy_of_each_key_is_first(copies):
    flagged = quality.add_dq_flags(copies, ["k"]).cache()
    firsts = flagged.where(~F.col("duplicated_row_dq_flag"))
    assert firsts.count() == 42 and firsts.select("k").distinct().count() == 42
    assert firsts.where("k = 'hot'").first()["v"] == 0
    assert firsts.where("k is null").first()["v"] == 1


def test_valid_and_quarantine_cover_the_input(copies):
    flagged = quality.add_dq_flags(copies, ["k"])
    assert quality.valid_rows(flagged, ["k"]).count() + quality.quarantine(flagged).count() == copies.count()


def test_first_copies_equal_valid_rows(copies):
    valid = quality.valid_rows(quality.add_dq_flags(copies, ["k"]), ["k"])
    first = quality.first_copies(copies, ["k"])
    assert valid.exceptAll(first).isEmpty() and first.exceptAll(valid).isEmpty()
    assert first.count() == 41


def test_counts_are_zero_without_problems(spark):
    clean = spark.createDataFrame([(1,), (2,)], "k int")
    counts = quality.dq_counts(quality.add_dq_flags(clean, ["k"]), ["k"]).first()
    assert counts["k_null_dq_flag"] == 0 and counts["duplicated_row_dq_flag"] == 0


def test_join_with_coverage_refuses_to_lose_rows(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "m int, x string")
    right = spark.createDataFrame([(1, 5.0)], "m int, r double")
    with pytest.raises(ValueError):
        quality.join_with_coverage(left, right, ["m"])
    assert quality.join_with_coverage(left.where("m = 1"), right, ["m"]).count() == 1


def test_missing_regressor_marks_the_month(spark):
    df = spark.createDataFrame([("m1", 1.0, 2.0), ("m2", None, 2.0)], "month string, CPI double, price double")
    marked = {r["month"]: r["invalid"] for r in quality.missing_regressors(df, ["CPI", "price"], "month").collect()}
    assert marked == {"m1": False, "m2": True}


def test_derived_tables_keep_their_keys_unique(spark):
    from lossgrid.plans.claims import PRIMARY_KEYS
    from lossgrid.workload.claims import claims_run

    run = claims_run(spark, "/root/testdata/sf0.001")
    for name, df in {"contracts": run.contracts(), "invoices": run.invoices()}.items():
        counts = quality.dq_counts(quality.add_dq_flags(df, PRIMARY_KEYS[name]), PRIMARY_KEYS[name]).first()
        assert not any(counts), name
