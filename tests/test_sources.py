import glob
import uuid

import pytest
from pyspark.sql import functions as F

from lossgrid.session import materialise, shared_dir
from lossgrid.sources import catalog, sinks


def test_missing_table_is_empty(spark):
    empty = catalog.scan_or_empty(spark, "no_such_table", "a int, b string")
    assert empty.columns == ["a", "b"] and empty.count() == 0


def test_bounds_are_inclusive_and_need_a_column(spark):
    df = spark.sql("SELECT explode(sequence(DATE '2020-01-01', DATE '2020-01-10')) AS d")
    assert catalog.temporal_filter(df, "d", "2020-01-02", "2020-01-04").count() == 3
    with pytest.raises(ValueError):
        catalog.temporal_filter(df, None, "2020-01-02")


def test_table_name_is_full_or_in_parts():
    assert catalog.table_name(full="a.b.c") == "a.b.c" == catalog.table_name(catalog="a", schema="b", table="c")
    for wrong in ({}, {"full": "a", "table": "b"}):
        with pytest.raises(ValueError):
            catalog.table_name(**wrong)


def test_column_lookup(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Lag Days` int, amount int, AMOUNT_2 int")
    assert catalog.resolve_columns(df, ["lag_days", "Amount", "amount2"]).columns == ["lag_days", "Amount", "amount2"]
    with pytest.raises(KeyError):
        catalog.resolve_columns(df, ["absent"])
    with pytest.raises(ValueError):
        catalog.resolve_columns(spark.createDataFrame([(1, 2)], "`a-b` int, a_b int"), ["ab"])


def test_csv_rolls_files_and_drops_nested_columns(spark):
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    df = spark.range(0, 95, 1, 1).withColumn("m", F.create_map(F.lit("k"), F.lit("v"))).withColumn("n", F.lit(None).cast("string"))
    assert sinks.export_csv(df, path, 20) == ["id", "n"]
    assert len(glob.glob(f"{path.removeprefix('file:')}/part-*.csv")) == 5
    assert spark.read.option("header", True).csv(path).count() == 95
    with pytest.raises(ValueError):
        sinks.export_csv(df.select("m"), path + "x")
    sinks.export_csv(df, path + "y", 20, single_file=True)
    assert spark.read.option("header", True).csv(path + "y").count() == 95


def test_materialised_frame_is_equal(spark):
    df = spark.range(50).withColumn("x", F.col("id") / 7)
    stored = materialise(df)
    assert stored.exceptAll(df).isEmpty() and stored.count() == 50


def test_a_failure_between_rows_and_schema_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "scores")
    sinks.append_table(spark.createDataFrame([(1,)], "a int"), path)
    wider = spark.createDataFrame([(2, "x")], "a int, b string")

    def lost(*args):
        raise OSError("lost")

    monkeypatch.setattr(sinks, "_publish", lost)
    with pytest.raises(OSError):
        sinks.append_table(wider, path)
    monkeypatch.undo()
    assert sinks.read_appended(spark, path).collect() == [(1,)]
    sinks.append_table(wider, path)
    assert sorted(map(tuple, sinks.read_appended(spark, path).collect())) == [(1, None), (2, "x")]
    assert not list((tmp_path / "scores.staged").glob("*"))


def test_the_slower_of_two_writers_with_new_columns_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "scores")
    sinks.append_table(spark.createDataFrame([(1,)], "a int"), path)
    read = sinks._versions

    def overtaken(session, at):
        known = read(session, at)
        monkeypatch.setattr(sinks, "_versions", read)
        sinks.append_table(spark.createDataFrame([(2, 2.5)], "a int, c double"), path)
        return known

    monkeypatch.setattr(sinks, "_versions", overtaken)
    with pytest.raises(RuntimeError, match="another writer"):
        sinks.append_table(spark.createDataFrame([(3, "x")], "a int, b string"), path)
    assert sorted(map(tuple, sinks.read_appended(spark, path).collect())) == [(1, None), (2, 2.5)]
    (tmp_path / "scores.schema" / "3").write_text("")  # a version that is just being written
    assert sinks.appended_schema(spark, path).names == ["a", "c"]
