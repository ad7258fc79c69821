"""Every registered query with SQL equals it on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as contract
from lossgrid.sources.staging import TABLES

SF_DIR = "/root/testdata/sf0.001"
NAMES = sorted(contract.oracle_sql())


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, name):
    df = contract.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = sorted(map(repr, map(tuple, df.select(*columns).collect())))
    theirs = sorted(map(repr, db.execute(f"SELECT {', '.join(columns)} FROM ({contract.oracle_sql()[name]}) q").fetchall()))
    assert ours == theirs


def test_entry_is_the_gold_table(spark):
    gold = contract.entry(spark)
    assert {"treatment_date", "lag", "is_inference", "ultimate_amount_paid"} <= set(gold.columns)
    assert gold.limit(1).count() == 1


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
