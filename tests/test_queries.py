"""Every registered query against its SQL."""

import duckdb
import pytest

import __spark_entry__
from compare import connect, differences
from tidemark.plans import catalogue, oracles

NAMES = sorted(__spark_entry__.oracle_sql())


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sf_dir, connection, name):
    df = __spark_entry__.queries()[name](spark, sf_dir)
    assert differences(df, connection, __spark_entry__.oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert set(oracles.oracle_sql()) == set(catalogue.queries())


def test_entry_has_rows_and_fixed_columns(spark):
    df = __spark_entry__.entry(spark)
    assert len(df.columns) == 15
    assert df.count() == 15


def test_comparison_notices_differences(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "a int, b double")
    same = "SELECT * FROM (VALUES (1, 2.0::DOUBLE), (2, NULL)) t(a, b)"
    assert differences(df, duckdb.connect(), same) == []
    assert differences(df, duckdb.connect(), same.replace("2.0", "2.5"))
    assert differences(df, duckdb.connect(), same + " WHERE a = 1")
    assert differences(df, duckdb.connect(), same.replace("t(a, b)", "t(a, c)"))
