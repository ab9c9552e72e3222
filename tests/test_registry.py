"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from registry.oracle import ORACLE as SQL
from registry.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, float) and value.is_integer():
        value = int(value)
    if isinstance(value, datetime.datetime):
        value = value.replace(tzinfo=None)
    return (1, str(value))


def in_order(names, content):
    order = [names.index(name) for name in sorted(names)]
    return sorted(tuple(plain(row[i]) for i in order) for row in content)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= entry_points.queries().keys() and SQL.keys() <= entry_points.oracle_sql().keys()


@pytest.mark.parametrize("name", SQL)
def test_query(spark, database, name):
    df = QUERIES[name](spark, str(SF_DIR))
    expected = database.execute(SQL[name])
    names = [column[0] for column in expected.description]
    assert sorted(df.columns) == sorted(names)
    got, wanted = in_order(df.columns, df.collect()), in_order(names, expected.fetchall())
    assert len(wanted) > 0 and got == wanted


def test_entry(spark):
    assert tuple(entry_points.entry(spark).first()) == (1161, 339, 1500)


def test_queries_read_only_the_columns_they_need(spark):
    plan = QUERIES["keys_in_both"](spark, str(SF_DIR))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>") == 2
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan
