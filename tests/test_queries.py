"""Every registered query against DuckDB on the same tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as checked
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    answer = duck.execute(ORACLES[name])
    assert sorted(column[0] for column in answer.description) == columns
    ordered = ", ".join(f'"{column}"' for column in columns)
    expected = duck.execute(f"SELECT {ordered} FROM ({ORACLES[name]})").fetchall()
    actual = [tuple(row) for row in frame.select(*columns).collect()]
    assert actual
    assert Counter(actual) == Counter(expected)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert checked.entry(spark).count() > 0
