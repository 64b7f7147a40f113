"""Every named query against its SQL, run by DuckDB on the same files."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value)
        return str(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query_matches_sql(spark, database, name):
    result = driver.queries()[name](spark, FOLDER)
    rows = [tuple(row) for row in result.collect()]
    assert rows, "no rows"
    sql = driver.oracle_sql().get(name)
    if sql is None:
        return
    expected = database.execute(sql)
    columns = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert canonical(rows, result.columns) == canonical(expected.fetchall(), columns)


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_runs(spark):
    assert driver.entry(spark).count() == 30
