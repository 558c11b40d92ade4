"""Every registered query against the same question put to DuckDB in SQL."""

from __future__ import annotations

import math
from datetime import date, datetime
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from trustgate.checks.oracle import ORACLE_SQL
from trustgate.checks.queries import QUERIES

SF = "/root/testdata/sf0.01"
TABLES = ("lineitem", "orders", "events")

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    yield connection
    connection.close()


def comparable(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (datetime, date)):
        return str(value)
    return value


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(comparable(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is None, type(v).__name__, str(v)) for v in row),
    )


SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert len(QUERIES) == 68
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, duck):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    types = dict(zip(want.columns, map(str, want.types)))
    assert {c: SPARK_TYPES[t] for c, t in got.dtypes} == types
    got_rows = multiset(got.columns, got.collect())
    want_rows = multiset(want.columns, want.fetchall())
    assert len(got_rows) == len(want_rows)
    assert got_rows, "no rows"
    for mine, theirs in zip(got_rows, want_rows):
        assert mine == theirs


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
