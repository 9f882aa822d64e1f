"""Every registered query against its SQL in DuckDB, and the contract of the entry points."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from waymark.catalog import ENTRIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return connection


def value(item):
    if isinstance(item, float):
        return None if item != item else round(item, 8)
    return str(item) if isinstance(item, (dt.date, dt.datetime)) else item


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query_agrees_with_sql(spark, sf, duck, name):
    df = entry_points.queries()[name](spark, sf)
    expected = duck.sql(entry_points.oracle_sql()[name])
    columns = sorted(df.columns)
    assert sorted(expected.columns) == columns
    kinds = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[df.schema[c].dataType.simpleString()] for c in columns} == {c: kinds[c] for c in columns}
    places = [expected.columns.index(c) for c in columns]
    got = Counter(tuple(value(row[c]) for c in columns) for row in df.collect())
    want = Counter(tuple(value(row[i]) for i in places) for row in expected.fetchall())
    assert got == want


def test_every_query_has_sql():
    assert set(ENTRIES) <= set(entry_points.queries())
    assert set(ENTRIES) <= set(entry_points.oracle_sql())


def test_entry_returns_rows(spark):
    assert entry_points.entry(spark).count() > 0
