"""Every query against its SQL in DuckDB: columns, types that matter, and all values."""

import datetime
import os
from collections import Counter

import duckdb
import pytest

from rallybook.oracle import ORACLE_SQL
from rallybook.queries import QUERIES

TABLES = ("customer", "nation", "orders", "lineitem")
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def kind(value):
    return datetime.date if isinstance(value, datetime.date) else type(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    rows = [tuple(row[c] for c in columns) for row in result.collect()]
    cursor = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    order = [names.index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    assert sorted(names) == columns
    assert rows, "a query without rows checks nothing"
    assert Counter(rows) == Counter(expected)
    for i in range(len(columns)):
        kinds = {kind(r[i]) for r in rows} - {type(None)}
        assert kinds == {kind(r[i]) for r in expected} - {type(None)}, columns[i]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
