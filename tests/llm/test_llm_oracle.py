"""Every text query that has one against its SQL in DuckDB, on whole tables."""

import os
from collections import Counter

import duckdb
import pytest

from rallybook.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_oracle(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels", "embeddings"):
        duck.execute(f"create view {table} as select * from read_parquet('{SF_DIR}/{table}.parquet')")
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    rows = [tuple(r[c] for c in columns) for r in result.collect()]
    cursor = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    expected = [tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()]
    assert sorted(names) == columns and rows
    assert Counter(rows) == Counter(expected)
    for i, c in enumerate(columns):
        assert {type(r[i]) for r in rows} == {type(r[i]) for r in expected}, c
