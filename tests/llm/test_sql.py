"""Operators that SQL can express, against DuckDB."""

import duckdb
import pytest

from terrace.llm import queries

SF_DIR = "/root/testdata/sf0.01"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SF_DIR)
    expected = connection.execute(queries.ORACLE[name])
    kinds = {c[0]: str(c[1]) for c in expected.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    places = [list(kinds).index(c) for c in df.columns]
    rows = sorted((tuple(r[i] for i in places) for r in expected.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.collect()), key=repr) == rows
