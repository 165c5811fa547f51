"""Every registered query against its SQL, row by row."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from terrace.operators import keys

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
QUERIES = entry_point._ALL

# Spark type -> DuckDB types that hold the same values.
SAME_TYPE = {
    "bigint": {"BIGINT"},
    "boolean": {"BOOLEAN"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
}


@pytest.fixture(autouse=True)
def many_ranges(monkeypatch):
    """Several ranges in spite of few rows."""
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 200)


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows(found, names, order):
    place = [names.index(n) for n in order]
    made = [tuple(plain(row[i]) for i in place) for row in found]
    return sorted(made, key=lambda row: [(v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in row])


def compare(oracle, df, sql):
    expected = oracle.execute(sql)
    types = {column[0]: str(column[1]) for column in expected.description}
    assert sorted(df.columns) == sorted(types)
    for column, spark_type in df.dtypes:
        assert types[column] in SAME_TYPE[spark_type], (column, spark_type, types[column])
    order = sorted(df.columns)
    found = df.collect()
    assert found
    assert rows(found, df.columns, order) == rows(expected.fetchall(), list(types), order)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    run, sql = QUERIES[name]
    compare(oracle, run(spark, SF_DIR), sql)


@pytest.mark.parametrize("name", sorted(entry_point._DATES))
def test_registered_query_with_dates(spark, oracle, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    assert "date" not in dict(df.dtypes).values()
    compare(oracle, df, entry_point.oracle_sql()[name])


def test_every_date_is_registered(spark):
    for name, (run, _) in QUERIES.items():
        dates = [c for c, kind in run(spark, SF_DIR).dtypes if kind == "date"]
        assert sorted(dates) == sorted(entry_point._DATES.get(name, [])), name


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
