"""Every query with a SQL form gives what that SQL gives in another engine."""

import os

import pytest
from conftest import DATA

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def reference():
    connection = duckdb.connect()
    for name in os.listdir(DATA):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return connection


def text(value):
    if value is None or value != value:
        return "null"
    return str(float(value)) if isinstance(value, (int, float)) else str(value)


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(text(row[i]) for i in order) for row in data)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, reference, name):
    df = entry.queries()[name](spark, DATA)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLE:
        assert got
        return
    cursor = reference.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, cursor.fetchall())
