"""Each registered query against its SQL twin in DuckDB, value for value."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()
ONLY = [n for n in os.environ.get("ONLY", "").split(",") if n]


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')"
        )
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", ONLY or sorted(QUERIES))
def test_query(name, spark, folder, duck):
    df = QUERIES[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    assert len(set(df.columns)) == len(df.columns)
    if name not in ORACLES:
        assert rows or name.endswith("_issues")
        return
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    ours, theirs = _sorted_rows(df.columns, rows), _sorted_rows(columns, expected)
    assert len(ours) == len(theirs)
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    assert not different, different[:3]
