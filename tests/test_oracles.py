"""Every registered query against its SQL, over whole tables."""

import decimal

import duckdb
import pytest

from lakemart.registry import QUERIES
from oracles import ORACLES

TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def duck(testdata):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{testdata}/{table}.parquet'")
    return connection


def _plain(value):
    return str(value) if isinstance(value, decimal.Decimal) else value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, testdata, duck):
    df = QUERIES[name](spark, testdata)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, result.fetchall())
