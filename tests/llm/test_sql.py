"""Registered queries against their SQL, over whole tables."""

import duckdb
import pytest

from lakemart.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(name, spark, testdata):
    duck = duckdb.connect()
    for table in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{testdata}/{table}.parquet'")
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    df = QUERIES[name](spark, testdata)
    assert sorted(names) == sorted(df.columns)
    expected = sorted((dict(zip(names, row, strict=True)) for row in result.fetchall()), key=repr)
    found = sorted(({n: r[n] for n in names} for r in df.collect()), key=repr)
    assert found == expected
