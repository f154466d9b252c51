"""The queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

from rankloom.llm import oracle, queries


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query(spark, sf, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    cursor = con.execute(oracle.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    df = queries.queries()[name](spark, sf)
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    expected = sorted(repr([dict(zip(names, r))[c] for c in order]) for r in cursor.fetchall())
    assert sorted(repr([r[c] for c in order]) for r in df.collect()) == expected
