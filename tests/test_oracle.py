"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from workload.oracle import oracle_sql
from workload.queries import queries

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(entry.queries()) and set(oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    df = queries()[name](spark, SF)
    cursor = db.execute(oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    expected = sorted(repr([dict(zip(names, r))[c] for c in order]) for r in cursor.fetchall())
    assert sorted(repr([r[c] for c in order]) for r in df.collect()) == expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0
