"""Every query with SQL against DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from matchloom.plans.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    rows, columns = df.collect(), sorted(df.columns)
    if name in SQL:
        found = duck.execute(SQL[name])
        order = [d[0] for d in found.description]
        assert sorted(order) == columns
        assert sorted(repr(tuple(r[c] for c in columns)) for r in rows) == sorted(repr(tuple(r[order.index(c)] for c in columns)) for r in found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
