"""Every registered query with an oracle matches DuckDB on sf0.001
(row count, column names, order-insensitive values)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, rows_of

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_small}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_registered_has_callable():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) >= 80


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, sf_small, con, name):
    df = QUERIES[name](spark, sf_small)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    dnames = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dnames)
    assert len(srows) == len(drows)
    assert rows_of(df.columns, srows) == rows_of(dnames, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert {"cluster", "n", "pct"} <= set(df.columns)
