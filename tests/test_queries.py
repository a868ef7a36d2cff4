"""Every query that has SQL against DuckDB on the smallest test tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from cytogrid.plans.registry import oracle_sql, queries

DATA = os.environ.get("CYTOGRID_TEST_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(x):
    if x is None or x != x:
        return None
    if isinstance(x, bool):
        return x
    return round(float(x), 9) if isinstance(x, int | float) else str(x)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, con, name):
    df = queries()[name](spark, DATA)
    cur = con.execute(oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(cols)
    order = sorted(cols)
    want = sorted((tuple(plain(r[cols.index(c)]) for c in order) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    assert got == want


def test_entry_registers_all(spark):
    import __spark_entry__ as e

    assert set(oracle_sql()) <= set(queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
