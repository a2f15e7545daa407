"""Registered queries against their DuckDB oracles on the sf0.001 tables
(the driver runs the full comparison at sf0.01)."""

import datetime as dt
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
KEYS = sorted(set(entry.oracle_sql()) - set(entry.LLM_QUERIES))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_oracle_or_is_rows_only():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(q) - set(entry.LLM_QUERIES) <= set(o) <= set(q)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["customer_id", "customer_first_name"] and df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    rel = duck.sql(entry.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    s = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    d_idx = [rel.columns.index(c) for c in cols]
    d = Counter(tuple(norm(r[i]) for i in d_idx) for r in rel.fetchall())
    assert s == d
