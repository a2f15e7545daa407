"""The queries that SQL can express against DuckDB, on the sf0.001 tables."""

from collections import Counter

import duckdb
import pytest

from tiersmith.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.execute(ORACLES[key])
    names = [c[0] for c in found.description]
    df = QUERIES[key](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert Counter(map(tuple, df.select(*names).collect())) == Counter(found.fetchall())
