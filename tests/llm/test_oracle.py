"""Queries that SQL can express, against DuckDB on the same tables."""

import os

import pytest

from kempt.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(r[names.index(c)] for c in cols) for r in cur.fetchall())
    assert sorted(tuple(r) for r in df.select(*cols).collect()) == want
