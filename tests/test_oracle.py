"""Every registered query against its DuckDB oracle at the smallest scale factor
(names, types and order-insensitive values, as the driver compares them)."""

import math
import os

import pytest

from kempt.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
# DuckDB type names and their Spark spelling.
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
         "DATE": "date", "TIMESTAMP": "timestamp_ntz"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.12g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = df.columns
    got = _rows([tuple(r) for r in df.collect()], cols)
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    want = _rows(cur.fetchall(), dcols)
    assert sorted(cols) == sorted(dcols)
    stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert {c: TYPES.get(str(d[1]), str(d[1])) for c, d in zip(dcols, cur.description)} == \
        {c: stypes[c] for c in dcols}
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
