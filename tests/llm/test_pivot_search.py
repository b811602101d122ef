"""Exact top-k against all products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kempt.llm import pivot_search as P


def brute(rows, is_query, k):
    """Sorted (query_id, rank, vec_id, score): every row but the query's own is a candidate."""
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (qi, q) in enumerate(ok):
        if is_query(qi):
            hits = sorted((-sum(a * b for a, b in zip(q, x, strict=False)), i) for j, (i, x) in enumerate(ok) if j != n)
            out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(hits[:k])]
    return sorted(out)


@pytest.mark.parametrize(("pivots", "block_rows", "query_rows"), [(1, 4096, 256), (7, 13, 3), (32, 50, 8)])
def test_exact(spark, pivots, block_rows, query_rows):
    rng = np.random.default_rng(pivots)
    centres = rng.normal(size=(6, 5))
    rows = [(i, (centres[i % 6] + 0.2 * rng.normal(size=5)).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(120)]  # a crowd of equal vectors: ties
    rows += [(1000, None), (1010, [None, 1.0, 0.0, 0.0, 0.0]), (1020, [float("nan")] * 5), (1030, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
             (None, [1.0] * 5), (1040, []), (1050, [2.0]), (10, rows[10][1]), (10, rows[11][1]), (7, rows[7][1]), (7, rows[7][1]), (1060, [0.0] * 5)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, v string, cell int").repartition(3)
    got = P.top_k(df, F.col("vec_id") % 10 == 0, pivots=pivots, block_rows=block_rows, query_rows=query_rows, part_blocks=3).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, lambda i: i % 10 == 0, 5)


def test_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert P.top_k(spark.createDataFrame([], schema), F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0])], schema)
    assert P.top_k(one, F.col("vec_id") % 50 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [-1.0, 0.5])], schema)
    assert [tuple(r) for r in P.top_k(two, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, -65536 + 65536)]
    assert P.top_k(two, F.col("vec_id") > 50).count() == 0
    large = spark.createDataFrame([(0, [1e6, 3.0]), (1, [-1e6, -0.1])], schema)  # beyond exact doubles
    assert P.top_k(large, F.col("vec_id") == 0).first().score == -256000000 * 256000000 + 768 * -26


def test_bounds_hold():
    rng = np.random.default_rng(0)
    x = rng.integers(-300, 300, (200, 8))
    pivots = P.choose_pivots(x[:50], 10)
    d = P.distances(x, pivots)
    low = np.abs(d[:, None] - d[None]).max(axis=2)
    bound = P.upper((x * x).sum(axis=1)[:, None], (x * x).sum(axis=1)[None], low)
    assert (bound >= x @ x.T).all()


def test_repeated_ids_are_rows_of_their_own(spark):
    from kempt.llm.queries import ORACLE
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [3.0, 0.0]), (1, [3.0, 0.0]), (2, [0.5, 0.5]), (50, [-1.0, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in P.top_k(df, F.col("vec_id") % 50 == 0).collect())
    assert got == brute(rows, lambda i: i % 50 == 0, 5) and [g[2] for g in got if g[0] == 0][:2] == [0, 0]
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    assert sorted(con.execute(ORACLE["op10_pivot_search"]).fetchall()) == got


def test_components_take_the_narrowest_type():
    assert [P.narrowest(t) for t in (0, 32767, 32768, 2**31, 2**40)] == ["int16", "int16", "int32", "int64", "int64"]
