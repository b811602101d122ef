"""Near-duplicate vectors against all pairs."""

import math

import numpy as np
import pytest

from kempt.llm import hyperplanes as H
from tests.llm.brute import components_of


def brute(rows, threshold=0.95):
    """(vec_id, n_links, component_id, kept) with every pair compared."""
    dim = max((len(v) for _, v in rows if v is not None), default=0)

    def usable(v):
        return v is not None and all(c is not None and math.isfinite(c) for c in v) and any(v)

    n = len(rows)
    ok = np.array([usable(v) for _, v in rows])
    x = np.array([[*v, *[0.0] * (dim - len(v))] if usable(v) else [1.0] * dim for _, v in rows])
    x /= abs(x).max(axis=1, keepdims=True)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    linked = (x @ x.T >= threshold) & ok & ok[:, None] & ~np.eye(n, dtype=bool)
    root = components_of(n, lambda i, j: linked[i, j])
    links = linked.sum(axis=1).tolist()
    lead = {}
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            lead[r] = min(lead.get(r, rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], links[i], lead.get(root[i]), rows[i][0] == lead.get(root[i])) for i in range(n)), key=str)


def clustered(seed, n=260, dim=12):
    """Groups of copies, some tight and some at about the threshold, and strangers."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(n // 13, dim))
    x = [centre[i % len(centre)] + (0.02, 0.1, 0.22, 3.0)[i % 4] * rng.normal(size=dim) for i in range(n)]
    return [(i, [float(c) for c in v]) for i, v in enumerate(x)]


EDGES = [(1000, None), (1001, [0.0] * 12), (1002, [float("nan"), *[1.0] * 11]), (1003, [float("inf"), *[1.0] * 11]),
         (1004, [None, *[1.0] * 11]), (1005, []), (1006, [2.0]), (1007, [5.0, -0.0]), (1007, [-5.0]), (None, [0.5]), (None, [0.0, 0.0, 7.0]),
         (1008, [1e-200, 0.0]), (1009, [1e200]), (None, None), (5, [3.0] * 12)]


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("block", [2048, 7])
def test_all_links_of_a_small_table(spark, seed, block):
    rows = clustered(seed) + EDGES
    rows += [(2000 + i, rows[0][1]) for i in range(40)]  # a crowd of equal vectors
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], "vec_id long, embedding array<double>, node string, n int, t int").repartition(3)
    got = H.near_vectors(df, block=block, miss=1e-9)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_crowded_buckets_are_split(spark):
    """A group of near copies in one bucket, met in blocks of a few chunks."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=16)
    rows = [(i, [float(c) for c in base + 0.12 * rng.normal(size=16)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, H.near_vectors(df, block=16, miss=1e-9).collect()), key=str) == brute(rows)


def test_recall_at_the_threshold():
    """Pairs at exactly the threshold meet as often as planned, whatever the number of vectors."""
    rng = np.random.default_rng(4)
    for n in (500, 100_000, 10**9):
        bits, tables = H.plan(n, 0.95, 512, 0.002)
        planes = H.directions(24, bits, tables)
        x, y = rng.normal(size=(2, 4000, 24))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y -= (x * y).sum(axis=1, keepdims=True) * x
        y = 0.95 * x + math.sqrt(1 - 0.95**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
        same = ((x @ planes >= 0) == (y @ planes >= 0)).reshape(4000, tables, bits).all(axis=2).any(axis=1)
        assert same.mean() >= 0.99


def test_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert H.near_vectors(spark.createDataFrame([], schema)).count() == 0
    none = spark.createDataFrame([(1, None), (2, [0.0])], schema)
    assert sorted(map(tuple, H.near_vectors(none).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    two = spark.createDataFrame([(8, [1.0, 2.0]), (3, [2.0, 4.0])], schema)
    assert sorted(map(tuple, H.near_vectors(two).collect())) == [(3, 1, 3, True), (8, 1, 3, False)]
    with pytest.raises(ValueError):
        H.near_vectors(two, threshold=0.0)


def test_a_pair_counts_once(spark):
    """Twenty tables bring the same pairs together; links are still single."""
    rows = [(i, [1.0, 0.01 * i, 0.0]) for i in range(12)]
    got = H.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), miss=1e-9).collect()
    assert {r.n_links for r in got} == {11}
