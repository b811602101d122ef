"""k-anonymity against the same cuts made one group at a time."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kempt.operators.anonymize import k_anonymous


def _key(v):
    return (v is not None, v if v is not None else 0)


def brute(rows, k):
    """Groups (frozen multisets of rows) of recursive median cuts."""
    best = None
    for d in range(len(rows[0])):
        values = sorted((r[d] for r in rows), key=_key)
        m = _key(values[(len(values) + 1) // 2 - 1])
        for cut in (lambda r, d=d, m=m: _key(r[d]) < m, lambda r, d=d, m=m: _key(r[d]) <= m):
            first = [r for r in rows if cut(r)]
            less = min(len(first), len(rows) - len(first))
            if less >= k and (best is None or less > best[0]):
                best = less, first, [r for r in rows if not cut(r)]
    if best is None:
        return [frozenset(Counter(rows).items())]
    return brute(best[1], k) + brute(best[2], k)


@pytest.mark.parametrize(("k", "n"), [(1, 25), (4, 100), (25, 150)])
def test_groups_are_those_of_recursive_cuts(spark, k, n):
    rng = random.Random(k)
    data = [(rng.choice([None, 1, 2, 3, 1000]), rng.choice(["a", "b", None]) if rng.random() < 0.5 else "hot", rng.randint(0, 3000) / 2) for _ in range(n - 10)]
    data += [data[0]] * 10  # repeated rows
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "path long, zip long, q0 string, v double").repartition(3)
    got = k_anonymous(df, ["ZIP", "q0", "v"], k).collect()
    assert sorted(r.path for r in got) == list(range(n))
    groups = {}
    for r in got:
        groups.setdefault(r.group_id, []).append(r)
    assert all(len(g) >= k and {r.group_rows for r in g} == {len(g)} for g in groups.values())
    assert Counter(frozenset(Counter(data[r.path] for r in g).items()) for g in groups.values()) == Counter(brute(data, k))
    for g in groups.values():
        members = [data[r.path] for r in g]
        for i, c in enumerate(("zip", "q0", "v")):
            filled = [m[i] for m in members if m[i] is not None]
            assert {(r[f"{c}_low"], r[f"{c}_high"], r[f"{c}_null"]) for r in g} == {(min(filled, default=None), max(filled, default=None), len(filled) < len(members))}


def test_ranks_beyond_one_pass(spark):
    df = spark.range(3000).select("id", (F.col("id") * 7919 % 3001).alias("v"))
    got = k_anonymous(df, ["v"], 700).groupBy("group_id", "group_rows").agg(F.count("*").alias("n"), F.min("v_low").alias("lo"), F.max("v_high").alias("hi")).collect()
    assert [r.n for r in got] == [750] * 4 and all(r.group_rows == r.n for r in got)
    spans = sorted((r.lo, r.hi) for r in got)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_few_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, held string")
    with pytest.raises(ValueError, match="2 rows"):
        k_anonymous(df, ["x"], 3)
    with pytest.raises(ValueError, match="quasi"):
        k_anonymous(df, [], 1)
    assert k_anonymous(df.limit(0), ["x"], 3).count() == 0
    assert {tuple(r) for r in k_anonymous(df, ["x"], 2).collect()} == {(1, 2, False, "a", "", 2), (1, 2, False, None, "", 2)}
