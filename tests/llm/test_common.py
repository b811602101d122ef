"""Prefix sums, row selection and components."""

import random

import pytest

from kempt.llm.common import keep_rows, may_be_in, membership, prefix_sums
from kempt.llm.components import components
from tests.llm.brute import components_of


@pytest.mark.parametrize(("n", "chunk"), [(0, 4), (1, 4), (4, 4), (5, 4), (70, 4), (70, 1024)])
def test_prefix_sums(spark, n, chunk):
    rng = random.Random(n)
    rows = [(i, rng.randint(0, 9), rng.randint(0, 9)) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, a long, b long")
    got = sorted(tuple(r) for r in prefix_sums(df, "k", ["a", "b"], chunk).select("k", "a_before", "b_before").collect())
    assert got == [(i, sum(r[1] for r in rows[:i]), sum(r[2] for r in rows[:i])) for i in range(n)]


def test_keep_rows_of_repeated_keys(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(1, "b", "x"), (1, "a", "x"), (2, "c", None), (None, "d", "y"), (3, "e", "z")],
                                 "id long, kept string, __key_id string")
    decisions = spark.createDataFrame([(1, True), (1, False), (2, False), (None, True), (3, True)], "id long, kept boolean")
    got = keep_rows(docs, decisions, {"id": F.col("id")})
    assert got.columns == docs.columns
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted([(1, "a", "x"), (None, "d", "y"), (3, "e", "z")], key=repr)


@pytest.mark.parametrize("words", [1, 64, 1 << 20])
def test_a_filter_loses_no_member(spark, words):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, f"t{i}", None) for i in range(3000)] + [(None, "none", 1)], "row long, word string, bits int")
    members = membership(df.filter("row % 10 = 0 OR row IS NULL"), F.xxhash64("row"), words)
    assert members.count() <= words
    inside, outside = (may_be_in(df, F.xxhash64("row"), members, words, inside=x) for x in (True, False))
    got, rest = ([tuple(r) for r in x.collect()] for x in (inside, outside))
    assert inside.columns == df.columns and sorted(got + rest, key=repr) == sorted((tuple(r) for r in df.collect()), key=repr)
    assert not any(r[0] is None or r[0] % 10 == 0 for r in rest)
    assert len(got) == 3001 if words == 1 else len(got) < 320 or words == 64


@pytest.mark.parametrize("words", [1, 1 << 20])
def test_keep_rows_at_any_filter(spark, words):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(i % 400, f"v{i % 3}", i % 7) for i in range(900)], "id int, v string, bits int")
    # the ids of the decisions are of another type; the filter hashes them as those of the rows
    decisions = docs.select(F.col("id").cast("long").alias("id"), "v", (F.col("id") % 5 > 0).alias("kept"))
    got = [tuple(r) for r in keep_rows(docs, decisions, {"id": F.col("id"), "v": F.col("v")}, words).collect()]
    assert sorted(r[:2] for r in got) == sorted({(i % 400, f"v{i % 3}") for i in range(900) if i % 400 % 5})
    assert set(got) <= {tuple(r) for r in docs.collect()}
    every = keep_rows(docs.limit(9), docs.limit(9).select("id", "v", F.lit(True).alias("kept")), {"id": F.col("id"), "v": F.col("v")}, words)
    assert every.count() == 9


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(7)
    n = 120
    ids = rng.sample(range(-10**6, 10**6), n)
    ids.sort()
    pairs = {"chain": [(i, i + 1) for i in range(n - 20)], "star": [(n - 1, i) for i in range(60)],
             "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(90)], "none": []}[shape]
    df = spark.createDataFrame([(ids[a], ids[b]) for a, b in pairs], "u long, v long")
    got = {r.node: r.root for r in components(df).collect()}
    linked = {frozenset(p) for p in pairs}
    want = components_of(n, lambda i, j: frozenset((i, j)) in linked)
    assert got == {ids[i]: ids[r] for i, r in enumerate(want) if i != r}
