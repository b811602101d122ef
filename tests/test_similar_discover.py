"""Similar token sets against all pairs, inclusion dependencies against pairwise checks."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from kempt.operators.discover import inclusions
from kempt.operators.similar import match_similar, similar_sets, token_set
from tests.conftest import rows


def _jaccard(a, b):
    return len(a & b) / len(a | b)


@pytest.mark.parametrize(("threshold", "block"), [(0.3, 4096), (0.6, 5), (0.8, 1), (1.0, 3)])
def test_all_pairs_above_the_threshold(spark, threshold, block):
    rng = random.Random(int(threshold * 10))
    words = [f"w{i}" for i in range(30)]

    def make(n):  # small sets of words, two of which are nearly everywhere
        return [sorted({"street", "no", *rng.sample(words, rng.randint(0, 6))} - ({"no"} if rng.random() < 0.3 else set())) for _ in range(n)]

    left, right = make(250), make(200)
    frames = [spark.createDataFrame([(x,) for x in s + s[:40] + [[], None]], "tokens array<string>").repartition(3) for s in (left, right)]
    got = {(tuple(r.left_set), tuple(r.right_set)): r.similarity for r in similar_sets(*frames, threshold, block).collect()}
    want = {(tuple(a), tuple(b)): _jaccard(set(a), set(b)) for a, b in itertools.product(left, right) if _jaccard(set(a), set(b)) >= threshold}
    assert got == want and len(want) >= 5
    assert similar_sets(*frames, threshold, block).count() == len(want)  # each pair once


@pytest.mark.parametrize("threshold", [0.5, 0.9])
def test_sets_larger_than_their_signatures(spark, threshold):
    rng = random.Random(5)
    base = [f"t{i}" for i in range(150)]
    sets = [sorted(set(rng.sample(base, 140)) | {f"x{rng.randint(0, 40)}" for _ in range(rng.randint(0, 60))}) for _ in range(40)]
    df = spark.createDataFrame([(x,) for x in sets], "tokens array<string>")
    got = {(tuple(r.left_set), tuple(r.right_set)) for r in similar_sets(df, df, threshold).collect()}
    want = {(tuple(a), tuple(b)) for a, b in itertools.product(sets, sets) if _jaccard(set(a), set(b)) >= threshold}
    assert got == want and len(want) >= 40


def test_best_match_of_each_row(spark):
    known = spark.createDataFrame([("12 High Street, Leeds",), ("12, HIGH street Leeds",), ("4 Low Road York",), (None,), ("!!",), ("Äcker 5",)], "Text string")
    df = spark.createDataFrame([(1, "leeds high street 12", "x"), (2, "4 low road, york uk", "y"), (3, None, "z"), (4, "...", "z"), (5, "mars", "z"),
                                (6, "äcker 5", "z"), (1, "leeds high street 12", "x")], "id long, place string, tokens string")
    got = rows(match_similar(df, "PLACE", known, "text", 0.8))
    assert got == sorted([(1, "leeds high street 12", "x", "12 High Street, Leeds", 1.0)] * 2 + [
        (2, "4 low road, york uk", "y", "4 Low Road York", 0.8), (3, None, "z", None, None), (4, "...", "z", None, None),
        (5, "mars", "z", None, None), (6, "äcker 5", "z", "Äcker 5", 1.0)], key=lambda r: tuple((x is None, str(x)) for x in r))
    again = match_similar(match_similar(df, "place", known, "Text"), "place", known, "Text", grams=3)
    assert again.columns == ["id", "place", "tokens", "match_text", "match_similarity"]
    assert match_similar(df, "place", known.limit(0), "Text").filter("match_text IS NULL").count() == 7
    assert match_similar(df.limit(0), "place", known, "Text").count() == 0
    got = spark.range(1).select(token_set(F.lit("abca"), 3), token_set(F.lit("a"), 3), token_set(F.lit(None), 3)).first()
    assert tuple(got) == (["abc", "bca"], ["a"], [])
    with pytest.raises(ValueError, match="threshold"):
        similar_sets(df.select(F.array("place").alias("tokens")), df.select(F.array("place").alias("tokens")), 0)


@pytest.mark.parametrize("share", [1.0, 0.4])
def test_inclusions_are_those_of_pairwise_checks(spark, share):
    i = F.col("id")
    a = spark.range(60).select(i, (i % 9).cast("int").alias("fk"), F.when(i % 4 > 0, (i * 3).cast("string")).alias("t"), F.lit(None).cast("long").alias("none"),
                               F.when(i == 0, F.lit(-0.0)).when(i == 1, float("nan")).otherwise(i / 2).alias("x"), F.lit(None).cast("string").alias("i"))
    b = spark.range(10).select(i.alias("id"), (i * 6).cast("string").alias("t"), (i / 1).alias("x"), i.cast("string").alias("num"), F.array(i).alias("xs"))
    wide = spark.range(5).select(*[(i + j).alias(f"c{j}") for j in range(70)])  # more columns than one mask has bits
    tables = {"a": a, "b": b, "w": wide}
    got = {(r.dependent, r.referenced): (r.distinct_values, r.shared_values, r.share, r.referenced_unique) for r in inclusions(tables, share).collect()}
    values = {}
    for n, df in tables.items():
        data = df.collect()
        for f in df.schema.fields:
            kind = f.dataType.simpleString().replace("bigint", "int")
            column = [str(r[f.name]).replace("-0.0", "0.0") for r in data if r[f.name] is not None]
            values[f"{n}.{f.name}"] = (kind, set(column), len(column) == len(set(column)))
    want = {}
    for (d, (kd, vd, _)), (r, (kr, vr, unique)) in itertools.permutations(values.items(), 2):
        if kd == kr and vd and len(vd & vr) / len(vd) >= share and vd & vr:
            want[d, r] = (len(vd), len(vd & vr), len(vd & vr) / len(vd), unique)
    assert got == want and ("a.fk", "b.id") in got and ("a.fk", "a.id") in got
    assert inclusions({"a": a.limit(0)}).count() == 0
    with pytest.raises(ValueError, match="no columns"):
        inclusions({})
