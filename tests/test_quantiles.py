"""Many exact ranks at once against the one-rank search and sorted values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from kempt.operators.quantiles import equal_frequency, exact_quantiles
from kempt.operators.stats import exact_quantile, impute

NAN, INF = float("nan"), float("inf")


def _same(a, b):
    return a == b or (a is not None and b is not None and (math.isnan(a) and math.isnan(b) or math.isclose(a, b, rel_tol=1e-12)))


@pytest.mark.parametrize(("few", "buckets", "accuracy"), [(1000, 16384, 10000), (1, 16, 10), (40, 64, 3)])
def test_as_the_search_for_one_rank(spark, few, buckets, accuracy):
    rng = random.Random(few)
    data = [(rng.choice([None, 5, 5, 5, 7]), rng.gauss(0, 1), math.exp(rng.gauss(0, 40)) * rng.choice([1, -1]),
             rng.choice([NAN, INF, -INF, 0.0, -0.0, 1.5, rng.random(), None]), None, 1.0 + rng.randint(0, 30) * 2.0**-52) for _ in range(2500)]
    df = spark.createDataFrame(data, "a int, `b c` double, d double, e double, f double, g double").repartition(3)
    shares = [0.0, 0.001, 0.25, 0.5, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, {c: shares for c in ["A", "b c", "d", "e", "f", "g"]}, few, buckets, accuracy)
    for j, c in enumerate(df.columns):
        x = sorted((r[j] for r in data if r[j] is not None), key=lambda v: (math.isnan(v), v))
        for q, v in zip(shares, got["A" if c == "a" else c], strict=True):
            if not x:
                assert v is None
                continue
            lo, hi = x[int(q * (len(x) - 1))], x[min(math.ceil(q * (len(x) - 1)), len(x) - 1)]
            w = q * (len(x) - 1) % 1
            assert _same(v, lo if lo == hi or not w else lo + w * (hi - lo)) or not math.isfinite(hi - lo)
    if few == 1000:
        assert all(_same(a, exact_quantile(df, "e", q)) for q, a in zip(shares, got["e"], strict=True))
    assert exact_quantiles(df.limit(0), {"a": [0.5], "d": []}) == {"a": [None], "d": []}


def test_bins_of_equally_many_values(spark):
    df = spark.range(1000).select("id", (F.col("id") * 37 % 1000).cast("double").alias("v"), F.lit(3).alias("same"))
    df = df.unionByName(spark.createDataFrame([(None, NAN, None), (5000, None, 3)], "id long, v double, same int"))
    got = equal_frequency(df, ["id", "v", "same"], 8)
    assert got.columns == ["id", "v", "same", "id_bin", "v_bin", "same_bin"]
    assert {(r.v_bin, r["count"]) for r in got.groupBy("v_bin").count().collect()} == {(None, 2), *((b, 125) for b in range(1, 9))}
    assert {r.same_bin for r in got.collect()} == {2, None}  # one edge, all values on it
    with pytest.raises(ValueError, match="bins"):
        equal_frequency(df, ["v"], 0)


def test_impute_takes_all_medians_in_one_search(spark):
    df = spark.createDataFrame([(1, None, 2.0), (None, 4.0, 3.0), (4, 8.0, None)], "a int, b double, c double")
    assert {tuple(r) for r in impute(df, {"a": "median", "b": "median", "c": "mean"}).collect()} == {(1, 6.0, 2.0), (3, 4.0, 3.0), (4, 8.0, 2.5)}
