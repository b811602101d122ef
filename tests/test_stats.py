import pytest
from pyspark.sql import functions as F

from kempt.operators import stats
from tests.conftest import rows


def _values():
    return [float(x) for x in range(20)] + [1000.0, -1000.0, None]


def test_winsorize_clamp_both_tails(spark):
    df = spark.createDataFrame([(v,) for v in _values()], "x double")
    st = stats.fit_moments(df, ["x"])["x"]
    hi = st["mean"] + 1.5 * st["sd"]
    lo = st["mean"] - 1.5 * st["sd"]
    out = [r[0] for r in stats.winsorize(df, ["x"], 1.5, stats={"x": st}).collect()]
    assert None in out
    vals = [v for v in out if v is not None]
    assert max(vals) == pytest.approx(hi) and min(vals) == pytest.approx(lo)
    assert all(lo - 1e-9 <= v <= hi + 1e-9 for v in vals)


def test_winsorize_reference_mode_upper_fence(spark):
    df = spark.createDataFrame([(v,) for v in _values()], "x double")
    st = stats.fit_moments(df, ["x"])["x"]
    out = [r[0] for r in stats.winsorize(df, ["x"], 1.5, mode="reference").collect() if r[0] is not None]
    assert out.count(pytest.approx(st["mean"] + 1.5 * st["sd"])) == 2


def test_winsorize_constant_and_single(spark):
    const = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert rows(stats.winsorize(const, ["x"])) == [(5.0,), (5.0,)]
    single = spark.createDataFrame([(7,)], "x int")
    assert rows(stats.winsorize(single, ["x"])) == [(7.0,)]


def test_min_max_edge_cases(spark):
    df = spark.createDataFrame([(1.0, 3.0, None), (3.0, 3.0, None), (2.0, 3.0, None)], "a double, c double, n double")
    out = rows(stats.min_max(df, ["a", "c", "n"]), "a_normalized", "c_normalized", "n_normalized")
    assert out == [(0.0, None, None), (0.5, None, None), (1.0, None, None)]
    empty = spark.createDataFrame([], "a double")
    assert stats.min_max(empty, ["a"]).count() == 0


def test_min_max_keep_and_in_place(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0)], "id int, v double")
    assert stats.min_max(df, ["v"], keep=["id"]).columns == ["id", "v_normalized"]
    assert rows(stats.min_max(df, ["v"], suffix="")) == [(1, 0.0), (2, 1.0)]


def test_standardize(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    out = [r[0] for r in stats.standardize(df, ["x"]).collect()]
    assert sorted(v for v in out if v is not None) == [-1.0, 0.0, 1.0]
    const = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert rows(stats.standardize(const, ["x"])) == [(None,), (None,)]


def test_impute(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (None, 2.0, None), (4, None, "b"), (2, 6.0, "b")],
                               "i int, d double, s string")
    out = stats.impute(df, {"i": "mean", "d": "median", "s": "mode"})
    assert rows(out) == [(1, 1.0, "a"), (2, 2.0, "b"), (2, 6.0, "b"), (4, 2.0, "b")]
    with pytest.raises(TypeError):
        stats.impute(df, {"i": "NA"})
    assert rows(stats.impute(df, {"s": "NA"}), "s") == [("NA",), ("a",), ("b",), ("b",)]


def test_describe_cols_typed(spark):
    df = spark.createDataFrame([(1, 2.0), (3, 4.0)], "a int, b double")
    out = stats.describe_cols(df, ["a", "b"])
    assert [f.dataType.simpleString() for f in out.schema.fields] == \
        ["string", "bigint", "double", "double", "double", "double"]
    r = {x["column"]: x for x in out.collect()}
    assert r["a"]["mean"] == 2.0 and r["b"]["max"] == 4.0 and r["a"]["count"] == 2


def test_drop_sparse_nulls(spark):
    # 200 rows: a 0 % null, b 0.5 % (1 row), c exactly 1 % (2 rows), d 50 %
    data = []
    for i in range(200):
        data.append((i, None if i == 0 else i, None if i in (1, 2) else i, None if i % 2 else i))
    df = spark.createDataFrame(data, "a int, b int, c int, d int")
    shares = stats.fit_null_shares(df)
    assert shares == {"a": 0.0, "b": 0.5, "c": 1.0, "d": 50.0}
    out = stats.drop_sparse_nulls(df, 1.0)
    assert out.count() == 199


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_quantile_matches_percentile(spark, q):
    import random
    rnd = random.Random(3)
    vals = [float(rnd.randint(0, 50)) for _ in range(701)] + [None] * 5 + [1e9] * 3
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    want = df.agg(F.percentile("x", q)).collect()[0][0]
    # tiny bracket limit forces the histogram refinement loop
    assert stats.exact_quantile(df, "x", q, max_bracket_rows=10, buckets=4) == pytest.approx(want)
    assert stats.exact_quantile(df, "x", q) == pytest.approx(want)


def test_exact_quantile_even_and_empty(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "x double")
    assert stats.exact_quantile(df, "x") == 3.0
    assert stats.exact_quantile(spark.createDataFrame([(None,)], "x double"), "x") is None


def test_exact_mode(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,), (None,), (None,)], "v string")
    assert stats.exact_mode(df, "v") == "a"


@pytest.mark.parametrize("zeros,ones", [(20, 20), (20, 21), (1, 40)])
def test_exact_quantile_ends_between_heavy_values(spark, zeros, ones):
    df = spark.createDataFrame([(0.0,)] * zeros + [(1.0,)] * ones, "x double")
    vals = [0.0] * zeros + [1.0] * ones
    n = len(vals)
    assert stats.exact_quantile(df, "x", max_bracket_rows=10) == (vals[(n - 1) // 2] + vals[n // 2]) / 2


@pytest.mark.parametrize("vals", [[1.0, 1.0000000000000002] * 10, [-1.7e308, 1.7e308] * 10, [5e-324, 0.0, 1e-323] * 8,
                                  [float("-inf")] * 5 + [1.0, 2.0, 3.0] + [float("inf")] * 4, [1e17 + 16 * i for i in range(40)]])
def test_exact_quantile_extremes(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    s = sorted(vals)
    for q in (0.0, 0.5, 1.0):
        k = int(q * (len(s) - 1))
        if q * (len(s) - 1) == k:
            assert stats.exact_quantile(df, "x", q, max_bracket_rows=3, buckets=4) == s[k]
    got = stats.exact_quantile(df, "x", 0.5, max_bracket_rows=3, buckets=4)
    assert s[(len(s) - 1) // 2] <= got <= s[len(s) // 2]


def test_describe_text_and_large_integers(spark):
    df = spark.createDataFrame([("b", 9007199254740993), ("a", 9007199254740995), (None, None)], "s string, n bigint")
    out = {r["column"]: r for r in stats.describe_cols(df, ["s", "n"]).collect()}
    assert (out["s"]["count"], out["s"]["min_text"], out["s"]["max_text"], out["s"]["mean"]) == (2, "a", "b", None)
    assert (out["n"]["min_text"], out["n"]["max_text"]) == ("9007199254740993", "9007199254740995")
