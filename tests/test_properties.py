"""Properties from the survey's test plan, on generated frames, against brute force in Python."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kempt.operators import cleanse, quality, relate, stats
from kempt.sources import tables
from tests.conftest import rows

SET = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
text = st.one_of(st.none(), st.sampled_from(["", " ", " a", "b ", "a-b", "Ä!", "x\ty", "1.5", "ß"]))
num = st.one_of(st.none(), st.floats(min_value=-1e6, max_value=1e6, allow_nan=False).map(lambda v: round(v, 3)))
small_rows = st.lists(st.tuples(st.integers(0, 5), text, num), min_size=0, max_size=25)
SCHEMA = "k int, s string, x double"


@SET
@given(small_rows)
def test_string_cleaners_idempotent(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    for op in (cleanse.trim_strings, cleanse.upper_strings, cleanse.strip_special,
               lambda d: cleanse.blank_to_null(d, trim=True), cleanse.dedupe):
        once = op(df)
        assert rows(op(once)) == rows(once)


@SET
@given(small_rows)
def test_dedupe_matches_set(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    # grouping treats -0.0 and 0.0 as one value and returns 0.0, as Python's set treats them as equal
    norm = {(k, s, 0.0 if x == 0 else x) for k, s, x in data}
    assert rows(cleanse.dedupe(df)) == sorted(norm, key=lambda r: tuple((x is None, str(x)) for x in r))


@SET
@given(small_rows, st.integers(0, 3))
def test_drop_incomplete_brute_force(spark, data, n):
    df = spark.createDataFrame(data, SCHEMA)
    want = [r for r in data if sum(v is not None for v in r) >= n]
    assert rows(cleanse.drop_incomplete(df, n)) == rows(spark.createDataFrame(want, SCHEMA))


@SET
@given(small_rows)
def test_min_max_in_unit_interval(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    for (v,) in stats.min_max(df, ["x"]).select("x_normalized").collect():
        assert v is None or -1e-12 <= v <= 1 + 1e-12


@SET
@given(small_rows, st.floats(0.5, 3.0))
def test_winsorize_within_input_fences(spark, data, t):
    df = spark.createDataFrame(data, SCHEMA)
    fit = stats.fit_moments(df, ["x"])["x"]
    out = [r[0] for r in stats.winsorize(df, ["x"], t, stats={"x": fit}).select("x").collect()]
    assert sum(v is None for v in out) == sum(r[2] is None for r in data)
    if fit["sd"]:
        lo, hi = fit["mean"] - t * fit["sd"], fit["mean"] + t * fit["sd"]
        assert all(lo - 1e-6 <= v <= hi + 1e-6 for v in out if v is not None)


@SET
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(0, 3), st.sampled_from(["a", "b", "c"])), max_size=20),
       st.lists(st.tuples(st.integers(0, 8), st.integers(0, 3), st.sampled_from(["x", "y"])), max_size=20))
def test_upsert_twice_is_once_and_latest_wins(spark, existing, incoming):
    unique_existing = list({k: (k, v, s) for k, v, s in existing}.values())  # existing keys are unique
    ex = spark.createDataFrame(unique_existing, "k int, v int, s string")
    inc = spark.createDataFrame(incoming, "k int, v int, s string")
    once = tables.upsert(ex, inc, ["k"], ["v", "s"])
    twice = tables.upsert(once, inc, ["k"], ["v", "s"])
    assert rows(once) == rows(twice)
    latest = {}
    for k, v, s in incoming:
        if k not in latest or (v, s) > latest[k][1:]:
            latest[k] = (k, v, s)
    base = {r[0]: r for r in ex.collect()}
    base.update(latest)
    assert rows(once) == sorted(base.values(), key=lambda r: tuple((x is None, str(x)) for x in r))


@SET
@given(small_rows, st.floats(0.0, 1.0))
def test_hash_sample_and_complement_partition_the_rows(spark, data, f):
    df = spark.createDataFrame(data, SCHEMA)
    inside = relate.hash_sample(df, "k", f)
    outside = df.join(inside.select("k").distinct(), "k", "left_anti")
    assert inside.count() + outside.count() == len(data)


@SET
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float)), min_size=1, max_size=40),
       st.sampled_from([0.0, 0.1, 0.5, 0.75, 1.0]))
def test_exact_quantile_brute_force(spark, vals, q):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    xs = sorted(v for v in vals if v is not None)
    got = stats.exact_quantile(df, "x", q, max_bracket_rows=3, buckets=3)
    if not xs:
        assert got is None
        return
    pos = q * (len(xs) - 1)
    lo, hi = math.floor(pos), math.ceil(pos)
    assert math.isclose(got, xs[lo] + (pos - lo) * (xs[hi] - xs[lo]), abs_tol=1e-9)


@SET
@given(small_rows)
def test_profile_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    p = {r["column"]: r for r in quality.profile(df).collect()}
    for i, c in enumerate(["k", "s", "x"]):
        col_vals = [r[i] for r in data]
        assert p[c]["rows"] == len(data)
        assert p[c]["nulls"] == sum(v is None for v in col_vals)
        assert p[c]["distinct"] == len(set(col_vals))


@SET
@given(st.lists(st.sampled_from(["a", "b", "c", None]), max_size=20))
def test_map_values_is_one_lookup(spark, vals):
    m = {"a": "b", "b": "c"}
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    want = [(m.get(v, v) if v is not None else None,) for v in vals]
    assert rows(cleanse.map_values(df, {"v": m})) == rows(spark.createDataFrame(want, "v string"))
