import math

import pytest
from pyspark.sql import functions as F

from kempt.operators import cleanse
from tests.conftest import rows


def test_blank_to_null_strings_only(spark):
    df = spark.createDataFrame([("", 1), ("  ", 2), (None, 3), ("a", 4)], "s string, n int")
    out = rows(cleanse.blank_to_null(df))
    assert out == [("  ", 2), ("a", 4), (None, 1), (None, 3)]
    out = rows(cleanse.blank_to_null(df, trim=True))
    assert out == [("a", 4), (None, 1), (None, 2), (None, 3)]
    assert cleanse.blank_to_null(df).schema == df.schema


def test_blank_to_null_idempotent(spark):
    df = spark.createDataFrame([("", "x"), (" ", None)], "a string, b string")
    once = cleanse.blank_to_null(df, trim=True)
    assert rows(once) == rows(cleanse.blank_to_null(once, trim=True))


def test_drop_incomplete_threshold(spark):
    df = spark.createDataFrame([(1, None, None), (1, 2, None), (1, 2, 3)], "a int, b int, c int")
    assert len(rows(cleanse.drop_incomplete(df, 2))) == 2
    assert rows(cleanse.drop_incomplete(df, 3)) == [(1, 2, 3)]
    assert len(rows(cleanse.drop_incomplete(df, 1))) == 3


def test_strip_special(spark):
    df = spark.createDataFrame([("a-b_c!", "é", "x\ty", "1.5", -0.5)],
                               "`co-applicant` string, e string, t string, n string, d double")
    out = cleanse.strip_special(df).collect()[0]
    assert tuple(out) == ("abc", "", "x\ty", "1.5", -0.5)
    again = cleanse.strip_special(cleanse.strip_special(df))
    assert rows(again) == rows(cleanse.strip_special(df))
    ex = cleanse.strip_special(df, exclude=["co-applicant"]).collect()[0]
    assert ex[0] == "a-b_c!"


def test_map_values_no_cascade(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "v string")
    out = rows(cleanse.map_values(df, {"v": {"a": "b", "b": "c"}}))
    assert out == [("b",), ("c",), ("z",), (None,)]


def test_map_values_large_map_joins(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "v int")
    big = {i: i + 100 for i in range(5000)}
    out = rows(cleanse.map_values(df, {"v": big}))
    assert out == [(i + 100,) for i in range(10)]


def test_map_values_table(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n int")
    m = spark.createDataFrame([("x", "X"), ("x", "X")], "from string, to string")
    assert rows(cleanse.map_values(df, table=m, column="k")) == [("X", 1), ("y", 2)]


def test_cast_cols(spark):
    df = spark.createDataFrame([("x",), ("",), ("2019",), (None,)], "v string")
    assert rows(cleanse.cast_cols(df, {"v": "int"})) == [(2019,), (None,), (None,), (None,)]
    with pytest.raises(Exception):
        cleanse.cast_cols(df, {"v": "int"}, on_error="fail").collect()


def test_parse_dates(spark):
    import datetime as dt
    df = spark.createDataFrame([("x",), ("",), ("2019",), (None,), ("03/04/2020",)], "v string")
    out = rows(cleanse.parse_dates(df, {"v": ["yyyy", "dd/MM/yyyy"]}))
    assert out == [(dt.date(2019, 1, 1),), (dt.date(2020, 4, 3),), (None,), (None,), (None,)]


def test_round_cols_half_up(spark):
    df = spark.createDataFrame([(2083.095, 7), (0.125, 8), (-0.125, 9)], "d double, i int")
    out = rows(cleanse.round_cols(df, ["d", "i"], 2))
    assert out == [(-0.13, 9), (0.13, 8), (2083.1, 7)]


def test_round_to_int(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (1e12,), (None,)], "d double")
    assert rows(cleanse.round_to_int(df, ["d"])) == [(-3,), (3,), (None,), (None,)]


def test_trim_upper_idempotent(spark):
    df = spark.createDataFrame([("  ab ", "ß"), (None, "x")], "a string, b string")
    t1 = cleanse.trim_strings(df)
    assert rows(t1) == rows(cleanse.trim_strings(t1))
    u1 = cleanse.upper_strings(df)
    assert rows(u1) == rows(cleanse.upper_strings(u1))


def test_dedupe_latest_and_hot_key(spark):
    data = [(1, i, f"v{i}") for i in range(300)] + [(2, 5, "a"), (2, 5, "b"), (3, 1, None)]
    df = spark.createDataFrame(data, "k int, ts int, v string")
    out = rows(cleanse.dedupe(df, ["k"], ["ts", "v"], keep="latest"))
    assert out == [(1, 299, "v299"), (2, 5, "b"), (3, 1, None)]
    first = rows(cleanse.dedupe(df, ["k"], ["ts", "v"], keep="earliest"))
    assert first == [(1, 0, "v0"), (2, 5, "a"), (3, 1, None)]


def test_dedupe_whole_row_idempotent(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    d = cleanse.dedupe(df)
    assert d.count() == 2
    assert rows(cleanse.dedupe(d)) == rows(d)


def test_reencode_ascii(spark):
    df = spark.createDataFrame([("héllo",), ("ok",), (None,)], "s string")
    assert rows(cleanse.reencode(df, charset="US-ASCII")) == [("h?llo",), ("ok",), (None,)]
    assert rows(cleanse.reencode(df, charset="UTF-8")) == rows(df)


def test_drop_cols_ignores_absent(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert cleanse.drop_cols(df, ["B", "zz"]).columns == ["a"]


def test_convert_unit(spark):
    df = spark.createDataFrame([(100.0,), (None,)], "x double")
    assert rows(cleanse.convert_unit(df, "x", 0.012, out="y"), "y") == [(1.2,), (None,)]


def test_round_keeps_what_is_there(spark):
    vals = [1.23456789012, 0.1249996, 0.125, -0.125, float("nan"), float("inf"), 1e33, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    r8 = {r["i"]: r["x"] for r in cleanse.round_cols(df, ["x"], 8).collect()}
    assert r8[0] == 1.23456789 and r8[5] == float("inf") and r8[4] != r8[4] and r8[6] == 1e33 and r8[7] is None
    r2 = {r["i"]: r["x"] for r in cleanse.round_cols(df, ["x"], 2).collect()}
    assert (r2[1], r2[2], r2[3]) == (0.12, 0.13, -0.13)
    whole = {r["i"]: r["x"] for r in cleanse.round_to_int(df, ["x"]).collect()}
    assert whole == {0: 1, 1: 0, 2: 0, 3: 0, 4: None, 5: None, 6: None, 7: None}


def test_map_values_to_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert rows(cleanse.map_values(df, {"x": {"a": None}})) == rows(df.replace({"a": None}, subset=["x"]))
    table = spark.createDataFrame([("a", None)], "`from` string, `to` string")
    assert rows(cleanse.map_values(df, table=table, column="x")) == rows(df.replace({"a": None}, subset=["x"]))


def test_drop_incomplete_is_dropna(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (None, None)], "x double, s string")
    assert rows(cleanse.drop_incomplete(df, 2)) == rows(df.dropna(thresh=2)) == [(1.0, "a")]


def test_reencode_other_names(spark):
    df = spark.createDataFrame([("aé漢",)], "s string")
    assert rows(cleanse.reencode(df, charset="ASCII")) == [("a??",)]
    assert rows(cleanse.reencode(df, charset="latin1")) == [("aé?",)]
