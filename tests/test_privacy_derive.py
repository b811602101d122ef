import hashlib

from kempt.operators import derive, privacy
from tests.conftest import rows


def test_hash_cols(spark):
    df = spark.createDataFrame([(1, "a"), (None, "")], "id int, s string")
    out = rows(privacy.hash_cols(df, ["id", "s"]))
    h = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert out == sorted([(h("1"), h("a")), (None, h(""))], key=lambda r: tuple((x is None, str(x)) for x in r))


def test_redact_modes(spark):
    df = spark.createDataFrame([("abcdef",), ("ab",), ("",), (None,)], "s string")
    assert rows(privacy.redact(df, ["s"])) == [("REDACTED",), ("REDACTED",), ("REDACTED",), (None,)]
    assert privacy.redact(df, ["s"], mode="add").columns == ["s", "s_Redacted"]
    assert rows(privacy.redact(df, ["s"], mode="mask", keep_last=2)) == [("",), ("**",), ("****ef",), (None,)]


def test_parse_address(spark):
    df = spark.createDataFrame([("1 Main St, Springfield, 12345",), ("Elm, Shelby",), ("nowhere",), (None,)], "a string")
    out = rows(derive.parse_address(df, "a"), "street", "city", "postal_code")
    assert out == [("1 Main St", "Springfield", "12345"), ("Elm", "Shelby", None), ("nowhere", None, None),
                   (None, None, None)]


def test_bin_col_edges(spark):
    vals = [-1, 0, 9, 10, 29, 30, 31, None]
    df = spark.createDataFrame([(v,) for v in vals], "x int")
    out = derive.bin_col(df, "x", [0, 10, 20, 30], ["low", "middle", "high"])
    got = {r["x"]: r["x_bins"] for r in out.collect()}
    assert got == {-1: "Unknown", 0: "low", 9: "low", 10: "middle", 29: "high", 30: "high", 31: "Unknown", None: "Unknown"}


def test_concat_and_encode(spark):
    df = spark.createDataFrame([("a", None), ("b", "c")], "x string, y string")
    assert rows(derive.concat_cols(df, ["x", "y"], "z", "-", null_safe=True), "z") == [("a",), ("b-c",)]
    assert rows(derive.concat_cols(df, ["x", "y"], "z", "-", null_safe=False), "z") == [("b-c",), (None,)]
    e = derive.encode_map(df, {"x": {"a": 7}})
    assert rows(e, "x_encoded_7") == [(0,), (7,)]
    assert rows(derive.one_hot(df, "x", ["a"]), "x_a") == [(0,), (1,)]


def test_age_extract_json(spark):
    df = spark.createDataFrame([("55-64", '{"k": 3}'), ("x", "bad")], "b string, j string")
    assert rows(derive.age_from_bracket(df, "b", "2024-01-01"), "Age") == [(1969,), (None,)]
    assert rows(derive.json_fields(df, "j", {"k": "$.k"}), "k") == [("3",), (None,)]
    assert rows(derive.extract_pattern(df, {"b": (r"(\d+)-(\d+)", ["lo", "hi"])}), "lo", "hi") == \
        [("", ""), ("55", "64")]


def test_derive_sql_text(spark):
    df = spark.createDataFrame([(2, 3)], "credit_score int, income int")
    out = derive.derive(df, {"risk_score": "credit_score * income", "income": "income / 2"})
    assert out.collect()[0].asDict() == {"credit_score": 2, "income": 1.5, "risk_score": 6}


def test_extract_all(spark):
    df = spark.createDataFrame([("a1b22c333",), (None,)], "s string")
    out = derive.extract_all(df, "s", r"(\d+)", "nums", group=1).collect()
    assert sorted([r["nums"] for r in out], key=str) == [None, ["1", "22", "333"]]


def test_agg_timeframe_keeps_ntz(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), 1.0), (dt.datetime(2024, 1, 1, 23), 2.0),
                                (dt.datetime(2024, 1, 2, 0), 4.0)], "ts timestamp_ntz, v double")
    out = derive.agg_timeframe(df, "ts", "day", aggs={"n": ("count", "*"), "s": ("sum", "v")})
    assert out.schema["period"].dataType.simpleString() == "timestamp_ntz"
    assert rows(out) == [(dt.datetime(2024, 1, 1), 2, 3.0), (dt.datetime(2024, 1, 2), 1, 4.0)]


def test_one_hot_null_is_zero(spark):
    df = spark.createDataFrame([("a",), (None,)], "v string")
    assert rows(derive.one_hot(df, "v", ["a"]), "v_a") == [(0,), (1,)]


def test_label_index_frequency_then_label(spark):
    vals = ["b"] * 3 + ["a"] * 3 + ["c"] * 5 + ["d"] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "v string").repartition(3)
    got = {r["v"]: r["v_index"] for r in derive.label_index(df, "v").collect()}
    assert got == {"c": 0, "a": 1, "b": 2, "d": 3, None: None}


def test_label_index_many_labels_across_partitions(spark):
    df = spark.range(3000).selectExpr("CAST(id % 997 AS STRING) AS v")
    out = derive.label_index(df, "v").select("v", "v_index").distinct().collect()
    idx = sorted(r["v_index"] for r in out)
    assert idx == list(range(997))
    by = {r["v"]: r["v_index"] for r in out}
    # labels 0..8 occur 4 times (3000 = 3*997 + 9), the rest 3 times; ties by label text
    assert by["0"] == 0 and by["8"] == 8 and by["10"] == 9


def test_encode_map_shared_code(spark):
    """Two values with one code share the column."""
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "x string")
    out = derive.encode_map(df, {"x": {"a": 1, "b": 1, "c": 2}})
    assert rows(out, "x", "x_encoded_1", "x_encoded_2") == [("a", 1, 0), ("b", 1, 0), ("c", 0, 2), (None, 0, 0)]
