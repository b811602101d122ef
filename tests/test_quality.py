from kempt.operators import quality
from tests.conftest import rows


def test_profile_edge_cases(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, None), (2, None, "x")],
                               "a int, n string, `co-applicant` string")
    p = {r["column"]: r for r in quality.profile(df).collect()}
    assert p["a"]["distinct"] == 2 and p["a"]["nulls"] == 0
    assert p["n"]["distinct"] == 1 and p["n"]["nulls"] == 3 and p["n"]["null_pct"] == 100.0
    assert p["co-applicant"]["distinct"] == 2 and p["co-applicant"]["type"] == "string"
    empty = spark.createDataFrame([], "a int")
    e = quality.profile(empty).collect()
    assert len(e) == 1 and e[0]["rows"] == 0 and e[0]["null_pct"] is None and e[0]["distinct"] == 0


def test_profile_approx_close(spark):
    df = spark.range(5000).selectExpr("id % 1000 AS k")
    p = quality.profile(df, exact=False).collect()[0]
    assert abs(p["distinct"] - 1000) < 100


def test_validate_nulls_not_invalid(spark):
    df = spark.createDataFrame([("2019", "Male"), ("19x", "Other"), (None, None)], "year string, Gender string")
    v = {r["column"]: r for r in quality.validate(df, {"year": r"^\d{4}$"},
                                                   {"Gender": ["Male", "Female"]}).collect()}
    assert v["year"]["invalid_format"] == 1 and v["year"]["invalid_domain"] is None
    assert v["Gender"]["invalid_domain"] == 1 and v["Gender"]["distinct"] == 3


def test_duplicate_stats(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "a"), (2, "a"), (3, "b")], "a int, b string")
    r = quality.duplicate_stats(df).collect()[0]
    assert (r["rows"], r["distinct_rows"], r["duplicate_groups"], r["surplus_rows"]) == (6, 3, 2, 3)


def test_schema_diff(spark):
    df = spark.createDataFrame([("1", 2.0, "x"), ("y", None, "z")], "a string, b double, extra string")
    out = {r["column"]: r for r in quality.schema_diff(df, {"a": "integer", "b": "double", "gone": "int"}).collect()}
    assert out["a"]["status"] == "type" and out["a"]["bad_values"] == 1
    assert out["b"]["status"] == "match" and out["b"]["bad_values"] == 0
    assert out["gone"]["status"] == "missing" and out["extra"]["status"] == "extra"


def test_quality_report(spark):
    df = spark.createDataFrame([("AB", 1.005, "x-y"), ("cd", 2.0, None), ("AB", 1.005, "x-y")],
                               "s string, d double, t string")
    checks = [{"check": "uppercase", "column": "s"}, {"check": "decimal", "column": "d", "scale": 2},
              {"check": "special_chars", "column": "t"}, {"check": "allowed", "column": "s", "values": ["AB"]},
              {"check": "not_null", "column": "t"}, {"check": "duplicates"},
              {"check": "column_count", "expected": 3}, {"check": "row_count", "min": 5}]
    r = {(x["check"], x["column"]): (x["violations"], x["passed"]) for x in quality.quality_report(df, checks).collect()}
    assert r[("uppercase", "s")] == (1, False)
    assert r[("decimal", "d")] == (2, False)
    assert r[("special_chars", "t")] == (2, False)
    assert r[("allowed", "s")] == (1, False)
    assert r[("not_null", "t")] == (1, False)
    assert r[("duplicates", None)] == (1, False)
    assert r[("column_count", None)] == (0, True)
    assert r[("row_count", None)] == (1, False)


def test_orphans_and_fk_report(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (9,), (9,)], "fk int")
    ref = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert rows(quality.orphans(df, "fk", ref, "id")) == [(9,), (9,), (None,)]
    assert rows(quality.orphans(df, "fk", ref, "id", ignore_null=True)) == [(9,), (9,)]
    r = quality.fk_report(df, {"fk": (ref, "id")}).collect()[0]
    assert (r["orphan_rows"], r["orphan_keys"], r["rows"]) == (3, 2, 5)


def test_suggest_spelling(spark):
    df = spark.createDataFrame([("DIRECT",), ("Indriect",), ("zzzzzzzz",), (None,)], "v string")
    out = rows(quality.suggest_spelling(df, "v", ["DIRECT", "INDIRECT"], max_distance=3))
    assert out == [("DIRECT", None, None), ("Indriect", "INDIRECT", 2), ("zzzzzzzz", None, 8), (None, None, None)]


def test_distinct_counts_all_types(spark):
    import datetime as dt
    from decimal import Decimal
    rows_ = [(1, 0.0, "a", dt.datetime(2024, 3, 10, 2, 30), dt.date(2024, 1, 1), Decimal("1.50"), [1, 2], True),
             (1, -0.0, "a", dt.datetime(2024, 3, 10, 3, 30), dt.date(2024, 1, 1), Decimal("1.5"), [1, 2], False),
             (2, float("nan"), None, None, None, None, None, None),
             (2, float("nan"), "b", dt.datetime(2024, 3, 10, 2, 30, 0, 1), dt.date(2024, 1, 2), Decimal("2"), [2], True)]
    df = spark.createDataFrame(rows_, "a int, d double, s string, t timestamp_ntz, dd date, m decimal(10,2), "
                                      "arr array<int>, b boolean")
    got = {r["column"]: r["distinct"] for r in quality.distinct_counts(df).collect()}
    want = {c: df.select(c).distinct().count() for c in df.columns}
    assert got == want


def test_validate_exact_and_approx_agree_on_small_data(spark):
    df = spark.createDataFrame([("2019", "Male"), ("19x", "Other"), (None, None), ("2020", "Male")],
                               "year string, Gender string")
    a = {r["column"]: tuple(r) for r in quality.validate(df, {"year": r"^\d{4}$"}, {"Gender": ["Male"]}).collect()}
    b = {r["column"]: tuple(r) for r in quality.validate(df, {"year": r"^\d{4}$"}, {"Gender": ["Male"]},
                                                         exact=False).collect()}
    assert a == b


def test_validate_rules_per_value_and_per_row_agree(spark):
    import datetime as dt
    df = spark.createDataFrame(
        [("2019", 2019, 1.5, dt.date(2020, 1, 1)), ("19x", 19, -0.0, dt.date(2020, 1, 2)),
         (None, None, None, None), ("2019", 123456, 0.0, dt.date(2020, 1, 1))],
        "s string, n int, d double, t date")
    rules = {"s": r"^\d{4}$", "n": r"^\d{4}$", "d": r"^-", "t": r"-01$"}
    doms = {"s": ["2019"], "n": [2019]}
    got = {r["column"]: (r["invalid_format"], r["invalid_domain"], r["nulls"], r["distinct"])
           for r in quality.validate(df, rules, doms).collect()}
    for c, rx in rules.items():
        want_fmt = df.filter(~df[c].cast("string").rlike(rx)).count()
        want_dom = df.filter(~df[c].isin(doms[c])).count() if c in doms else None
        assert got[c][:2] == (want_fmt, want_dom), c
    assert got["d"][3] == 3  # 0.0 and -0.0 are one value


def test_distinct_counts_binary(spark):
    df = spark.createDataFrame([(bytearray(b"\xff"),), (bytearray(b"\xfe"),), (bytearray(b"\xff"),), (None,)], "b binary")
    assert quality.distinct_counts(df).collect()[0]["distinct"] == 3
    assert quality.profile(df).collect()[0]["distinct"] == 3
