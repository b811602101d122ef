import pytest
from pyspark.sql import functions as F

from kempt.operators import relate
from tests.conftest import rows


def test_reconcile_statuses(spark):
    left = spark.createDataFrame([(1, 10.0), (2, 5.0), (3, None), (4, 1.0), (6, 1.0), (6, 2.0)], "k int, v double")
    right = spark.createDataFrame([(1, 10.0), (2, 6.0), (3, 1.0), (5, 1.0), (6, 1.0)], "k int, v double")
    out = {r["k"]: r["status"] for r in relate.reconcile(left, right, ["k"], ["v"]).collect()}
    assert out == {1: "matched", 2: "changed", 3: "changed", 4: "left_only", 5: "right_only", 6: "duplicate_key"}


def test_reconcile_cols(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (None, 1.0), (None, None)], "a double, b double")
    assert rows(relate.reconcile_cols(df, "a", "b")) == [(1.0, 2.0), (None, 1.0)]


def test_merge_salted_equals_plain(spark):
    big = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)], "k int, v int")
    small = spark.createDataFrame([(1, "one"), (3, "three")], "k int, name string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(relate.merge(big, small, "k", how)) == rows(relate.merge(big, small, "k", how, salt_buckets=5))
    with pytest.raises(ValueError):
        relate.merge(big, small, "k", "cross")


def test_split_by_adds_up(spark):
    df = spark.createDataFrame([(i % 3,) for i in range(30)], "s int")
    parts = relate.split_by(df, "s", [0, 1, 2])
    assert sum(p.count() for p in parts.values()) == 30


def test_pivot_and_to_long(spark):
    df = spark.createDataFrame([("n", "t1", 1), ("n", "t2", 2), ("s", "t1", 3)], "r string, t string, a int")
    p = relate.pivot_table(df, "r", "t", "a", values=["t1", "t2"])
    assert rows(p) == [("n", 1, 2), ("s", 3, None)]
    longer = relate.to_long(df, ["r"], ["a"])
    assert longer.columns == ["r", "column", "value"]


def test_transpose_guard(spark):
    df = spark.createDataFrame([("a", 1, 2), ("b", 3, 4)], "k string, x int, y int")
    out = rows(relate.transpose(df, "k"))
    assert out == [("x", "1", "3"), ("y", "2", "4")]
    with pytest.raises(ValueError):
        relate.transpose(df, "k", max_rows=1)
    dup = spark.createDataFrame([("a", 1), ("a", 2)], "k string, x int")
    with pytest.raises(ValueError):
        relate.transpose(dup, "k")


def test_hash_sample_repeatable(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = rows(relate.hash_sample(df, "k", 0.25))
    b = rows(relate.hash_sample(df.repartition(7), "k", 0.25))
    assert a == b and 350 < len(a) < 650
    st = relate.stratified_sample(df.withColumn("g", F.col("k") % 2), "g", {0: 1.0}, "k")
    assert st.count() == 1000


def test_top_k_and_sort(spark):
    df = spark.createDataFrame([(3,), (1,), (None,), (2,)], "x int")
    assert [r[0] for r in relate.top_k(df, 2, [("x", False)]).collect()] == [3, 2]
    assert [r[0] for r in relate.sort_by(df, [("x", True, False)]).collect()] == [1, 2, 3, None]


def test_locate(spark):
    df = spark.createDataFrame([(" paris ",), ("Nowhere",)], "city string")
    gaz = spark.createDataFrame([("Paris", 48.8, 2.3), ("PARIS", 48.9, 2.4)], "place string, lat double, lon double")
    out = rows(relate.locate(df, ["city"], gaz))
    assert out == [(" paris ", 48.8, 2.3, True), ("Nowhere", None, None, False)]


def test_aggregate(spark):
    df = spark.createDataFrame([("M", 10), ("M", 20), ("F", 5)], "Gender string, loan_amount int")
    out = relate.aggregate(df, ["Gender"], {"Mean_Loan_Amount": ("mean", "loan_amount"), "n": ("count", "*")})
    assert rows(out) == [("F", 5.0, 1), ("M", 15.0, 2)]


def test_split_random_is_a_partition(spark):
    df = spark.range(500)
    parts = relate.split_random(df, [0.7, 0.3], seed=1)
    ids = [r.id for p in parts for r in p.collect()]
    assert sorted(ids) == list(range(500))


def test_merge_kinds(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, l string")
    right = spark.createDataFrame([(2, "x"), (3, "y")], "k int, r string")
    assert rows(relate.merge(left, right, "k", "right")) == [(2, "b", "x"), (3, None, "y")]
    assert rows(relate.merge(left, right, "k", "full")) == [(1, "a", None), (2, "b", "x"), (3, None, "y")]
    assert rows(relate.merge(left, right, "k", "inner", broadcast=True)) == [(2, "b", "x")]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salting_identical_hot_rows(spark, how):
    left = spark.createDataFrame([(1, "x")] * 300 + [(k, "y") for k in range(40)] + [(None, "z")], "k int, a string")
    right = spark.createDataFrame([(1, "r1"), (1, "r2"), (5, "r5"), (99, "r99"), (None, "rn")], "k int, b string")
    assert rows(relate.merge(left, right, "k", how, salt_buckets=4)) == rows(left.join(right, "k", how))


def test_salts_spread_identical_rows(spark):
    left = spark.createDataFrame([(1,)] * 1000, "k int").repartition(4)
    plan = relate.merge(left, spark.createDataFrame([(1, "r")], "k int, b string"), "k", salt_buckets=8)
    assert plan.count() == 1000


def test_full_join_on_names_equals_full_join(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "k int, a string")
    right = spark.createDataFrame([(1, "x"), (3, "y"), (None, "m")], "k int, b string")
    assert rows(relate.merge(left, right, "k", "full"), "k", "a", "b") == rows(left.join(right, "k", "full"), "k", "a", "b")


def window_rows(node, below=False):
    """Rows written by the shuffles right below the windows of an executed plan."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return window_rows(node.executedPlan(), below)
    if "QueryStage" in name:
        return window_rows(node.plan(), below)
    if below and name == "Exchange":
        found = node.metrics().get("shuffleRecordsWritten").get().value()
        return found + window_rows(node.child(), False)
    kids = node.children()
    return sum(window_rows(kids.apply(i), below or name == "Window") for i in range(kids.size()))


def test_group_median_ranks_only_the_middle(spark):
    n = 40000
    df = spark.range(n).selectExpr("CASE WHEN id % 2 = 0 THEN 'a' WHEN id % 1000 = 1 THEN NULL ELSE 'b' END AS g",
                                   "pow(pmod(hash(id), 100003) + id / 100000, 3) AS x").repartition(3)
    df = df.union(spark.createDataFrame([("n", float("nan")), ("n", 1.0), ("i", float("inf")), ("i", float("-inf")), ("i", 2.0)], "g string, x double"))
    for by in (["g"], []):
        out = relate.aggregate(df, by, {"m": ("median", "x")})
        want = df.groupBy(*by).agg(F.median("x").alias("m"))
        assert [str(r) for r in rows(out)] == [str(r) for r in rows(want)]
        assert 0 < window_rows(out._jdf.queryExecution().executedPlan()) < n / 100


def test_group_median(spark):
    data = [("a", 1.0), ("a", 2.0), ("a", 10.0), ("b", 4.0), ("b", 8.0), ("c", None), (None, 7.0)]
    df = spark.createDataFrame(data, "g string, x double")
    got = rows(relate.aggregate(df, ["g"], {"m": ("median", "x"), "n": ("count", "*")}), "g", "m", "n")
    assert got == rows(df.selectExpr("g", "x").groupBy("g").agg(F.median("x").alias("m"), F.count("*").alias("n")), "g", "m", "n")
    assert rows(relate.aggregate(df, [], {"m": ("median", "x")})) == [(5.5,)]
    p = relate.pivot_table(df.withColumn("one", F.lit(1)), "one", "g", "x", "median", values=["a", "b"])
    assert rows(p, "a", "b") == [(2.0, 6.0)]
