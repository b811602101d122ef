"""What a task holds or reads, and what passes the driver, must not grow faster than a query's input."""

from pyspark.sql import functions as F

from kempt.operators import relate
from kempt.plans import queries


def test_four_files_are_written_without_a_shuffle_of_rows(spark, tmp, monkeypatch):
    spark.range(1000).select(F.col("id").alias("l_orderkey"), (F.col("id") / 7).alias("l_tax")).repartition(3).write.parquet(f"{tmp}/lineitem.parquet")

    def shuffled(self, *a):
        raise AssertionError("rows are shuffled")
    monkeypatch.setattr(type(spark.range(0)), "repartition", shuffled)
    assert [tuple(r) for r in queries.QUERIES["file_stats"](spark, tmp).collect()] == [(4, 1000, True)]


def test_an_empty_table_has_no_rows(spark, tmp):
    spark.range(0).select(F.col("id").alias("l_orderkey")).write.parquet(f"{tmp}/lineitem.parquet")
    assert [tuple(r)[:2] for r in queries.QUERIES["file_stats"](spark, tmp).collect()] == [(0, None)]


def test_reconcile_groups_once_and_sorts_nothing(spark):
    left = spark.range(50).select(F.col("id").alias("k"), F.col("id").cast("double").alias("v"))
    right = left.filter("k > 4").withColumn("v", F.col("v") + (F.col("k") % 2)).union(spark.createDataFrame([(60, 1.0), (7, 2.0)], "k long, v double"))
    got = relate.reconcile(left, right, ["k"], ["v"])
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2
    counts = {r.status: r.n for r in got.groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert counts == {"left_only": 5, "right_only": 1, "duplicate_key": 1, "matched": 22, "changed": 22}
    assert [tuple(r) for r in got.filter("k in (0, 7, 60)").orderBy("k").collect()] == [
        (0, "left_only", 1, 0, 0.0, None), (7, "duplicate_key", 1, 2, 7.0, 2.0), (60, "right_only", 0, 1, None, 1.0)]


def test_many_groups_are_not_sent_through_the_driver(spark):
    from kempt.operators import anonymize
    few, many = anonymize._held(spark.range(9), 9), anonymize._held(spark.range(9), anonymize._FEW + 1)
    assert "BroadcastHashJoin" in spark.range(9).join(few, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in spark.range(9).join(many, "id")._jdf.queryExecution().executedPlan().toString()
    rows = spark.range(90).select("id", (F.col("id") % 9).alias("q"))
    plan = anonymize.k_anonymous(rows, ["q"], 20)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan


def test_groups_are_the_same_when_tables_are_shuffled(spark, monkeypatch):
    from kempt.operators import anonymize
    rows = spark.range(600).select("id", (F.col("id") % 9).alias("q"), F.when(F.col("id") % 4 > 0, F.col("id") * 7 % 101).alias("r"))
    sent = sorted(map(str, anonymize.k_anonymous(rows, ["q", "r"], 40).collect()))
    monkeypatch.setattr(anonymize, "_FEW", 0)
    assert sorted(map(str, anonymize.k_anonymous(rows, ["q", "r"], 40).collect())) == sent


def test_pairs_of_columns_and_values_are_unpivoted(spark):
    from kempt.operators import quality
    df = spark.createDataFrame([(1, "a", 0.0, 5), (1, None, -0.0, None), (None, "b", 2.0, None)], "n int, t string, d double, m long")
    df = df.select(F.monotonically_increasing_id().alias("id"), "*")  # never null, unlike those behind it
    got = quality.validate(df, {"t": "a"}, {"n": [2]})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and "Generate" not in plan
    assert sorted(tuple(r) for r in got.collect()) == [
        ("d", "double", 0, 2, None, None), ("id", "bigint", 0, 3, None, None), ("m", "bigint", 2, 2, None, None),
        ("n", "int", 1, 2, None, 2), ("t", "string", 1, 3, 1, None)]
    pairs = quality._pairs(df, df.columns)
    assert pairs.filter("a IS NULL").count() == 4 and pairs.filter("a IS NOT NULL").count() == 11
