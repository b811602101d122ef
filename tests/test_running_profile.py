"""Summaries stored by batch against profiles of the whole table."""

import math

import pytest
from pyspark.sql import functions as F

from kempt.operators.quality import profile
from kempt.streaming.ingest import ingest_stream
from kempt.streaming.running import running_profile, store_summary

NAN, INF = float("nan"), float("inf")


def _table(spark):
    i = F.col("id")
    return spark.range(6000).select(
        F.when(i % 7 > 0, i % 900).alias("k"), (1e9 + F.sin(i.cast("double"))).alias("a b"), F.concat(F.lit("t"), i % 40).alias("columns"),
        F.when(i % 5 == 0, F.lit(None)).when(i % 11 == 0, NAN).when(i % 13 == 0, -INF).otherwise(i / 3).alias("batch"),
        F.date_add(F.lit("2020-01-01").cast("date"), (i % 365).cast("int")).alias("day"), F.array(i % 3).alias("xs"),
        F.create_map(F.lit("m"), i % 2).alias("map"), F.lit(None).cast("int").alias("none"))


def test_merged_batches_are_the_whole_table(spark, tmp):
    df = _table(spark)
    for b in range(5):
        store_summary(df.filter(F.col("columns") != "t0").limit(3) if b == 2 else df.filter(F.lit(False)), tmp, b)  # replaced below
    for b in (2, 0, 1, 3, 4):
        store_summary(df.filter(F.pmod(F.hash("a b", "k"), F.lit(4)) == b), tmp, b)  # the last one is empty
    got = {r.column: r for r in running_profile(spark, tmp).collect()}
    want = {r.column: r for r in profile(df).collect()}
    assert [r.position for r in got.values()] == list(range(8)) and list(got) == df.columns
    for c, w in want.items():
        assert (got[c].rows, got[c].nulls, got[c].null_pct) == (w.rows, w.nulls, w.null_pct)
        assert abs(got[c].distinct - w.distinct) <= max(1, 0.03 * w.distinct)
        assert got[c].type == w.type or c == "map"
    x = df.select("a b").toPandas()["a b"]
    assert math.isclose(got["a b"].mean, x.mean(), rel_tol=1e-12) and math.isclose(got["a b"].stddev, x.std(), rel_tol=1e-6)
    assert abs((x <= got["a b"].median).mean() - 0.5) < 0.01
    y = [r[0] for r in df.select("batch").collect() if r[0] is not None and math.isfinite(r[0])]
    assert math.isclose(got["batch"].mean, sum(y) / len(y)) and (got["batch"].min, got["batch"].max) == ("-Infinity", "NaN")
    assert (got["day"].min, got["day"].max, got["day"].mean) == ("2020-01-01", "2020-12-30", None)
    assert (got["xs"].min, got["xs"].max, got["map"].min) == ("[0]", "[2]", None)
    assert (got["none"].min, got["none"].mean, got["none"].distinct, got["k"].min) == (None, None, 1, "0")


def test_few_rows_and_later_columns(spark, tmp):
    one = spark.createDataFrame([(1, 2.5)], "k long, v double")
    store_summary(one, tmp, "a")
    got = {r.column: r for r in running_profile(spark, tmp).collect()}
    assert (got["v"].mean, got["v"].stddev, got["v"].median, got["k"].distinct) == (2.5, None, 2.5, 1)
    store_summary(one.withColumn("w", F.lit("x")), tmp, "b")
    got = {r.column: r for r in running_profile(spark, tmp).collect()}
    assert (got["k"].rows, got["w"].rows, got["v"].stddev, got["k"].distinct) == (2, 1, 0.0, 1)
    store_summary(one.limit(0), f"{tmp}-empty", 0)
    (k, v) = running_profile(spark, f"{tmp}-empty").collect()
    assert (k.rows, k.nulls, k.null_pct, k.distinct, k.min, v.mean) == (0, 0, None, 0, None, None)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        running_profile(spark, f"{tmp}-nowhere")


def test_a_stream_keeps_a_running_profile(spark, tmp):
    df = spark.range(1000).select("id", (F.col("id") % 10).cast("string").alias("t"))
    for start in (0, 500):
        df.filter(F.col("id").between(start, start + 499)).repartition(2).write.mode("append").parquet(f"{tmp}/src")
        ingest_stream(spark, f"{tmp}/src", f"{tmp}/sink", f"{tmp}/ckpt", df.schema, max_files_per_trigger=1, running_dir=f"{tmp}/run")
    got = {r.column: r for r in running_profile(spark, f"{tmp}/run").collect()}
    assert (got["id"].rows, got["id"].min, got["id"].max, got["id"].mean, got["t"].distinct) == (1000, "0", "999", 499.5, 10)
