"""Plan-shape checks: hot keys are aggregated map-side before any shuffle, filters and
projections reach the scan, and no cross join or unbounded broadcast appears."""

import contextlib
import io
import re

from kempt.operators import cleanse, quality
from kempt.plans.queries import flagship_df

SF = "/root/testdata/sf0.001"


def _explain(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def _plan(df):
    return _explain(df, "simple")


def _partial_before_exchange(plan: str, fn: str) -> bool:
    # executedPlan prints the root first: the partial aggregate sits below (after) the exchange line
    lines = plan.splitlines()
    ex = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    part = [i for i, ln in enumerate(lines) if f"partial_{fn}" in ln]
    return bool(ex) and any(p > ex[0] for p in part)


def test_keyed_dedupe_is_partial_aggregate(spark):
    df = spark.createDataFrame([(1, i, "x") for i in range(50)], "k int, ts int, v string")
    plan = _plan(cleanse.dedupe(df, ["k"], ["ts"], keep="latest"))
    assert "Window" not in plan and _partial_before_exchange(plan, "max_by")


def test_fk_report_counts_keys_before_join(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "fk int")
    ref = spark.createDataFrame([(1,)], "id int")
    plan = _plan(quality.fk_report(df, {"fk": (ref, "id")}))
    assert _partial_before_exchange(plan, "count")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_flagship_plan(spark):
    df = flagship_df(spark, SF)
    plan = _plan(df)
    formatted = _explain(df, "formatted")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # only the needed customer columns are read
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in formatted
    assert _partial_before_exchange(plan, "sum")


def test_filter_pushed_to_scan(spark):
    from kempt.operators import relate
    df = spark.read.parquet(f"{SF}/orders.parquet")
    out = relate.project(relate.where_cmp(df, "o_totalprice", ">", 1000.0), ["o_orderkey"])
    formatted = _explain(out, "formatted")
    assert re.search(r"PushedFilters: \[.*GreaterThan\(o_totalprice,1000.0\)", formatted)
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in formatted


def test_bucketed_upsert_reads_existing_without_shuffle(spark, tmp):
    from pyspark.sql import functions as F

    from kempt.sources import tables
    o = spark.read.parquet(f"{SF}/orders.parquet")
    db = tables.ensure_database(spark, "kempt_bucketed", location=f"{tmp}/bdb")
    tables.upsert_table(spark, "orders_b", o, ["o_orderkey"], database=db, buckets=4)
    inc = o.filter("o_orderstatus = 'O'").withColumn("o_orderstatus", F.lit("F"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(tables.upsert(spark.table(f"{db}.orders_b"), inc, ["o_orderkey"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = [ln for ln in plan.splitlines() if "orders_b" in ln][0]
    assert "Bucketed: true" in scan
    # the first join keeps the rows without a null key: the bucketed table is read in place,
    # the only exchange is that of the incoming keys
    first, second = plan.split("SortMergeJoin")[1:3]
    assert first.count("Exchange hashpartitioning") == 1
    assert "Exchange" not in first[:first.index("orders_b")]
    # the second one reads only rows with a null key, of which this table has none
    assert "isnull(o_orderkey" in second
    tables.upsert_table(spark, "orders_b", inc, ["o_orderkey"], database=db, buckets=4)
    assert spark.table(f"{db}.orders_b").filter("o_orderstatus = 'O'").count() == 0


def test_no_python_udf_in_any_query_plan(spark):
    from kempt.plans.queries import QUERIES
    for name, fn in QUERIES.items():
        plan = _explain(fn(spark, SF), "extended")
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name
