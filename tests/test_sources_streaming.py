import os

import pytest
from pyspark.sql import functions as F

from kempt.plans.pipeline import PipelineError, run_pipeline
from kempt.sources import files, tables
from kempt.streaming.ingest import dedupe_stream, ingest_stream
from tests.conftest import rows


def test_csv_round_trip_with_null_token(spark, tmp):
    df = spark.createDataFrame([(1, "a", None), (2, "", 2.5)], "id int, s string, d double")
    files.write_table(df, f"{tmp}/c", "csv", mode="overwrite", options={"header": "true", "nullValue": "NA"})
    back = files.read_table(spark, f"{tmp}/c", "csv", schema="id int, s string, d double", null_value="NA")
    assert rows(back) == [(1, "a", None), (2, "", 2.5)]
    with pytest.raises(Exception):
        files.write_table(df, f"{tmp}/c", "csv")  # errorifexists
    st = files.file_stats(spark, f"{tmp}/c", "csv", schema="id int, s string, d double").collect()
    assert sum(r["rows"] for r in st) == 2 and all(r["size_kb"] > 0 for r in st)


def test_upsert_semantics(spark):
    existing = spark.createDataFrame([(1, "old"), (2, "keep")], "k int, v string")
    incoming = spark.createDataFrame([(1, "new1", 1), (1, "new2", 2), (3, "ins", 1)], "k int, v string, ver int")
    once = tables.upsert(existing, incoming, ["k"], ["ver"])
    assert rows(once) == [(1, "new2"), (2, "keep"), (3, "ins")]
    twice = tables.upsert(once, incoming, ["k"], ["ver"])
    assert rows(twice) == rows(once)


def test_upsert_table_stage_and_swap(spark, tmp):
    db = tables.ensure_database(spark, "kempt_t", location=f"{tmp}/db")
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tables.upsert_table(spark, "loans", a, ["k"], database=db)
    b = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    tables.upsert_table(spark, "loans", b, ["k"], database=db)
    tables.upsert_table(spark, "loans", b, ["k"], database=db)
    assert rows(spark.table(f"{db}.loans")) == [(1, "a"), (2, "B"), (3, "c")]
    tables.append_table(spark.createDataFrame([(4, "d")], "k int, v string"), "loans", db)
    assert spark.table(f"{db}.loans").count() == 4


def test_build_marts_one_pass(spark, tmp):
    df = spark.createDataFrame([(1, "North-East"), (2, "NORTHEAST"), (3, "south"), (4, None)], "id int, Region string")
    marts = tables.build_marts(df, "Region", f"{tmp}/marts", values=["North-East", "South"])
    assert sorted(marts) == ["datamart_north_east", "datamart_south"]
    assert sorted(r[0] for r in marts["datamart_north_east"].select("id").collect()) == [1, 2]
    assert "Region" not in marts["datamart_south"].columns


def test_versions(spark, tmp):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    tables.save_version(df, f"{tmp}/v", "a")
    tables.save_version(df.union(df), f"{tmp}/v", "b")
    tables.save_version(df, f"{tmp}/v", "b")  # re-save replaces only b
    got = {r["version"]: r["rows"] for r in tables.list_versions(spark, f"{tmp}/v").collect()}
    assert got == {"a": 2, "b": 2}
    assert tables.read_version(spark, f"{tmp}/v", "a").columns == ["x"]


def test_ingest_stream_new_files_once(spark, tmp):
    schema = "id int, s string"
    src, sink, ck, prof = f"{tmp}/src", f"{tmp}/sink", f"{tmp}/ck", f"{tmp}/prof"
    spark.createDataFrame([(1, " a "), (2, "")], schema).write.parquet(f"{src}")
    os.makedirs(f"{src}/sub", exist_ok=True)
    spark.createDataFrame([(99, "nested")], schema).write.parquet(f"{src}/sub/x")
    steps = [{"op": "trim_strings"}, {"op": "blank_to_null"}]
    ingest_stream(spark, src, sink, ck, schema, steps=steps, profile_dir=prof)
    assert rows(spark.read.parquet(sink).drop("stream", "batch")) == [(1, "a"), (2, None)]
    spark.createDataFrame([(3, "c ")], schema).write.mode("append").parquet(src)
    ingest_stream(spark, src, sink, ck, schema, steps=steps, profile_dir=prof)
    ingest_stream(spark, src, sink, ck, schema, steps=steps, profile_dir=prof)  # nothing new
    assert rows(spark.read.parquet(sink).drop("stream", "batch")) == [(1, "a"), (2, None), (3, "c")]
    assert spark.read.parquet(prof).filter(F.col("column") == "s").count() == 2


def test_stream_equals_batch(spark, tmp):
    schema = "id int, s string"
    df = spark.createDataFrame([(i, f" v{i % 4} ") for i in range(50)], schema)
    df.repartition(5).write.parquet(f"{tmp}/src")
    steps = [{"op": "trim_strings"}, {"op": "upper_strings"}]
    ingest_stream(spark, f"{tmp}/src", f"{tmp}/sink", f"{tmp}/ck", schema, steps=steps, max_files_per_trigger=2)
    assert rows(spark.read.parquet(f"{tmp}/sink").drop("stream", "batch")) == rows(run_pipeline(df, steps))


def test_dedupe_stream_plan(spark, tmp):
    schema = "k int, ts timestamp"
    spark.createDataFrame([], schema).write.parquet(f"{tmp}/e")
    s = spark.readStream.schema(schema).parquet(f"{tmp}/e")
    assert dedupe_stream(s, ["k"], "ts", "1 hour").isStreaming


def test_pipeline_errors(spark):
    df = spark.createDataFrame([(" a ",)], "s string")
    with pytest.raises(PipelineError):
        run_pipeline(df, [{"op": "nope"}])
    with pytest.raises(PipelineError):
        run_pipeline(df, [{"op": "round_cols", "params": {}}])
    with pytest.raises(PipelineError):
        run_pipeline(df, [{"op": "trim_strings", "params": {"bogus": 1}}])
    out = run_pipeline(df, '[{"op": "trim_strings"}, {"op": "upper_strings", "enabled": false}]')
    assert rows(out) == [("a",)]


def test_register_marts_views(spark, tmp):
    df = spark.createDataFrame([(1, "North-East"), (2, "south"), (3, "NORTHEAST")], "id int, Region string")
    tables.build_marts(df, "Region", f"{tmp}/m")
    db = tables.ensure_database(spark, "kempt_marts", location=f"{tmp}/mdb")
    names = tables.register_marts(spark, f"{tmp}/m", ["North-East", "south"], database=db)
    assert names == ["`kempt_marts`.`datamart_north_east`", "`kempt_marts`.`datamart_south`"]
    assert sorted(r.id for r in spark.table("kempt_marts.datamart_north_east").collect()) == [1, 3]


def test_stream_applies_batch_fitted_stats(spark, tmp):
    from kempt.operators import stats
    schema = "id int, x double"
    df = spark.createDataFrame([(i, float(i)) for i in range(40)] + [(99, 1000.0)], schema)
    df.repartition(3).write.parquet(f"{tmp}/src")
    fitted = stats.fit_moments(df, ["x"])
    steps = [{"op": "winsorize", "params": {"cols": ["x"], "threshold": 2.0, "stats": fitted}},
             {"op": "min_max", "params": {"cols": ["x"], "stats": fitted}}]
    ingest_stream(spark, f"{tmp}/src", f"{tmp}/sink", f"{tmp}/ck", schema, steps=steps, max_files_per_trigger=1)
    got = rows(spark.read.parquet(f"{tmp}/sink").drop("stream", "batch"))
    assert got == rows(run_pipeline(df, steps))


def test_dedupe_stream_drops_repeats_within_watermark(spark, tmp):
    import datetime as dt
    schema = "k int, ts timestamp"
    t0 = dt.datetime(2024, 1, 1)
    data = [(1, t0), (1, t0 + dt.timedelta(minutes=5)), (2, t0), (2, t0), (3, t0 + dt.timedelta(hours=3))]
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{tmp}/e")
    s = spark.readStream.schema(schema).parquet(f"{tmp}/e")
    q = (dedupe_stream(s, ["k"], "ts", "1 hour").writeStream.format("memory").queryName("kempt_dedupe")
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.k for r in spark.table("kempt_dedupe").collect()) == [1, 2, 3]


def test_describe_percentiles(spark):
    from kempt.operators import stats
    df = spark.range(101).selectExpr("CAST(id AS DOUBLE) AS x")
    r = stats.describe_cols(df, ["x"], percentiles=[0.25, 0.5, 0.75]).collect()[0]
    assert (r["p25"], r["p50"], r["p75"]) == (25.0, 50.0, 75.0)


def test_save_table_partitioned(spark, tmp):
    db = tables.ensure_database(spark, "kempt_save", location=f"{tmp}/sdb")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    name = tables.save_table(df, "t", db, partition_by=["p"])
    assert rows(spark.table(name).select("id", "p")) == [(1, "a"), (2, "b")]
    assert rows(spark.table(name).filter("p = 'b'").select("id")) == [(2,)]


def test_pipeline_fit_after_shuffle_is_materialized_and_equal(spark):
    df = spark.createDataFrame([(i % 7, float(i % 7) * (100 if i == 3 else 1)) for i in range(60)], "k int, x double")
    steps = [{"op": "dedupe"}, {"op": "winsorize", "params": {"cols": ["x"], "threshold": 1.0}},
             {"op": "drop_sparse_nulls"}]
    a = run_pipeline(df, steps, materialize_fits=True)
    b = run_pipeline(df, steps, materialize_fits=False)
    assert rows(a) == rows(b)
    assert "/pipeline-winsorize" in a.inputFiles()[0]


def test_pipeline_impute_mean_after_shuffle(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.0), (2, None), (3, 4.0)], "k int, x double")
    steps = [{"op": "dedupe"}, {"op": "impute", "params": {"spec": {"x": "mean"}}}]
    assert rows(run_pipeline(df, steps)) == [(1, 1.0), (2, 2.5), (3, 4.0)]
    assert rows(run_pipeline(df, steps, materialize_fits=False)) == [(1, 1.0), (2, 2.5), (3, 4.0)]


@pytest.mark.parametrize("fmt", ["json", "orc", "parquet"])
def test_formats_round_trip(spark, tmp, fmt):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, None)], "id int, s string, d double")
    files.write_table(df, f"{tmp}/{fmt}", fmt, mode="overwrite", partition_by=["id"])
    back = files.read_table(spark, f"{tmp}/{fmt}", fmt, schema="s string, d double, id int")
    assert rows(back.select("id", "s", "d")) == [(1, "a", 1.5), (2, None, None)]


def test_rerun_leaves_nothing_stale(spark, tmp):
    df = spark.createDataFrame([("north", 1), ("south", 2)], "r string, x int")
    tables.build_marts(df, "r", f"{tmp}/m", values=["north", "south"])
    marts = tables.build_marts(df.filter("r = 'north'"), "r", f"{tmp}/m", values=["north", "south"])
    assert marts["datamart_south"].count() == 0 and marts["datamart_north"].count() == 1
    files.write_table(df, f"{tmp}/w", partition_by=["r"])
    files.write_table(df.filter("r = 'north'"), f"{tmp}/w", mode="overwrite", partition_by=["r"])
    assert spark.read.parquet(f"{tmp}/w").count() == 1
    files.write_table(df.filter("r = 'south'"), f"{tmp}/w", mode="overwrite", partition_by=["r"], replace="partitions")
    assert spark.read.parquet(f"{tmp}/w").count() == 2
    tables.write_split(df, "r", f"{tmp}/s")
    tables.write_split(df.filter("r = 'south'"), "r", f"{tmp}/s")
    assert rows(spark.read.parquet(f"{tmp}/s"), "r") == [("south",)]


def test_versions_keep_their_columns(spark, tmp):
    tables.save_version(spark.createDataFrame([(1,)], "a int"), f"{tmp}/v", "1")
    tables.save_version(spark.createDataFrame([(2, "x")], "a int, b string"), f"{tmp}/v", "02")
    assert tables.read_version(spark, f"{tmp}/v", "02").columns == ["a", "b"]
    assert rows(tables.read_version(spark, f"{tmp}/v"), "version", "a", "b") == [("02", 2, "x"), ("1", 1, None)]
    with pytest.raises(ValueError, match="version"):
        tables.save_version(spark.createDataFrame([(1,)], "version int"), f"{tmp}/v", "3")


def test_upsert_null_and_repeated_keys(spark):
    old = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    new = spark.createDataFrame([(None, "c"), (2, "d")], "k int, v string")
    once = tables.upsert(old, new, ["k"])
    assert rows(once) == rows(tables.upsert(once, new, ["k"])) == [(1, "a"), (2, "d"), (None, "c")]
    with pytest.raises(Exception, match="order_by"):
        tables.upsert(old, new.union(new), ["k"]).collect()


def test_append_to_a_bucketed_table(spark, tmp):
    db = tables.ensure_database(spark, "kempt_append", location=f"{tmp}/adb")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    tables.upsert_table(spark, "t", df, ["k"], database=db, buckets=2)
    tables.append_table(spark.createDataFrame([("b", 2)], "v string, k int"), "t", db)
    assert rows(spark.table(f"{db}.t"), "k", "v") == [(1, "a"), (2, "b")]


def test_dedupe_on_a_stream_is_refused(spark, tmp):
    spark.createDataFrame([(1,)], "k int").write.parquet(f"{tmp}/d")
    with pytest.raises(PipelineError, match="stream"):
        run_pipeline(spark.readStream.schema("k int").parquet(f"{tmp}/d"), [{"op": "dedupe"}])


def test_new_checkpoint_does_not_replace_old_batches(spark, tmp):
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(f"{tmp}/in")
    for ck in ("ck1", "ck2"):
        ingest_stream(spark, f"{tmp}/in", f"{tmp}/out", f"{tmp}/{ck}", "k int, v string")
    got = spark.read.parquet(f"{tmp}/out")
    assert got.count() == 2 and got.select("stream").distinct().count() == 2


def test_cluster_without_a_shared_folder_is_refused():
    from kempt import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())
    assert session.is_local("local") and session.is_local("local[4]") and not session.is_local("yarn")


def test_median_after_dedupe_reads_written_rows(spark):
    from pyspark.sql import functions as F
    df = spark.range(400).select((F.col("id") % 50).alias("k"), F.when(F.col("id") % 7 != 0, (F.col("id") % 50).cast("double")).alias("x"))
    out = run_pipeline(df, [{"op": "dedupe"}, {"op": "impute", "params": {"spec": {"x": "median"}}}])
    assert "/pipeline-impute" in out.inputFiles()[0]
    assert rows(out) == rows(run_pipeline(df, [{"op": "dedupe"}, {"op": "impute", "params": {"spec": {"x": "median"}}}],
                                          materialize_fits=False))
