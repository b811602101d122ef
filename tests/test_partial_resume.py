"""Partial upserts, version differences, quarantine, resumable stages, and rows that clash or are odd."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from kempt.operators import derive, quality, relate, stats
from kempt.operators.versions import diff_versions, differing_ranges
from kempt.plans.ledger import files_id, run_stages, stages_done
from kempt.plans.pipeline import REGISTRY, PipelineError, run_pipeline
from kempt.session import path_exists
from kempt.sources import partial, tables
from kempt.sources.quarantine import read_quarantined
from kempt.streaming.ingest import ingest_stream
from tests.conftest import rows

NAN, INF = float("nan"), float("inf")


# ------------------------------------------------------------------ partial upserts
def _files(spark, path):
    df = spark.read.parquet(path)
    got = df.select("_metadata.file_path", "_metadata.file_modification_time", *[c for c in df.columns if c.startswith("key_part_of_")]).distinct()
    return {(r[0], r[1]): r[2] for r in got.collect()}


def test_only_touched_partitions_are_rewritten(spark, tmp):
    old = spark.range(400).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("a").alias("kind"), F.lit(1.5).alias("v"))
    assert len(partial.upsert_partitions(spark, tmp, old, ["k", "kind"], parts=32)) == 32
    before = _files(spark, tmp)
    inc = spark.createDataFrame([(7, "a", 2.0), (None, "a", 3.0), (9000, None, 4.0)], "k int, kind string, v double")
    touched = partial.upsert_partitions(spark, tmp, inc, ["k", "kind"])
    assert 1 <= len(touched) <= 3
    after = _files(spark, tmp)
    assert {f for f, p in before.items() if p not in touched} == {f for f, p in after.items() if p not in touched}
    assert not {f for f, p in before.items() if p in touched} & set(after)
    want = rows(tables.upsert(old, inc.withColumn("k", F.col("k").cast("long")), ["k", "kind"]))
    assert rows(partial.read_keyed(spark, tmp)) == want
    assert partial.upsert_partitions(spark, tmp, inc, ["k", "kind"]) == touched  # the same batch again
    assert rows(partial.read_keyed(spark, tmp)) == want
    assert partial.upsert_partitions(spark, tmp, inc.limit(0), ["k", "kind"]) == []
    with pytest.raises(Exception, match="repeats"):
        partial.upsert_partitions(spark, tmp, inc.union(inc), ["k", "kind"])
    assert rows(partial.read_keyed(spark, tmp)) == want  # a failed batch changes nothing
    newer = inc.withColumn("ver", F.lit(1)).union(inc.withColumns({"v": F.lit(0.0), "ver": F.lit(2)}))
    partial.upsert_partitions(spark, tmp, newer, ["k", "kind"], ["ver"])
    assert {r.v for r in partial.read_keyed(spark, tmp).filter("k = 7 OR k IS NULL OR kind IS NULL").collect()} == {0.0}


def test_an_upsert_cut_off_is_finished(spark, tmp):
    old = spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    partial.upsert_partitions(spark, tmp, old, ["k"], parts=8)
    part = [c for c in spark.read.parquet(tmp).columns if c.startswith("key_part_of_")][0]
    staged = spark.read.parquet(tmp).filter(F.col(part) == 3).withColumn("v", F.lit("new"))
    staged.write.parquet(f"{tmp}/_staged")  # complete, but nothing is replaced yet
    n = staged.count()
    assert partial.read_keyed(spark, tmp).filter("v = 'new'").count() == n > 0
    assert not path_exists(spark, f"{tmp}/_staged") and not partial.recover(spark, tmp)
    assert partial.read_keyed(spark, tmp).count() == 100


# ------------------------------------------------------------------ differences
def _versions(spark):
    base = [(i, i % 5, f"v{i}", float(i)) for i in range(2000)] + [(None, None, "n", NAN), (None, 1, None, INF), (5000, 1, "d", 0.0), (5000, 1, "d", 1.0)]
    left = spark.createDataFrame(base, "a int, b int, c string, d double")
    other = [r if r[0] not in (10, 11, 12) else (r[0], r[1], "x", r[3]) for r in base if r[0] not in (20, 21)]
    other = [(a, b, c, -0.0 if a == 0 else d) for a, b, c, d in other] + [(7000, None, "new", None), (30, 0, "v30", 30.0)]
    return left, spark.createDataFrame(other, "a int, b int, c string, d double").repartition(5)


@pytest.mark.parametrize("bits", [(12, 24, 64), (1, 64), (64,)])
def test_differences_are_those_of_reconcile(spark, bits):
    left, right = _versions(spark)
    got = rows(diff_versions(left, right, ["a", "b"], ["c", "d"], bits))
    full = relate.reconcile(left, right, ["a", "b"], ["c", "d"])
    # a key repeated with the same rows on both sides is no difference
    assert got == rows(full.filter("status <> 'matched' AND NOT (a <=> 5000)"))
    assert len(got) == 3 + 2 + 1 + 1
    assert diff_versions(left, left.repartition(3), ["a", "b"], ["c", "d"], bits).count() == 0
    assert diff_versions(left.limit(0), left.limit(0), ["a"], ["c"], bits).count() == 0
    assert diff_versions(left.limit(0), left, ["a", "b"], ["c", "d"], bits).count() == left.select("a", "b").distinct().count()


def test_equal_ranges_do_not_move(spark):
    left, right = _versions(spark)
    assert differing_ranges(left, right, ["a", "b"], ["c", "d"]).count() == 7  # of 2,003 keys
    with pytest.raises(ValueError):
        differing_ranges(left, right, ["a"], ["c"], (12, 24))


# ------------------------------------------------------------------ quarantine
CSV = ["1,x,2.5", "two,x,2.5", "3,,", "4,x", "5,x,1.0,extra", "6,\"quoted, text\",7", "7,x,abc", ",x,1.0", "8,NA,1e3"]


def _write(tmp, name, lines):
    folder = tmp.replace("file:", "")
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")
    return folder


def test_good_and_bad_rows_are_the_input(spark, tmp):
    path = _write(tmp, "a.csv", ["id,name,value", *CSV])
    good, bad = read_quarantined(spark, path, "id int, name string, value double", null_value="NA", required=["id"])
    assert rows(good) == rows(spark.createDataFrame([(1, "x", 2.5), (3, None, None), (6, "quoted, text", 7.0), (8, None, 1000.0)], good.schema))
    assert good.select("name").count() == 4  # whatever columns are asked for
    got = {r.record: r.reason for r in bad.collect()}
    assert {k: got[k] for k in ("two,x,2.5", "4,x", "5,x,1.0,extra", "7,x,abc")} == dict.fromkeys(("two,x,2.5", "4,x", "5,x,1.0,extra", "7,x,abc"), "malformed")
    assert [v for k, v in got.items() if json.loads(k if k[0] == "{" else "{}")] == ["missing id"]
    assert good.count() + bad.count() == len(CSV) and {os.path.basename(r.file) for r in bad.collect()} == {"a.csv"}


def test_json_records(spark, tmp):
    path = _write(tmp, "a.json", ['{"id": 1, "record": "r"}', "not json", '{"id": "x"}', '{"id": 2}', "{"])
    good, bad = read_quarantined(spark, path, "id int, record string", "json", required=["record"])
    assert rows(good) == [(1, "r")]
    assert sorted((r.reason, r.record) for r in bad.collect()) == [("malformed", "not json"), ("malformed", "{"), ("malformed", '{"id": "x"}'),
                                                                   ("missing record", '{"id":2}')]
    with pytest.raises(ValueError):
        read_quarantined(spark, path, "id int", "parquet")


def test_a_bad_file_does_not_stop_the_stream(spark, tmp):
    src = _write(f"{tmp}/in", "a.csv", ["1,a", "2,b"])
    args = dict(schema="id int, name string", fmt="csv", quarantine_dir=f"{tmp}/bad", steps=[{"op": "upper_strings"}])
    ingest_stream(spark, src, f"{tmp}/out", f"{tmp}/ckpt", **args)
    _write(f"{tmp}/in", "b.csv", ["%%%", "x,y,z", "\x00\x01,,,"])
    _write(f"{tmp}/in", "c.csv", ["3,c", "oops,d"])
    ingest_stream(spark, src, f"{tmp}/out", f"{tmp}/ckpt", **args)
    ingest_stream(spark, src, f"{tmp}/out", f"{tmp}/ckpt", **args)
    assert rows(spark.read.parquet(f"{tmp}/out").select("id", "name")) == [(1, "A"), (2, "B"), (3, "C")]
    assert spark.read.parquet(f"{tmp}/bad").filter("record = 'oops,d' AND reason = 'malformed'").count() == 1
    assert spark.read.parquet(f"{tmp}/bad").count() == 4


# ------------------------------------------------------------------ resumable stages
def test_a_broken_run_resumes_at_its_stage(spark, tmp):
    calls, broken = [], [True]

    def note(df, tag):
        calls.append(tag)
        return df.withColumn(tag, F.lit(1))

    def fragile(df, tag):
        calls.append(tag)
        if broken[0]:
            df = df.withColumn("__boom", F.raise_error(F.lit("disk is gone")).cast("string"))
            return df.filter("__boom IS NULL")
        return df.withColumn(tag, F.lit(2))

    reg = REGISTRY | {"note": note, "fragile": fragile}

    def step(op, **p):
        return {"op": op, "params": p}

    df = spark.createDataFrame([(1, " a "), (2, None)], "id int, s string")
    stages = [("one", [step("note", tag="x"), step("trim_strings")]), ("two", [step("fragile", tag="y")]), ("three", [step("note", tag="z")])]
    with pytest.raises(Exception, match="disk is gone"):
        run_stages(df, stages, tmp, "in-1", reg).count()
    assert stages_done(spark, stages, tmp, "in-1", reg) == [("one", True), ("two", False), ("three", False)]
    broken[0], calls[:] = False, []
    out = run_stages(df, stages, tmp, "in-1", reg)
    assert calls == ["y", "z"]  # stage one was not computed again
    assert rows(out) == rows(run_pipeline(df, [s for _, ss in stages for s in ss], reg))
    calls[:] = []
    assert rows(run_stages(df, stages, tmp, "in-1", reg)) == rows(out) and calls == []
    changed = [stages[0], ("two", [step("fragile", tag="w")]), stages[2]]
    assert run_stages(df, changed, tmp, "in-1", reg).columns == ["id", "s", "x", "w", "z"] and calls == ["w", "z"]
    calls[:] = []
    run_stages(df, stages, tmp, "in-1", reg)
    assert calls == []  # back to the first parameters
    off = [stages[0], ("two", [*stages[1][1], {"op": "note", "params": {"tag": "q"}, "enabled": False}]), stages[2]]
    run_stages(df, off, tmp, "in-1", reg)
    assert calls == []
    run_stages(df, stages, tmp, "in-2", reg)
    assert calls == ["x", "y", "z"]
    with pytest.raises(PipelineError):
        run_stages(df, [("bad", [step("nothing")])], tmp, "in-1", reg)
    assert run_stages(df, [], tmp, "in-1", reg) is df


def test_identity_of_files(spark, tmp):
    spark.range(10).write.parquet(tmp)
    first = files_id(spark, tmp)
    assert first == files_id(spark, tmp)
    spark.range(5).write.mode("append").parquet(tmp)
    assert files_id(spark, tmp) != first
    assert glob.glob(tmp.replace("file:", "") + "/part-*")


# ------------------------------------------------------------------ odd values and names
def test_fits_pass_over_nan_and_infinity(spark):
    df = spark.createDataFrame([(NAN,), (1.0,), (2.0,), (None,), (INF,), (-INF,)], "x double")
    at = lambda d: [repr(r[0]) for r in d.collect()]
    assert at(stats.winsorize(df, ["x"], 3.0)) == ["nan", "1.0", "2.0", "None", repr(1.5 + 3 * 0.5**0.5), repr(1.5 - 3 * 0.5**0.5)]
    assert at(stats.min_max(df, ["x"], suffix="")) == ["nan", "0.0", "1.0", "None", "inf", "-inf"]
    assert at(stats.impute(df, {"x": "mean"})) == ["nan", "1.0", "2.0", "1.5", "inf", "-inf"]
    z = at(stats.standardize(df, ["x"]))
    assert z[0] == "nan" and z[3:] == ["None", "inf", "-inf"] and float(z[1]) == -float(z[2]) < 0
    fit = stats.fit_moments(df, ["x"])
    assert fit["x"]["n"] == 2 and at(stats.winsorize(df, ["x"], 3.0, stats=fit)) == at(stats.winsorize(df, ["x"], 3.0))
    none = spark.createDataFrame([(NAN,), (INF,)], "x double")
    assert at(stats.winsorize(none, ["x"])) == ["nan", "inf"] and at(stats.min_max(none, ["x"], suffix="")) == ["None", "None"]


def test_reconcile_nulls_and_odd_values(spark):
    a = spark.createDataFrame([(None, 1.0), (1, NAN), (2, INF), (3, 5.0), (4, None), (5, 1.0)], "k int, v double")
    assert {r.status for r in relate.reconcile(a, a, ["k"], ["v"]).collect()} == {"matched"}
    assert {r.status for r in relate.reconcile(a, a, ["k"], ["v"], 0.1).collect()} == {"matched"}
    b = spark.createDataFrame([(None, 1.05), (1, 0.0), (2, -INF), (3, 5.2), (4, 0.0), (6, 1.0)], "k int, v double")
    got = {r.k: r.status for r in relate.reconcile(a, b, ["k"], ["v"], 0.1).collect()}
    assert got == {None: "matched", 1: "changed", 2: "changed", 3: "changed", 4: "changed", 5: "left_only", 6: "right_only"}
    pairs = spark.createDataFrame([(INF, INF), (NAN, NAN), (INF, -INF), (NAN, 1.0), (1.0, 1.05), (None, 1.0), (None, None)], "a double, b double")
    assert relate.reconcile_cols(pairs, "a", "b", 0.1).count() == 3 == relate.reconcile_cols(pairs, "a", "b").count() - 1


def test_names_of_the_frame_survive(spark):
    gaz = spark.createDataFrame([("PARIS", 48.8, 2.3), ("paris", 48.9, 2.2)], "place string, lat double, lon double")
    df = spark.createDataFrame([("Paris", "old", 1), ("Nowhere", "old", 2)], "city string, lat string, __key int")
    out = relate.locate(df, ["city"], gaz)
    assert out.columns == ["city", "__key", "lat", "lon", "address_valid"]
    assert rows(out) == [("Nowhere", 2, None, None, False), ("Paris", 1, 48.8, 2.3, True)]
    lab = spark.createDataFrame([("b", 5), ("a", 6), ("b", 7)], "s string, __label int")
    assert rows(derive.label_index(lab, "s")) == [("a", 6, 1), ("b", 5, 0), ("b", 7, 0)]
    left = spark.createDataFrame([(1, i) for i in range(20)] + [(2, 0)], "k int, __salt int")
    right = spark.createDataFrame([(1, "x"), (2, "y")], "k int, w string")
    assert rows(relate.merge(left, right, "k", salt_buckets=3)) == rows(left.join(right, "k"))


def test_empty_lists(spark):
    df = spark.createDataFrame([("a",)], "s string")
    assert quality.quality_report(df, []).count() == 0
    assert rows(quality.suggest_spelling(df, "s", [])) == [("a", None, None)]


# ------------------------------------------------------------------ no caps
def test_transpose_blocks_are_the_wide_form(spark):
    df = spark.createDataFrame([(i, f"s{i}", None if i % 7 == 0 else i * 2) for i in range(60)], "id int, block string, n int").repartition(4)
    wide = {r["column"]: r for r in relate.transpose(df, "id").collect()}
    for size in (1, 7, 1000):
        blocks = sorted(relate.transpose_blocks(df, "id", size).collect(), key=lambda r: (r["column"], r.block))
        for c in ("block", "n"):
            mine = [b for b in blocks if b["column"] == c]
            keys = [k for b in mine for k in b["keys"]]
            assert keys == [str(i) for i in range(60)] and all(len(b["keys"]) == size for b in mine[:-1])
            assert [v for b in mine for v in b["values"]] == [wide[c][k] for k in keys]
            assert [b.block for b in mine] == list(range(len(mine)))
    with pytest.raises(ValueError, match="transpose_blocks"):
        relate.transpose(df, "id", max_rows=10)
    assert relate.transpose_blocks(df.limit(0), "id").count() == 0


def test_pivot_map_is_the_pivot(spark):
    df = spark.createDataFrame([(i % 3, f"c{i % 11}" if i % 11 else None, float(i)) for i in range(99)], "g int, c string, v double")
    for cells in (2, 4096):
        got = relate.pivot_map(df, "g", "c", "v", cells=cells).collect()
        flat = sorted((r.g, str(c.column), c.value) for r in got for c in r.cells)
        want = sorted((r.g, str(r.c), r.v) for r in df.groupBy("g", "c").agg(F.sum("v").alias("v")).collect())
        assert flat == want and all(len(r.cells) <= 11 for r in got)


def test_large_dictionaries_as_the_exhaustive_form(spark):
    import random
    rng = random.Random(5)
    words = sorted({"".join(rng.choices("ABCDE", k=rng.randint(0, 7))) for _ in range(400)})
    values = ["".join(rng.choices("abcdeF", k=rng.randint(0, 8))) for _ in range(300)] + words[:20] + [None, ""]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, word int")
    allowed = spark.createDataFrame([(w,) for w in words], "w string")
    for d in (0, 1, 2):
        got = quality.suggest_from(df, "value", allowed, "w", d)
        want = quality.suggest_spelling(df, "value", words, max_distance=d)
        near = F.when(F.col("value_suggestion").isNotNull(), F.col("value_distance"))
        assert rows(got) == rows(want.withColumn("value_distance", near))


def test_samples_have_exactly_n_rows(spark):
    df = spark.createDataFrame([(i, "hot" if i % 5 else ("b" if i % 2 else None), float(i % 9), 1) for i in range(900)], "id int, s string, w double, __nth int")
    a, b = (relate.sample_per_stratum(df.repartition(n), "s", 100, "id") for n in (1, 7))
    assert rows(a) == rows(b) and {r.s: r.n for r in a.groupBy("s").agg(F.count("*").alias("n")).collect()} == {"hot": 100, "b": 90, None: 90}
    w = relate.sample_per_stratum(df, "s", 60, "id", "w")
    assert w.filter("w = 0").count() == 0 and w.filter("s = 'hot'").agg(F.avg("w")).first()[0] > 4.9
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
