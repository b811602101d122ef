"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kempt.session import scratch_dir

#: Bytes in an Arrow batch, unless the session sets its own limit.
_BATCH_BYTES = 8 << 20
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def on_workers(spark: SparkSession) -> None:
    """Prepare the session for operators that run Python: let workers import this package
    when it runs from a source folder, and bound Arrow batches.

    Clusters install the package or ship it with ``--py-files``; this only adds the
    folder it was imported from to the workers' PYTHONPATH."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])
    # rows hold whole texts: bound the Arrow batches between Spark and the workers by bytes
    # too, unless the session already does
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, str(_BATCH_BYTES))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 256, size: int = 2 << 20):
    """While it lasts, Parquet is read in vectors of at most ``rows`` rows, and Arrow batches have
    about ``size`` bytes unless the session set a limit before :func:`on_workers`. Of whole texts,
    Spark's 4,096 rows make arrays of many MB, each of which the heap has to find in one piece, so
    that it grows far beyond what is in use. For actions inside; the former settings then return."""
    vector, batch = "spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxBytesPerBatch"
    own = {k: spark.conf.get(k) for k in (vector, batch)}
    spark.conf.set(vector, str(min(rows, int(own[vector]))))
    if own[batch] == str(_BATCH_BYTES):
        spark.conf.set(batch, str(size))
    try:
        yield
    finally:
        for k, v in own.items():
            spark.conf.set(k, v)


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts the lineage,
    so that a lost executor costs a re-read and not a recomputation, and gives Spark the
    real size for its choice of join. ``options``: of the Parquet writer."""
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) of any documents frame; null text becomes empty. Other
    columns, whatever their names, are left behind."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def held_out(id_col: Column) -> Column:
    """crc32(id as text) mod 5 = 0; a null id counts as held out, so nothing is learned from it."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def slices(batches, rows: int = 1024):
    """Arrow batches cut into small ones, to bound what a Python worker holds at once."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def n_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(df: DataFrame, order: str, values: list[str], chunk: int = 1024) -> DataFrame:
    """``df`` with ``<value>_before`` columns: the sum of each value over the rows of smaller
    ``order`` (a dense row number from 0).

    A scan in levels: window sums inside chunks of ``chunk`` rows, then the same over the
    chunk totals, so no window ever holds more than ``chunk`` rows."""
    from pyspark.sql import Window

    part = f"{order}_chunk"  # a name of its own at each level
    chunks = F.floor(F.col(order) / chunk).cast("long")
    out = df.withColumn(part, chunks)
    w = Window.partitionBy(part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    for v in values:
        out = out.withColumn(f"{v}_before", F.coalesce(F.sum(v).over(w), F.lit(0)).cast("long"))
    top = df.agg(F.max(order)).first()[0]
    if top is None or top < chunk:
        return out.drop(part)
    totals = df.groupBy(chunks.alias(part)).agg(*[F.sum(v).cast("long").alias(v) for v in values])
    base = prefix_sums(totals, part, values, chunk).select(part, *[F.col(f"{v}_before").alias(f"_base_{v}") for v in values])
    out = out.join(base, part)
    for v in values:
        out = out.withColumn(f"{v}_before", F.col(f"{v}_before") + F.col(f"_base_{v}"))
    return out.drop(part, *[f"_base_{v}" for v in values])


#: 64-bit words of a membership filter: at most 8 MB of bits, whatever is put into it.
FILTER_WORDS = 1 << 20


def _bits(key: Column, words: int) -> tuple[Column, Column]:
    """The word of a filter that a 64-bit hash falls into, and its four bits there."""
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"),
                                    F.shiftright(key, 24 + 6 * i).bitwiseAND(F.lit(63)).cast("int"))
    # coalesce: a word that is never null, or Spark would test the join key for null where the rows
    # are read, by computing it there once more
    return F.coalesce(F.pmod(key, F.lit(words).cast("long")), F.lit(0).cast("long")), bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2)).bitwiseOR(bit(3))


def membership(keys: DataFrame, key: Column, words: int = FILTER_WORDS) -> DataFrame:
    """A Bloom filter of the hashes ``key`` of all rows, as (word, bits): at most ``words`` rows,
    so it may be broadcast. A filter that is full lets every row pass, it never loses one."""
    word, bits = _bits(key, words)
    return stored(keys.select(word.alias("word"), bits.alias("bits")).groupBy("word")
                  .agg(F.bit_or("bits").alias("bits")), "filter")


def may_be_in(df: DataFrame, key: Column, members: DataFrame, words: int = FILTER_WORDS, inside: bool = True) -> DataFrame:
    """The rows of ``df`` that may be among ``members`` (a :func:`membership` filter), or with
    ``inside=False`` those that certainly are not. No row is shuffled."""
    word, bits = _bits(key, words)
    carried = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), word.alias("row_word"), bits.alias("row_bits"))
    hit = F.coalesce(F.col("bits").bitwiseAND(F.col("row_bits")) == F.col("row_bits"), F.lit(False))
    met = carried.join(F.broadcast(members), F.col("row_word") == F.col("word"), "inner" if inside else "left")
    return met.filter(hit if inside else ~hit).select(*[F.col(f"row.`{c}`") for c in df.columns])


def keep_rows(docs: DataFrame, decisions: DataFrame, key: dict[str, Column], words: int = FILTER_WORDS) -> DataFrame:
    """The rows of ``docs`` that ``decisions`` keeps, with all their columns unchanged.

    ``decisions`` has the columns named in ``key`` and a boolean ``kept``, one row for each
    row of ``docs``; ``key`` says how each is computed from a row of ``docs``. Of rows that
    agree in the whole key (the same document stored twice) at most one stays: the one whose
    columns, written as text, have the smallest MD5, which any column types allow.

    Only the keys of dropped and repeated rows are looked for. Rows whose first key a Bloom
    filter of ``words`` 64-bit words excludes pass without a shuffle; the others meet the keys in
    a sorted join, whose cost grows with them."""
    names = [f"key_{k}" for k in key]
    first = next(iter(key.values()))
    types = [f.dataType for f in docs.select(*[c.alias(k) for k, c in key.items()]).schema]
    per = stored(decisions.groupBy(*[F.col(k).cast(t).alias(n) for k, n, t in zip(key, names, types, strict=True)])
                 .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
                 .filter(~F.col("kept") | (F.col("n") > 1)), "keep-keys")
    if per.isEmpty():
        return docs
    members = membership(per, F.xxhash64(names[0]), words)
    others = may_be_in(docs, F.xxhash64(first), members, words, inside=False)
    # rows travel as one struct, so that no column of theirs can clash
    keyed = may_be_in(docs, F.xxhash64(first), members, words).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(f"row_{k}") for k, c in key.items()])
    cond = F.lit(True)
    for k, n in zip(key, names, strict=True):
        cond = cond & F.col(f"row_{k}").eqNullSafe(F.col(n))
    rows = [F.col(f"row.`{c}`") for c in docs.columns]
    once = others.unionByName(keyed.join(per.hint("merge"), cond, "left_anti").select(*rows))
    twice = per.filter(F.col("kept"))
    if twice.isEmpty():
        return once
    rest = (keyed.join(twice, cond, "left_semi").groupBy(*[f"row_{k}" for k in key])
            .agg(F.min_by("row", F.md5(F.col("row").cast("string"))).alias("row")))
    return once.unionByName(rest.select(*rows))
