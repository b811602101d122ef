"""Catalog tables, keyed upserts, data marts and versioned saves (S5, K2-K5, H1-H4, M20).

Everything that replaces data writes a complete new copy first and only then
switches to it, so a lost executor or a failed job never leaves a half-written
table behind: Spark re-runs lost tasks, and an aborted job leaves the old copy.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kempt.functions.columns import col, q
from kempt.operators.cleanse import _resolve, dedupe


# --------------------------------------------------------------------------- K5
def ensure_database(spark: SparkSession, name: str, location: str | None = None, use: bool = False) -> str:
    """``CREATE DATABASE IF NOT EXISTS`` (optionally at a location), optionally make it current."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {q(name)}{loc}")
    if use:
        spark.catalog.setCurrentDatabase(name)
    return name


def _full(db: str | None, table: str) -> str:
    return f"{q(db)}.{q(table)}" if db else q(table)


# --------------------------------------------------------------------------- K3 / H1
def save_table(df: DataFrame, table: str, database: str | None = None, mode: str = "overwrite",
               partition_by: Sequence[str] = (), fmt: str = "parquet") -> str:
    """``saveAsTable`` in the session catalog."""
    name = _full(database, table)
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return name


# --------------------------------------------------------------------------- K4
def append_table(df: DataFrame, table: str, database: str | None = None) -> str:
    """Append rows by column name (``insertInto`` would match by position). The table keeps
    its partitioning, buckets and sort columns, which an append through the writer would
    have to repeat."""
    name = _full(database, table)
    view = f"kempt_append_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    try:
        df.sparkSession.sql(f"INSERT INTO {name} BY NAME SELECT * FROM {view}")
    finally:
        df.sparkSession.catalog.dropTempView(view)
    return name


# --------------------------------------------------------------------------- H2 / H3
def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
           order_by: Sequence[str] | None = None) -> DataFrame:
    """Insert new keys and replace existing ones with the incoming row (lazy).

    When a key repeats in ``incoming`` the row with the greatest ``order_by``
    wins; without ``order_by`` a repeated incoming key fails the job.  A null in a
    key is a value like any other.  Written as ``existing`` anti-joined with the
    incoming keys, plus the incoming rows: applying the same incoming frame twice
    gives the same result as once.  Rows of ``existing`` without a null in their
    keys join on plain equality, which can use the table's buckets."""
    ks = _resolve(incoming, keys)
    if order_by:
        latest = dedupe(incoming, ks, order_by, keep="latest")
    else:
        rest = [c for c in incoming.columns if c not in ks]
        row = F.struct(*[col(c) for c in rest]) if rest else F.lit(0)
        once = incoming.groupBy(*[col(k) for k in ks]).agg(F.first(row).alias("__row"), F.count(F.lit(1)).alias("__n"))
        ok = F.assert_true(F.col("__n") == 1, F.lit("upsert: a key repeats among the incoming rows and order_by is not given"))
        latest = once.filter(ok.isNull()).select(*[col(k) for k in ks], *(["__row.*"] if rest else []))
    latest = latest.select(*[col(c) for c in existing.columns])
    new_keys = incoming.select(*[col(k).alias(f"__k{i}") for i, k in enumerate(ks)])
    es = _resolve(existing, ks)
    any_null, plain, safe = F.lit(False), F.lit(True), F.lit(True)
    for i, e in enumerate(es):
        any_null = any_null | existing[q(e)].isNull()
        plain = plain & (existing[q(e)] == F.col(f"__k{i}"))
        safe = safe & existing[q(e)].eqNullSafe(F.col(f"__k{i}"))
    kept = existing.filter(~any_null).join(new_keys, plain, "left_anti")
    kept_null = existing.filter(any_null).join(new_keys, safe, "left_anti")
    return kept.unionByName(kept_null).unionByName(latest)


def upsert_table(spark: SparkSession, table: str, incoming: DataFrame, keys: Sequence[str],
                 order_by: Sequence[str] | None = None, database: str | None = None,
                 buckets: int | None = None) -> str:
    """Upsert into a catalog table.  First load creates it (H1).  Otherwise the merged
    result goes to a staging table first (Spark refuses to overwrite a table the
    same plan reads); then the old table is renamed aside, the staging table
    renamed into place, and only then the old copy dropped.

    ``buckets``: store the table bucketed (and sorted) by the keys.  The anti join
    of the next upsert then reads the existing table in key buckets and shuffles
    only the incoming rows, instead of the whole table."""
    name = _full(database, table)
    ks = _resolve(incoming, keys)

    def write(df: DataFrame, target: str) -> None:
        w = df.write.format("parquet")
        if buckets:
            w = w.bucketBy(int(buckets), *ks).sortBy(*ks)
        w.saveAsTable(target)

    if not spark.catalog.tableExists(f"{database}.{table}" if database else table):
        write(upsert(incoming.limit(0), incoming, keys, order_by), name)
        return name
    merged = upsert(spark.table(name), incoming, keys, order_by)
    tag = uuid.uuid4().hex[:8]
    stage, old = _full(database, f"{table}__stage_{tag}"), _full(database, f"{table}__old_{tag}")
    write(merged, stage)
    # swap by renames: at every moment either the old or the new complete copy exists
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {stage} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE {old}")
    return name


# --------------------------------------------------------------------------- H4
def mart_name(value: str, prefix: str = "datamart_") -> str:
    """Table-safe name: lower case, runs of non-alphanumerics become '_'."""
    import re
    return prefix + re.sub(r"[^0-9a-z]+", "_", str(value).strip().lower()).strip("_")


def _write_parts(df: DataFrame, path: str, part_col: str, mode: str) -> None:
    """One pass, one folder per value. The rebalance hint gathers each value's rows into few
    files and splits a value that is too large for one task."""
    if mode not in ("all", "partitions"):
        raise ValueError("replace must be 'all' or 'partitions'")
    (df.hint("rebalance", col(part_col)).write.mode("overwrite")
     .option("partitionOverwriteMode", "static" if mode == "all" else "dynamic").partitionBy(part_col).parquet(path))


def build_marts(df: DataFrame, column: str, path: str, values: Sequence[str] | None = None,
                part_col: str = "mart", drop_source: bool = True, replace: str = "all") -> dict[str, DataFrame]:
    """One mart per value of ``column``, written in **one** pass partitioned by the
    normalised value (the reference scanned the input once per mart).

    Values are matched after normalising both sides (case, '-', spaces), so
    'North-East' and 'NORTHEAST' land in the same mart.  ``values`` restricts
    the marts; returns name -> frame, each reading only its own partition, empty
    if no row belongs to it.  A run replaces all marts below ``path``;
    ``replace="partitions"`` replaces only those it has rows for."""
    (c,) = _resolve(df, [column])
    if part_col in df.columns and part_col != c:
        raise ValueError(f"the data already has a column {part_col!r}; choose another part_col")
    norm = F.regexp_replace(F.lower(F.trim(col(c).cast("string"))), r"[^0-9a-z]+", "")
    out = df.withColumn(part_col, norm)
    if values is not None:
        wanted = sorted({mart_name(v, "").replace("_", "") for v in values})
        out = out.filter(F.col(part_col).isin(wanted))
    if drop_source and part_col != c:
        out = out.drop(c)
    _write_parts(out, path, part_col, replace)
    stored = df.sparkSession.read.schema(out.schema).parquet(path)  # a known schema: no files are needed to infer one
    if values is None:
        return {"*": stored}
    return {mart_name(v): stored.filter(F.col(part_col) == mart_name(v, "").replace("_", "")) for v in values}


def register_marts(spark: SparkSession, path: str, values: Sequence[str], database: str | None = None,
                   part_col: str = "mart", prefix: str = "datamart_") -> list[str]:
    """Catalog views ``<prefix><name>`` over the marts written by :func:`build_marts`.

    Each view reads only its own partition folder (partition pruning), so the
    per-region tables of the reference exist by name without a copy each."""
    names = []
    for v in values:
        name = mart_name(v, prefix)
        key = mart_name(v, "").replace("_", "")
        spark.sql(f"CREATE OR REPLACE VIEW {_full(database, name)} AS "
                  f"SELECT * FROM parquet.`{path}` WHERE {q(part_col)} = '{key}'")
        names.append(_full(database, name))
    return names


def write_split(df: DataFrame, column: str, path: str, replace: str = "all") -> str:
    """All splits of T5 in one pass: ``partitionBy(column)``. A run replaces all splits below
    ``path``; ``replace="partitions"`` only those it has rows for."""
    (c,) = _resolve(df, [column])
    _write_parts(df, path, c, replace)
    return path


# --------------------------------------------------------------------------- K2 / M20
def save_version(df: DataFrame, base: str, version: str | None = None, part_col: str = "version") -> str:
    """Save ``df`` as one version under ``base`` (a folder ``version=<v>``).

    Dynamic partition overwrite: re-saving the same version replaces only that
    version, other versions are untouched.  Default version: UTC yyyymmdd_HHMMSS."""
    v = version or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    _check_version(v)
    if part_col.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the data already has a column {part_col!r}; choose another part_col")
    (df.withColumn(part_col, F.lit(v)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(base))
    return v


def _check_version(v: str) -> None:
    import re
    if not re.fullmatch(r"[0-9A-Za-z_.-]+", v):
        raise ValueError(f"version {v!r}: use letters, digits, '_', '.' and '-'")


def read_version(spark: SparkSession, base: str, version: str | None = None, part_col: str = "version") -> DataFrame:
    """One version with its own columns (only its folder is read), or all with ``version=None``:
    the columns of all versions, null where a version lacks them, and ``part_col`` as text."""
    if version is not None:
        _check_version(version)
        return spark.read.parquet(f"{base.rstrip('/')}/{part_col}={version}")
    found = spark.read.option("mergeSchema", "true").parquet(base).schema
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == part_col else f for f in found.fields])
    return spark.read.schema(schema).parquet(base)


def list_versions(spark: SparkSession, base: str, part_col: str = "version") -> DataFrame:
    """Versions present under ``base`` with their row counts."""
    return read_version(spark, base, None, part_col).groupBy(part_col).agg(F.count(F.lit(1)).alias("rows"))
