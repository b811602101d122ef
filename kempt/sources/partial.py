"""Keyed upserts that rewrite only the partitions they touch (H2, H3).

The table is a folder of Parquet partitions by a hash of the key. An upsert finds the
partitions of its incoming keys, reads only those (partition pruning), and replaces only those
(dynamic partition overwrite); the files of all others stay as they are. The partition
column's name holds the number of partitions, so a table tells its own layout.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kempt.functions.columns import col
from kempt.operators.cleanse import _resolve
from kempt.session import materialize, path_delete, path_exists
from kempt.sources.tables import upsert

_PART = "key_part_of_"


def key_part(keys: Sequence[str], parts: int) -> Column:
    """The partition of a key; a null is a value like any other, so it is hashed as one."""
    flags = [x for k in keys for x in (col(k).isNull(), col(k))]
    return F.pmod(F.xxhash64(*flags), F.lit(parts)).cast("int")


def _layout(df: DataFrame) -> tuple[str, int]:
    for c in df.columns:
        if m := re.fullmatch(_PART + r"(\d+)", c):
            return c, int(m[1])
    raise ValueError("the folder holds no table laid out by key")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The table below ``path`` without its partition column. An upsert that was cut off while it
    replaced partitions is finished first."""
    recover(spark, path)
    df = spark.read.parquet(path)
    return df.drop(_layout(df)[0])


def _replace(staged: DataFrame, part: str, path: str) -> None:
    """Replace the partitions that ``staged`` has rows for."""
    (staged.hint("rebalance", col(part)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part).parquet(path))


def recover(spark: SparkSession, path: str) -> bool:
    """Finish an upsert whose new partitions were complete but not all in place; true if there was one."""
    waiting = f"{path.rstrip('/')}/_staged"  # readers pass over names that begin with _
    if not path_exists(spark, f"{waiting}/_SUCCESS"):
        return False
    staged = spark.read.parquet(waiting)
    _replace(staged, _layout(staged)[0], path)
    path_delete(spark, waiting)
    return True


def upsert_partitions(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str],
                      order_by: Sequence[str] | None = None, parts: int = 256) -> list[int]:
    """Insert new keys and replace existing ones; returns the numbers of the partitions rewritten.

    The first call creates the table with ``parts`` partitions; later ones keep its layout, its
    columns and their types.  Keys, repeated incoming keys, ``order_by`` and nulls are as in
    :func:`kempt.sources.tables.upsert`; always pass the same ``keys``.

    What reaches the driver are the touched partition numbers (at most ``parts``).  The new
    partitions are written completely, below the table's own folder where readers do not look,
    before the first old one is replaced: a failed job leaves the table as it was, and a driver
    lost during the replacement leaves a copy that the next call finishes (:func:`recover`).
    Readers see single partitions change.  One writer at a time."""
    ks = _resolve(incoming, keys)
    recover(spark, path)
    old = _stored(spark, path)
    if old is None:
        part = f"{_PART}{parts}"
        rows = upsert(incoming.limit(0), incoming, ks, order_by)
        (rows.withColumn(part, key_part(ks, parts)).hint("rebalance", col(part)).write.mode("overwrite").partitionBy(part).parquet(path))
        return sorted(r[0] for r in spark.read.parquet(path).select(part).distinct().collect())
    part, parts = _layout(old)
    types = {f.name.lower(): f.dataType for f in old.schema.fields}
    ks = _resolve(old, ks)
    # types as stored, so that a key hashes to the partition it was stored in
    typed = incoming.select(*[col(c).cast(types.get(c.lower(), incoming.schema[c].dataType)).alias(c) for c in incoming.columns])
    batch = materialize(typed.withColumn(part, key_part(ks, parts)), "upsert-batch")
    touched = sorted(r[0] for r in batch.select(part).distinct().collect())
    if not touched:
        return []
    merged = upsert(old.filter(col(part).isin(touched)), batch, ks, order_by)
    waiting = f"{path.rstrip('/')}/_staged"
    merged.write.mode("overwrite").parquet(waiting)
    recover(spark, path)
    spark.catalog.refreshByPath(path)
    return touched
