"""File sources and sinks (S1-S4, S6, K1)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet",
               schema: T.StructType | str | None = None, header: bool = True,
               null_value: str | None = None, sep: str = ",", infer_schema: bool = False,
               options: Mapping[str, str] | None = None) -> DataFrame:
    """Read csv / parquet / json / orc / text.

    CSV: give ``schema`` (inference scans the data an extra time and guesses);
    ``null_value`` is the token read as null (e.g. "NA").  Parquet and ORC carry
    their schema; filters and projections applied later reach the scan."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", str(header).lower()).option("sep", sep)
        if null_value is not None:
            r = r.option("nullValue", null_value)
        if schema is None:
            r = r.option("inferSchema", str(infer_schema).lower())
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path if isinstance(path, str) else list(path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None,
                replace: str = "all") -> str:
    """Write ``df``; returns the path.  ``mode="errorifexists"`` refuses to clobber a
    previous run; re-runnable jobs use "overwrite", which replaces everything below the
    path.  For partitioned writes ``replace="partitions"`` replaces only the partitions
    that ``df`` has rows for."""
    if replace not in ("all", "partitions"):
        raise ValueError("replace must be 'all' or 'partitions'")
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
        if mode == "overwrite":
            w = w.option("partitionOverwriteMode", "static" if replace == "all" else "dynamic")
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)
    return path


def file_stats(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """One row per file under ``path``: file_path, size_kb, rows.

    From the file source's hidden ``_metadata`` column: no filesystem calls on
    the driver, and the row count comes with it in the same scan."""
    df = read_table(spark, path, fmt, schema=schema, options=options)
    return (df.select(F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("size"))
            .groupBy("file_path")
            .agg((F.first("size") / F.lit(1024.0)).alias("size_kb"), F.count(F.lit(1)).alias("rows")))
