"""Rows that do not fit their schema, kept apart instead of lost (S1, S2).

Spark's permissive parsers keep the text of a record that they cannot read in a column of its own.
Rows are parsed once, whole, and written once; good rows and records to look at are two reads of
that copy, so together they are always the input, whatever columns a later query asks for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kempt.functions.columns import col, free_name
from kempt.session import materialize

FORMATS = ("csv", "json")


def with_record(schema: T.StructType | str) -> tuple[T.StructType, str]:
    """``schema`` with a text column for unreadable records, and that column's name."""
    s = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    name = free_name("record", *s.fieldNames())
    return T.StructType([*s.fields, T.StructField(name, T.StringType())]), name


def parser_options(fmt: str, record: str, header: bool = True, null_value: str | None = None, sep: str = ",",
                   options: Mapping[str, str] | None = None) -> dict[str, str]:
    """Reader options under which every record comes back, as values or as text."""
    if fmt not in FORMATS:
        raise ValueError(f"records of {fmt!r} files are not text; use one of {FORMATS}")
    out = {str(k): str(v) for k, v in (options or {}).items()}
    if fmt == "csv":
        # names of the header are not compared row by row; parsing all columns finds every bad value
        out |= {"header": str(header).lower(), "sep": sep, "enforceSchema": "true", "columnPruning": "false"}
        if null_value is not None:
            out["nullValue"] = null_value
    return out | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": record}


def reason(df: DataFrame, record: str, required: Sequence[str]) -> Column:
    """Why a row is kept apart: ``malformed``, ``missing <column>``, or null for a good row."""
    why = F.when(col(record).isNotNull(), F.lit("malformed"))
    for c in required:
        why = why.when(col(c).isNull(), F.lit(f"missing {c}"))
    return why


def split_rows(df: DataFrame, record: str, required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of a stored frame with the column ``record``. ``bad``: reason, record (the
    text as it was read; for a readable row its values as JSON), file."""
    why = reason(df, record, required)
    good_cols = [c for c in df.columns if c not in (record, "file")]
    good = df.filter(why.isNull()).select(*[col(c) for c in good_cols])
    text = F.coalesce(col(record), F.to_json(F.struct(*[col(c) for c in good_cols])))
    return good, df.filter(why.isNotNull()).select(why.alias("reason"), text.alias("record"), F.col("file"))


def read_quarantined(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, fmt: str = "csv",
                     header: bool = True, null_value: str | None = None, sep: str = ",", required: Sequence[str] = (),
                     options: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, bad): the rows of text files that fit ``schema``, with its columns, and those that do
    not: reason, record, file.

    A record is bad if a value does not parse as its type, if it has too few or too many values, if
    it is not JSON, or if a column of ``required`` is null.  The rows of both frames together are the
    records of the input.  A schema column named ``file`` is refused."""
    full, record = with_record(schema)
    if "file" in [n.lower() for n in full.fieldNames()]:
        raise ValueError("a column named 'file' would hide where a record came from")
    df = spark.read.format(fmt).schema(full).options(**parser_options(fmt, record, header, null_value, sep, options))
    rows = df.load(path if isinstance(path, str) else list(path)).select("*", F.col("_metadata.file_path").alias("file"))
    return split_rows(materialize(rows, "parsed"), record, required)
