"""Row-wise derivations: new columns from existing ones, all built-in expressions."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kempt.functions.columns import col, free_name, guarded_cast
from kempt.operators.cleanse import _resolve
from kempt.operators.stats import _with


# --------------------------------------------------------------------------- M7 / M17 / T12
def derive(df: DataFrame, exprs: Mapping[str, str | Column]) -> DataFrame:
    """Add or replace columns from SQL expression text (or Columns), in one projection.

    SQL text is parsed by Spark (``F.expr``), never evaluated as Python."""
    return _with(df, {k: (F.expr(v) if isinstance(v, str) else v) for k, v in exprs.items()})


# --------------------------------------------------------------------------- M5
def parse_address(df: DataFrame, column: str, parts: Sequence[str] = ("street", "city", "postal_code"),
                  sep: str = r",\s*") -> DataFrame:
    """Split an address on ``sep`` into the named parts; missing parts are null.

    ``F.get`` returns null past the end of the array (``getItem`` raises under ANSI)."""
    (c,) = _resolve(df, [column])
    arr = F.split(col(c), sep)
    return _with(df, {p: F.get(arr, i) for i, p in enumerate(parts)})


# --------------------------------------------------------------------------- M12 / D4
def concat_cols(df: DataFrame, cols: Sequence[str], out: str, sep: str = "", null_safe: bool = False) -> DataFrame:
    """``out`` = the columns' text joined by ``sep``.

    By default any null makes the result null (``concat``, as the reference);
    ``null_safe=True`` skips nulls instead (``concat_ws``)."""
    cs = [col(c).cast("string") for c in _resolve(df, cols)]
    if null_safe:
        v = F.concat_ws(sep, *cs)
    elif sep:
        parts: list[Column] = []
        for i, c in enumerate(cs):
            parts += ([F.lit(sep)] if i else []) + [c]
        v = F.concat(*parts)
    else:
        v = F.concat(*cs)
    return _with(df, {out: v})


# --------------------------------------------------------------------------- T10
def encode_map(df: DataFrame, spec: Mapping[str, Mapping[object, int]]) -> DataFrame:
    """One indicator column per code: ``<col>_encoded_<code>`` holds ``code`` where the column
    equals one of the values with that code, else 0 (null input gives 0)."""
    new = {}
    for name, m in spec.items():
        (c,) = _resolve(df, [name])
        for code in dict.fromkeys(m.values()):
            values = [v for v, k in m.items() if k == code]
            new[f"{c}_encoded_{code}"] = F.when(col(c).isin(values), F.lit(code)).otherwise(F.lit(0))
    return _with(df, new)


def one_hot(df: DataFrame, column: str, values: Sequence[object], prefix: str | None = None) -> DataFrame:
    """``<prefix>_<value>`` = 1 where the column equals the value, else 0 (also for null).

    The value list is given, so no job runs to discover it."""
    (c,) = _resolve(df, [column])
    p = prefix if prefix is not None else c
    return _with(df, {f"{p}_{v}": F.when(col(c) == F.lit(v), F.lit(1)).otherwise(F.lit(0)) for v in values})


def label_index(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """``<col>_index``: 0 for the most frequent label, 1 for the next, ...; ties by label
    ascending; null stays null (the order ``StringIndexer`` calls frequencyDesc, with an
    explicit tie rule).

    Distributed: labels are counted (partial aggregation), range-sorted by (count
    desc, label), written once with their partition id, and numbered as offset of
    the partition (from a table with one row per partition) plus the position inside
    it.  No task holds more than one sorted partition; the labels never reach the driver."""
    from pyspark.sql import Window

    from kempt.session import materialize
    (c,) = _resolve(df, [column])
    counts = (df.filter(col(c).isNotNull()).groupBy(col(c).alias("__label"))
              .agg(F.count(F.lit(1)).alias("__n")))
    order = [F.col("__n").desc(), F.col("__label").asc()]
    staged = materialize(counts.orderBy(*order).withColumn("__pid", F.spark_partition_id()), "label-index")
    sizes = staged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__pid", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy("__pid").orderBy(*order)
    idx = (staged.join(F.broadcast(offsets), "__pid")
           .select("__label", (F.col("__off") + F.row_number().over(inside) - 1).cast("bigint").alias("__idx")))
    name = out or f"{c}_index"
    label, place = free_name("label", *df.columns), free_name("idx", *df.columns)
    idx = idx.select(F.col("__label").alias(label), F.col("__idx").alias(place))
    j = df.join(idx, col(c) == F.col(label), "left")
    return j.select(*[col(x) for x in df.columns], F.col(place).alias(name))


# --------------------------------------------------------------------------- T13
def bin_col(df: DataFrame, column: str, splits: Sequence[float], labels: Sequence[str],
            out: str | None = None, other: str = "Unknown") -> DataFrame:
    """Label each value with its bin: ``splits[i] <= x < splits[i+1]`` gets ``labels[i]``;
    the last bin is closed on the right.  Null and out-of-range values get ``other``
    (``Bucketizer`` would raise on them)."""
    if len(labels) != len(splits) - 1:
        raise ValueError("need one label per bin (len(splits) - 1)")
    (c,) = _resolve(df, [column])
    x = col(c)
    expr = None
    n = len(labels)
    for i, lab in enumerate(labels):
        lo, hi = F.lit(splits[i]), F.lit(splits[i + 1])
        cond = (x >= lo) & ((x <= hi) if i == n - 1 else (x < hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return _with(df, {out or f"{c}_bins": expr.otherwise(F.lit(other))})


# --------------------------------------------------------------------------- T17
def age_from_bracket(df: DataFrame, column: str, as_of: _dt.date | str, out: str = "Age") -> DataFrame:
    """``out`` = year(as_of) - the number in the first two characters of ``column``.

    The reference used ``current_date()``; an explicit date keeps results repeatable.
    Text without two leading digits gives null (``try_cast``), not a failed job."""
    (c,) = _resolve(df, [column])
    day = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))
    lead = guarded_cast(F.substring(col(c).cast("string"), 1, 2), "int")
    return _with(df, {out: F.lit(day.year) - lead})


# --------------------------------------------------------------------------- T19
def extract_pattern(df: DataFrame, spec: Mapping[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """For each column, a regex and output names: output i = capture group i+1 ('' if no match)."""
    new = {}
    for name, (regex, outs) in spec.items():
        (c,) = _resolve(df, [name])
        for i, o in enumerate(outs):
            new[o] = F.regexp_extract(col(c), regex, i + 1)
    return _with(df, new)


def extract_all(df: DataFrame, column: str, regex: str, out: str, group: int = 0) -> DataFrame:
    """``out`` = array of every match of ``regex`` (or of capture ``group``) in the column."""
    (c,) = _resolve(df, [column])
    return _with(df, {out: F.regexp_extract_all(col(c), F.lit(regex), F.lit(group))})


def json_fields(df: DataFrame, column: str, paths: Mapping[str, str]) -> DataFrame:
    """Pull fields out of JSON text: ``{out: "$.a.b"}``; missing paths and bad JSON give null."""
    (c,) = _resolve(df, [column])
    return _with(df, {o: F.get_json_object(col(c), p) for o, p in paths.items()})


# --------------------------------------------------------------------------- T12 (as named)
def agg_timeframe(df: DataFrame, ts: str, grain: str, by: Sequence[str] = (),
                  aggs: Mapping[str, tuple[str, str]] | None = None, out: str = "period") -> DataFrame:
    """Aggregate per time bucket: ``grain`` is a ``date_trunc`` unit (year, quarter, month,
    week, day, hour, minute).  ``aggs`` as in :func:`kempt.operators.relate.aggregate`."""
    from kempt.operators.relate import aggregate  # local: relate imports derive helpers
    (t,) = _resolve(df, [ts])
    dt = df.schema[t].dataType.simpleString()
    bucket = F.date_trunc(grain, col(t))
    if dt == "timestamp_ntz":
        bucket = bucket.cast("timestamp_ntz")
    keyed = df.withColumn(out, bucket)
    return aggregate(keyed, [out, *by], aggs or {"n": ("count", "*")})
