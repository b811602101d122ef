"""Which columns refer to which (C17): unary inclusion dependencies found in the data.

Every value of every column becomes one bit, that of its column, in a row keyed by the value's
digest; an ``or`` by value, combined where the rows are read, gives the set of columns a value
occurs in.  Values with the same set are then counted, and all pairs of columns are judged from
those few counts: one shuffle of values in place of an anti join for every pair.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kempt.functions.columns import col, is_fractional, is_string
from kempt.operators.quality import _pairs

_BITS = 62  # columns to a mask, below the sign


def _kind(dt: T.DataType) -> str:
    """Columns of one kind can hold the same value: all integers, all text, both fractions."""
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if is_string(dt):
        return "text"
    return "fraction" if is_fractional(dt) else dt.simpleString()


def inclusions(tables: Mapping[str, DataFrame], min_share: float = 1.0) -> DataFrame:
    """One row for every pair of columns of one kind of which the first has at least ``min_share`` of
    its different values in the second: dependent, referenced (``table.column``), distinct_values,
    shared_values, share, referenced_unique (no value of the second repeats, so it can be a key).

    ``min_share`` 1: inclusion dependencies, candidates for foreign keys; below: those that a few bad
    values break.  Nulls are no values, a column without values depends on nothing; NaN is a value,
    both zeros are one.  Values are compared by digests of 128 bits (64 for fractions, where they are
    one to one).  The same column of the same table is not compared with itself."""
    if not 0 < min_share <= 1:
        raise ValueError("min_share must be above 0 and at most 1")
    names, kinds, values, counts = [], [], None, None
    for table, df in tables.items():
        first = len(names)
        names += [f"{table}.{f.name}" for f in df.schema.fields]
        kinds += [_kind(f.dataType) for f in df.schema.fields]
        if len(names) == first:
            continue
        pairs = _pairs(df, df.columns).select((F.col("i") + F.lit(first)).alias("i"), "a", "b").filter("a IS NOT NULL")
        one = df.agg(*[F.struct(F.lit(first + i).alias("i"), F.count(col(c)).alias("filled")).alias(f"c{i}") for i, c in enumerate(df.columns)])
        one = one.select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(df.columns))])))
        values = pairs if values is None else values.unionByName(pairs)
        counts = one if counts is None else counts.unionByName(one)
    if values is None:
        raise ValueError("no columns")
    order = sorted(set(kinds))
    kind = F.get(F.lit([order.index(k) for k in kinds]), F.col("i"))
    words = range(-(-len(names) // _BITS))

    def bit(i: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(i, F.lit(_BITS)))

    masks = [F.bit_or(F.when(F.floor(F.col("i") / _BITS) == w, bit(F.col("i"))).otherwise(F.lit(0).cast("bigint"))).alias(f"m{w}") for w in words]
    by_value = values.withColumn("kind", kind).groupBy("kind", "a", "b").agg(*masks)
    by_set = by_value.groupBy(*[f"m{w}" for w in words]).agg(F.count(F.lit(1)).alias("n"))
    members = F.expr(f"filter(sequence(0, {len(names) - 1}), x -> "
                     f"get(array({', '.join(f'm{w}' for w in words)}), CAST(floor(x / {_BITS}) AS INT)) & shiftleft(1L, x % {_BITS}) <> 0)")
    # pairs of column numbers, summed up by set first: at most the square of the number of columns
    sets = by_set.select("n", members.alias("members")).select("n", "members", F.explode("members").alias("d"))
    shared = sets.select("n", "d", F.explode("members").alias("r")).groupBy("d", "r").agg(F.sum("n").alias("shared_values"))
    own = shared.filter("d = r").select(F.col("d").alias("i"), F.col("shared_values").alias("distinct_values"))
    facts = own.join(counts, "i").select("i", "distinct_values", (F.col("filled") == F.col("distinct_values")).alias("unique"))
    d = facts.select(F.col("i").alias("d"), "distinct_values")
    r = facts.select(F.col("i").alias("r"), F.col("unique").alias("referenced_unique"))
    share = F.col("shared_values") / F.col("distinct_values")
    text = F.lit(names)
    return (shared.filter("d <> r").join(d, "d").join(r, "r").withColumn("share", share).filter(F.col("share") >= F.lit(min_share))
            .select(F.get(text, F.col("d")).alias("dependent"), F.get(text, F.col("r")).alias("referenced"),
                    "distinct_values", "shared_values", "share", "referenced_unique"))
