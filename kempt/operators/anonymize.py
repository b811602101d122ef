"""Release control (C20): k-anonymity by recursive median cuts, all groups of a level at once.

Rows are counted by their quasi-identifiers, and every value becomes its rank among the different
values of its column.  Groups of tuples are then cut at the median of one column, level by
level, as long as both sides keep k rows.  The medians of all groups and columns come from
histograms over the leading bits of the ranks, then over the next bits inside the bucket
that holds the middle: exact, deterministic, and a group is never gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kempt.functions.columns import col, free_name
from kempt.operators.cleanse import _resolve
from kempt.session import materialize

_BITS = 10  # of a rank looked at in one pass: at most 1,024 buckets for a group and column
_FEW = 2048  # rows up to which a table of groups or values is sent to every task


def _held(table: DataFrame, rows: int) -> DataFrame:
    """``table`` of ``rows`` rows, for a join: a small one goes to every task (a few hot groups or values
    then need no shuffle), a larger one is shuffled, so that nothing that grows passes the driver."""
    return F.broadcast(table) if rows <= _FEW else table.hint("merge")


def _ranks(tuples: DataFrame, c: str, i: int) -> DataFrame:
    """(v, o): the different values of ``c`` and their places in ascending order, null first, to be joined."""
    rows = tuples.select(F.col(c).alias("v")).distinct().repartitionByRange(F.asc_nulls_first("v")).sortWithinPartitions(F.asc_nulls_first("v"))
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # its upper bits are the partition
    rows = materialize(rows.select("v", F.spark_partition_id().alias("pid"), nth.alias("nth")), f"values-{i}")
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("pid").agg(F.count(F.lit(1)).alias("n"))  # one row for each partition
    offsets = sizes.select("pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return _held(rows.join(F.broadcast(offsets), "pid").select("v", (F.col("before") + F.col("nth")).alias("o")), rows.count())


def _medians(long: DataFrame, top: int, groups: int) -> DataFrame:
    """(path, dim, m, below, at, total) for ``long`` (path, dim, o, n): the rank m at which half of
    the rows are reached, and the rows below and at it; ``top`` is the largest rank, ``groups`` the
    number of (path, dim)."""
    shift = max(0, -(-max(1, top.bit_length()) // _BITS) - 1) * _BITS
    keys = ["path", "dim"]
    running = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = None
    while True:
        rows = long.withColumn("b", F.shiftright("o", shift))
        if found is not None:
            rows = rows.join(_held(found, groups), [*keys]).filter(F.shiftright("b", _BITS) == F.col("m"))
        kept = [] if found is None else ["below", "total"]
        hist = rows.groupBy(*keys, *kept, "b").agg(F.sum("n").alias("c"))
        if found is None:
            hist = hist.withColumns({"below": F.lit(0).cast("bigint"), "total": F.sum("c").over(Window.partitionBy(*keys))})
        upto = F.col("below") + F.sum("c").over(running)
        hist = hist.withColumn("upto", upto)
        middle = (F.col("upto") * 2 >= F.col("total")) & ((F.col("upto") - F.col("c")) * 2 < F.col("total"))
        found = hist.filter(middle).select(*keys, F.col("b").alias("m"), (F.col("upto") - F.col("c")).alias("below"), "total", F.col("c").alias("at"))
        if not shift:
            return found
        shift -= _BITS
        found = found.drop("at")


def _cuts(active: DataFrame, dims: int, k: int, top: int, groups: int) -> DataFrame:
    """(path, dim, cut): for each group that can be cut the column and the rank up to which its rows
    go to the first side; the cut whose smaller side is largest, ties to the first column and the lower cut."""
    long = active.select("path", "n", F.posexplode(F.array(*[F.col(f"o{i}") for i in range(dims)])).alias("dim", "o"))
    long = long.groupBy("path", "dim", "o").agg(F.sum("n").alias("n"))
    m = _medians(long, top, groups * dims)
    sides = [F.struct((-F.least(first, F.col("total") - first)).alias("less"), F.col("dim").alias("dim"), cut.alias("cut"))
             for first, cut in ((F.col("below") + F.col("at"), F.col("m")), (F.col("below"), F.col("m") - 1))]
    best = m.groupBy("path").agg(F.min(F.least(*sides)).alias("best"))
    return best.filter(-F.col("best.less") >= k).select("path", "best.dim", "best.cut")


def k_anonymous(df: DataFrame, quasi: Sequence[str], k: int, prefix: str = "group") -> DataFrame:
    """``df`` with each quasi-identifier c replaced by c_low, c_high (smallest and largest value of
    the row's group, null if it has none but null) and c_null (whether the group has nulls), and with
    ``<prefix>_id`` and ``<prefix>_rows`` at the end: every group has at least ``k`` rows.

    Groups are those of recursive cuts at the median, made as long as some column has a cut that
    leaves ``k`` rows on both sides; equal values of a column stay together in a cut.  The same
    rows give the same groups under any partitioning.  Null is a value before all others, NaN the
    largest number.  Rows are kept, repeated ones too; fewer than ``k`` rows are refused, no rows give
    none.  Quasi-identifiers have to be of types that Spark sorts."""
    names = _resolve(df, quasi)
    if k < 1 or not names:
        raise ValueError("k must be at least 1 and there must be a quasi-identifier")
    dims = len(names)
    tuples = materialize(df.groupBy(*[col(c).alias(f"q{i}") for i, c in enumerate(names)]).agg(F.count(F.lit(1)).alias("n")), "tuples")
    rows = tuples.agg(F.sum("n")).first()[0]
    if rows is not None and rows < k:
        raise ValueError(f"{rows} rows cannot make a group of {k}")
    active = tuples
    for i in range(dims):
        active = active.join(_ranks(tuples, f"q{i}", i).withColumnRenamed("o", f"o{i}"), F.col(f"q{i}").eqNullSafe(F.col("v"))).drop("v")
    active = materialize(active.withColumn("path", F.lit("")), "level")
    top = active.agg(F.greatest(*[F.coalesce(F.max(f"o{i}"), F.lit(0)) for i in range(dims)], F.lit(0))).first()[0]
    finished, groups, whole = [], 1, 1  # groups of this level, and all
    while True:
        cuts = materialize(_cuts(active, dims, k, top, groups), "cuts")
        cut = cuts.count()
        if not cut:
            finished.append(active)
            break
        groups, whole = 2 * cut, whole + cut
        cuts = _held(cuts, cut)
        finished.append(active.join(cuts, "path", "left_anti"))
        o = F.get(F.array(*[F.col(f"o{i}") for i in range(dims)]), F.col("dim"))
        side = F.when(o <= F.col("cut"), "0").otherwise("1")
        active = materialize(active.join(cuts, "path").withColumn("path", F.concat("path", side)).drop("dim", "cut"), "level")
    cells = finished[0]
    for f in finished[1:]:
        cells = cells.unionByName(f)
    cells = materialize(cells.select("path", "n", *[f"q{i}" for i in range(dims)]), "groups")
    facts = cells.groupBy("path").agg(F.sum("n").alias("rows"), *[
        F.struct(F.min(f"q{i}").alias("low"), F.max(f"q{i}").alias("high"), F.max(F.col(f"q{i}").isNull()).alias("null")).alias(f"g{i}") for i in range(dims)])
    held = free_name("held", *df.columns)
    of = cells.drop("n").join(_held(facts, whole), "path").select(F.struct("*").alias(held)).hint("merge")
    same = F.lit(True)
    for i, c in enumerate(names):
        same = same & col(c).eqNullSafe(F.col(f"{held}.q{i}"))
    out = []
    for c in df.columns:
        i = names.index(c) if c in names else None
        out += [col(c)] if i is None else [F.col(f"{held}.g{i}.{f}").alias(f"{c}_{f}") for f in ("low", "high", "null")]
    return df.join(of, same).select(*out, F.col(f"{held}.path").alias(f"{prefix}_id"), F.col(f"{held}.rows").alias(f"{prefix}_rows"))
