"""Relational operators: filters, projections, joins, aggregation, reshaping, sampling,
reconciliation and lookups.  All lazy except ``transpose``'s row guard."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kempt.functions.columns import col, free_name, q
from kempt.operators.cleanse import _resolve


# --------------------------------------------------------------------------- M14 / M16
def where(df: DataFrame, predicate: str | Column) -> DataFrame:
    """Keep rows where the predicate (SQL text or Column) is true; pushed to the scan by Catalyst."""
    return df.filter(F.expr(predicate) if isinstance(predicate, str) else predicate)


def where_cmp(df: DataFrame, column: str, op: str, value) -> DataFrame:
    """``column <op> value`` with op in = != > >= < <= (the config form of M14/M16)."""
    (c,) = _resolve(df, [column])
    x, v = col(c), F.lit(value)
    ops = {"=": x == v, "==": x == v, "!=": x != v, ">": x > v, ">=": x >= v, "<": x < v, "<=": x <= v}
    if op not in ops:
        raise ValueError(f"unknown comparison {op!r}")
    return df.filter(ops[op])


# --------------------------------------------------------------------------- T14
def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Select columns by name; the scan then reads only these (column pruning)."""
    return df.select(*[col(c) for c in _resolve(df, cols)])


# --------------------------------------------------------------------------- T3
def sort_by(df: DataFrame, keys: Sequence[tuple[str, bool, bool] | tuple[str, bool] | str]) -> DataFrame:
    """Total order by keys ``(name, ascending=True, nulls_first=ascending)``.

    A global sort range-partitions the data (sampled bounds), so it scales out."""
    return df.orderBy(*_order(df, keys))


def _order(df: DataFrame, keys) -> list[Column]:
    out = []
    for k in keys:
        name, asc, nulls_first = (k, True, None) if isinstance(k, str) else (tuple(k) + (None,))[:3]
        (c,) = _resolve(df, [name])
        nf = asc if nulls_first is None else nulls_first
        x = col(c)
        if asc:
            out.append(x.asc_nulls_first() if nf else x.asc_nulls_last())
        else:
            out.append(x.desc_nulls_first() if nf else x.desc_nulls_last())
    return out


def top_k(df: DataFrame, n: int, keys) -> DataFrame:
    """First ``n`` rows in key order.  Planned as TakeOrderedAndProject: each task keeps
    its own top n, only n rows per task reach the final merge."""
    return df.orderBy(*_order(df, keys)).limit(n)


# --------------------------------------------------------------------------- T4
_HOWS = {"inner", "left", "right", "full", "left_semi", "left_anti", "cross",
         "outer", "left_outer", "right_outer", "full_outer", "semi", "anti"}


def merge(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column, how: str = "inner",
          broadcast: bool = False, salt_buckets: int = 0) -> DataFrame:
    """Join two frames.

    ``broadcast=True`` hints the right side; use it only for a side whose size
    is bounded by construction.  Without it, Spark broadcasts only what it
    measures under ``spark.sql.autoBroadcastJoinThreshold`` (at runtime, with AQE)
    and otherwise shuffles both sides on the key; AQE also splits skewed
    partitions.  A full join on column names is planned as a left join plus the right
    rows without a match, because AQE cannot split a full join.

    ``salt_buckets=n`` (inner, left, semi, anti) deals with keys too hot for that split:
    keys that hold more than one n-th of the left rows (fewer than n of them) are found
    by a count; their left rows are spread over n tasks by their position, whatever
    they contain, and only their right rows are copied n times. All other rows join as
    usual. A row that is computed again may get another salt, which changes nothing, as
    the right rows are there for every salt."""
    if how not in _HOWS:
        raise ValueError(f"unknown join type {how!r}")
    if how == "cross":
        raise ValueError("cross joins are not offered: they emit every pair")
    r = F.broadcast(right) if broadcast else right
    names = [on] if isinstance(on, str) else list(on) if isinstance(on, (list, tuple)) else []
    names = names if all(isinstance(n, str) for n in names) else []
    if salt_buckets and salt_buckets > 1:
        if how not in ("inner", "left", "left_outer", "left_semi", "left_anti", "semi", "anti"):
            raise ValueError("salting applies to inner, left, semi and anti joins")
        if not names:
            raise ValueError("salting needs join column names")
        n = int(salt_buckets)
        size, one, most = (free_name(x, *names) for x in ("n", "one", "limit"))
        counts = left.groupBy(*[col(c) for c in names]).agg(F.count(F.lit(1)).alias(size))
        limit = left.agg(F.lit(1).alias(one), (F.count(F.lit(1)) / F.lit(n)).alias(most))
        hot = (counts.withColumn(one, F.lit(1)).join(F.broadcast(limit), one)
               .filter((F.col(size) > F.col(most)) & F.expr(" AND ".join(f"{q(c)} IS NOT NULL" for c in names))))
        hot = F.broadcast(hot.select(*[col(c) for c in names]))
        salt, extra = F.pmod(F.monotonically_increasing_id(), F.lit(n)), free_name("salt", *left.columns, *right.columns)
        lhot = left.join(hot, names, "left_semi").withColumn(extra, salt)
        rhot = right.join(hot, names, "left_semi").withColumn(extra, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))
        hot_rows = lhot.join(rhot, [*names, extra], how).drop(extra)
        return left.join(hot, names, "left_anti").join(r, names, how).union(hot_rows)
    if how in ("full", "outer", "full_outer") and names:
        others = {c.lower() for c in left.columns} & {c.lower() for c in right.columns} - {c.lower() for c in names}
        if not others:
            unmatched = right.join(left.select(*[col(c) for c in names]).distinct(), names, "left_anti")
            return left.join(r, names, "left").unionByName(unmatched, allowMissingColumns=True)
    return left.join(r, on, how)


# --------------------------------------------------------------------------- M19 / D1
_AGGS = {
    "sum": F.sum, "avg": F.avg, "mean": F.avg, "min": F.min, "max": F.max,
    "count": F.count, "count_distinct": F.count_distinct, "approx_count_distinct": F.approx_count_distinct,
    "stddev": F.stddev_samp, "stddev_pop": F.stddev_pop, "variance": F.var_samp,
    "approx_median": lambda c: F.percentile_approx(c, 0.5), "first": F.first, "last": F.last,
}


def agg_expr(fn: str, column: str) -> Column:
    if fn not in _AGGS:
        raise ValueError(f"unknown aggregate {fn!r}")
    if column == "*":
        if fn != "count":
            raise ValueError("'*' only with count")
        return F.count(F.lit(1))
    return _AGGS[fn](col(column))


def aggregate(df: DataFrame, by: Sequence[str], aggs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``groupBy(by).agg(out=fn(column), ...)``; all aggregates here combine partially map-side.

    ``median`` is exact: values are counted by group and value (partial aggregation), and a
    running count over those near the approximate middle finds the exact one, so no task sorts
    a group or holds its values in memory as Spark's own exact percentile does. ``approx_median`` needs one aggregation only."""
    names = _resolve(df, by) if by else []
    aggs = {out: (fn, c if c == "*" else _resolve(df, [c])[0]) for out, (fn, c) in aggs.items()}
    plain = {out: agg_expr(fn, c).alias(out) for out, (fn, c) in aggs.items() if fn != "median"}
    medians = {out: c for out, (fn, c) in aggs.items() if fn == "median"}
    if not medians:
        return df.groupBy(*[col(k) for k in names]).agg(*plain.values())
    keys, by_cols = _keyed(names)
    res = df.groupBy(*by_cols).agg(*plain.values(), F.count(F.lit(1)).alias("__rows"))
    for i, (out, c) in enumerate(medians.items()):
        m = _group_median(df, names, c).select(*[F.col(k).alias(f"__m{i}_{k}") for k in keys], F.col("__median").alias(out))
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).eqNullSafe(F.col(f"__m{i}_{k}"))
        res = res.join(m, cond, "left")
    return res.select(*[F.col(x).alias(k) for k, x in zip(names, keys, strict=False)], *[F.col(out) for out in aggs])


def _keyed(names: Sequence[str]) -> tuple[list[str], list[Column]]:
    """Internal key names and the columns behind them; without keys one constant key."""
    cols = [col(k) for k in names] or [F.lit(0)]
    keys = [f"__k{i}" for i in range(len(cols))]
    return keys, [c.alias(k) for c, k in zip(cols, keys, strict=True)]


#: Of the approximate percentiles that bracket a median: their rank error is at most n / accuracy.
_ACCURACY = 10000


def _group_median(df: DataFrame, names: Sequence[str], column: str) -> DataFrame:
    """(__k0, ..., __median): SQL ``median`` of the non-null values by group.

    ``percentile_approx`` brackets the middle of each group and the values inside the bracket
    (some 6 / _ACCURACY of the group) are ranked exactly, so no group is sorted whole."""
    from pyspark.sql import Window

    keys, by_cols = _keyed(names)
    x = df.filter(col(column).isNotNull()).select(*by_cols, col(column).cast("double").alias("__v"))
    # a bracket around the middle of each group, twice as wide as the error of percentile_approx
    eps = 2.0 / _ACCURACY
    ends = F.percentile_approx("__v", [0.5 - eps, 0.5 + eps], _ACCURACY)
    brackets = x.groupBy(*keys).agg(ends.alias("__ends")).select(
        *keys, F.get("__ends", F.lit(0)).alias("__lo"), F.get("__ends", F.lit(1)).alias("__hi"))
    counts = x.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c"))
    inside = F.col("__v").between(F.col("__lo"), F.col("__hi"))
    bounded = _on_keys(counts, brackets, keys)
    sizes = bounded.groupBy(*keys).agg(
        F.sum("__c").alias("__size"), F.sum(F.when(F.col("__v") < F.col("__lo"), F.col("__c")).otherwise(0)).alias("__below"),
        F.sum(F.when(inside, F.col("__c")).otherwise(0)).alias("__in"))
    # ranks from 0 of the two middle values; a value holds the ranks [upto - c, upto)
    low, high = F.floor((F.col("__size") - 1) / 2), F.floor(F.col("__size") / 2)
    # counted exactly: a group whose bracket does not hold both is ranked whole
    hit = (F.col("__below") <= low) & (high < F.col("__below") + F.col("__in"))
    sizes = sizes.select(*keys, low.alias("__low"), high.alias("__high"), hit.alias("__hit"), F.when(hit, F.col("__below")).otherwise(0).alias("__below"))
    middle = _on_keys(bounded, sizes, keys).filter(~F.col("__hit") | inside)
    w = Window.partitionBy(*keys).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = middle.withColumn("__upto", F.col("__below") + F.sum("__c").over(w))
    holds = lambda rank: (F.col("__upto") - F.col("__c") <= F.col(rank)) & (F.col(rank) < F.col("__upto"))
    return (ranked.filter(holds("__low") | holds("__high")).groupBy(*keys)
            .agg(((F.min("__v") + F.max("__v")) / 2).alias("__median")))


def _on_keys(rows: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the columns of their group; null keys are equal."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__g_{k}"))
    named = groups.select(*[F.col(c).alias(f"__g_{c}") if c in keys else F.col(c) for c in groups.columns])
    return rows.join(named, cond).drop(*[f"__g_{k}" for k in keys])


# --------------------------------------------------------------------------- T5
def split_by(df: DataFrame, column: str, values: Sequence) -> dict:
    """One lazily filtered frame per value (each scan reads only its rows when the
    column is a partition column).  To materialise all splits in one pass use
    :func:`kempt.sources.tables.write_split`."""
    (c,) = _resolve(df, [column])
    return {v: df.filter(col(c) == F.lit(v)) for v in values}


def split_random(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """Split by share (``randomSplit``): disjoint, together the whole frame."""
    return df.randomSplit(list(weights), seed)


# --------------------------------------------------------------------------- T6
def pivot_table(df: DataFrame, index: Sequence[str] | str, columns: str, value: str, fn: str = "sum",
                values: Sequence | None = None) -> DataFrame:
    """Group by ``index``, one output column per ``columns`` value holding ``fn(value)``.

    With ``values`` given this is one aggregation of conditional aggregates
    (``fn(CASE WHEN columns = v THEN value END)``): one shuffle with map-side
    partial aggregation.  Without ``values`` Spark's ``pivot`` first runs a job to
    find them (at most ``spark.sql.pivotMaxValues``; :func:`pivot_map` has no limit)."""
    idx = [index] if isinstance(index, str) else list(index)
    (pc,) = _resolve(df, [columns])
    (vc,) = _resolve(df, [value])
    keys = [col(c) for c in _resolve(df, idx)]
    if fn == "median":
        cells = aggregate(df, [*idx, pc], {"__cell": ("median", vc)})
        return pivot_table(cells, idx, pc, "__cell", "max", values)
    if values is None:
        return df.groupBy(*keys).pivot(pc).agg(agg_expr(fn, vc))
    if fn not in _AGGS:
        raise ValueError(f"unknown aggregate {fn!r}")
    cells = [_AGGS[fn](F.when(col(pc) == F.lit(v), col(vc))).alias(str(v)) for v in values]
    return df.groupBy(*keys).agg(*cells)


def pivot_map(df: DataFrame, index: Sequence[str] | str, columns: str, value: str, fn: str = "sum",
              cells: int = 4096) -> DataFrame:
    """:func:`pivot_table` for any number of ``columns`` values: ``index``, block and ``cells``, an
    array of (column, value) sorted by column.

    Cells are aggregated first (one shuffle, partial aggregation), so an index value's rows are
    bounded by its different ``columns`` values; those are dealt into blocks by a hash, enough of
    them that a block holds about ``cells`` of the widest index value, so no group is unbounded.
    A null ``columns`` value is a cell too."""
    idx = [index] if isinstance(index, str) else list(index)
    (pc,) = _resolve(df, [columns])
    keys = _resolve(df, idx)
    one, part = free_name("value", *keys, pc), free_name("block", *keys, pc, "value")
    long = aggregate(df, [*keys, pc], {one: (fn, _resolve(df, [value])[0])})
    from kempt.session import materialize
    long = materialize(long, "pivot-cells")
    widest = long.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    blocks = -(-int(widest) // cells)
    block = F.pmod(F.xxhash64(col(pc)), F.lit(blocks)).cast("long") if blocks > 1 else F.lit(0).cast("long")
    found = F.array_sort(F.collect_list(F.struct(col(pc).alias("column"), col(one).alias("value"))))
    return (long.withColumn(part, block).groupBy(*[col(k) for k in keys], F.col(part).alias("block")).agg(found.alias("cells")))


# --------------------------------------------------------------------------- T7
def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None,
            var: str = "column", val: str = "value", as_text: bool = False) -> DataFrame:
    """Unpivot: one row per (id columns, value column).  Values must share a type,
    or pass ``as_text`` to compare them as text."""
    ids = _resolve(df, ids)
    vals = _resolve(df, values) if values else [c for c in df.columns if c not in ids]
    src = df.select(*[col(c) for c in ids], *[col(c).cast("string").alias(c) if as_text else col(c) for c in vals])
    return src.unpivot(ids, vals, var, val)


def transpose(df: DataFrame, key: str, max_rows: int = 1000, var: str = "column") -> DataFrame:
    """Rows become columns: one output row per non-key column, one output column per key value
    (values as text).  The output is as wide as the input is long, so the input is
    checked first: more than ``max_rows`` rows, or a repeated key, is refused
    (:func:`transpose_blocks` has no such limit)."""
    (k,) = _resolve(df, [key])
    keys = sorted((r[0] for r in df.select(col(k)).limit(max_rows + 1).collect()), key=lambda v: (v is None, str(v) if v is None else v))
    if len(keys) > max_rows:
        raise ValueError(f"transpose refused: more than {max_rows} rows; use transpose_blocks")
    if len(set(keys)) != len(keys) or any(v is None for v in keys):
        raise ValueError("transpose needs a unique, non-null key")
    long = to_long(df, [k], None, var=var, val="__v", as_text=True)
    # one conditional aggregate per key value: a single shuffle, and each cell holds one value
    cells = [F.max(F.when(col(k) == F.lit(v), F.col("__v"))).alias(str(v)) for v in keys]
    return long.groupBy(var).agg(*cells)


def transpose_blocks(df: DataFrame, key: str, block_rows: int = 1024, var: str = "column") -> DataFrame:
    """:func:`transpose` at any number of rows: one output row per non-key column and block of
    ``block_rows`` input rows in the order of ``key``: ``var``, block (from 0), first_key, keys and
    values (arrays of text; a null value stays null).  Put one after another, a column's blocks
    are its row of the wide form.

    Rows are range-sorted by key and written once; each range numbers its rows by itself and
    starts where the ranges before it end (a table of one row per range).  A block is gathered
    with the values of all columns as one struct, so nothing is exploded before the grouping;
    no group is larger than a block.  A repeated key keeps all its rows; a null key comes first."""
    from pyspark.sql import Window

    from kempt.session import materialize
    (k,) = _resolve(df, [key])
    rest = [c for c in df.columns if c != k]
    rows = df.select(col(k).alias("key"), F.struct(*[col(c).cast("string").alias(f"v{i}") for i, c in enumerate(rest)]).alias("cells"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "cells"]
    ranged = materialize(rows.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "transpose")
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy(*order)
    placed = (ranged.withColumn("nth", F.row_number().over(inside) - 1).join(F.broadcast(starts), "part")
              .withColumn("nth", F.col("start") + F.col("nth")))
    block = F.floor(F.col("nth") / F.lit(block_rows)).cast("long")
    blocks = placed.groupBy(block.alias("block")).agg(F.array_sort(F.collect_list(F.struct("nth", "key", "cells"))).alias("rows"))
    per = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"rows.cells.v{i}").alias("vals")) for i, c in enumerate(rest)])
    out = blocks.select("block", F.col("rows.key").alias("keys"), F.explode(per).alias("c"))
    return out.select(F.col("c.name").alias(var), "block", F.get("keys", 0).alias("first_key"),
                      F.transform("keys", lambda x: x.cast("string")).alias("keys"), F.col("c.vals").alias("values"))


# --------------------------------------------------------------------------- M15 / T16
def sample(df: DataFrame, fraction: float = 0.1, seed: int | None = 42, with_replacement: bool = False) -> DataFrame:
    """Bernoulli sample (``DataFrame.sample``); seeded by default."""
    return df.sample(with_replacement, fraction, seed)


def _unit_hash(text: Column) -> Column:
    """A value in [0, 1) from the first 32 bits of the MD5 of ``text``."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def hash_sample(df: DataFrame, key: str | Sequence[str], fraction: float, salt: str = "") -> DataFrame:
    """Repeatable sample: keep rows whose key hashes below ``fraction``.

    The same key is always in or out, on every engine that has MD5, whatever the
    partitioning, so a retried task or a re-run gives the same rows."""
    keys = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws("|", *[col(c).cast("string") for c in _resolve(df, keys)])
    if salt:
        text = F.concat(F.lit(salt), text)
    return df.filter(_unit_hash(text) < F.lit(fraction))


def stratified_sample(df: DataFrame, column: str, fractions: Mapping, key: str | Sequence[str],
                      salt: str = "") -> DataFrame:
    """Per-stratum fractions, repeatable (hash of ``key``); strata not listed are left out.
    ``DataFrame.sampleBy`` is the random-seeded alternative."""
    (c,) = _resolve(df, [column])
    keys = [key] if isinstance(key, str) else list(key)
    kv: list[Column] = []
    for v, f in fractions.items():
        kv += [F.lit(v), F.lit(float(f))]
    frac = F.try_element_at(F.create_map(*kv), col(c))
    text = F.concat_ws("|", *[col(x).cast("string") for x in _resolve(df, keys)])
    if salt:
        text = F.concat(F.lit(salt), text)
    return df.filter(_unit_hash(text) < frac)


def sample_per_stratum(df: DataFrame, column: str, n: int, key: str | Sequence[str], weight: str | None = None,
                       salt: str = "") -> DataFrame:
    """Exactly ``n`` rows of each value of ``column`` (all, if it has fewer), repeatable: the same rows
    under any partitioning.  Null is a stratum too.

    Rows are ordered by a hash of ``key`` (ties by the key, then by the row's other columns).  With
    ``weight`` the hash u becomes -ln(1 - u) / weight, which draws without replacement in proportion
    to the weights (Efraimidis and Spirakis, 2006); rows whose weight is null or not positive are
    left out.  Spark keeps only the first ``n`` of each value in each task before the shuffle (for
    ``n`` up to ``spark.sql.optimizer.windowGroupLimitThreshold``), so a stratum that holds most of
    the rows is never gathered."""
    from pyspark.sql import Window
    (c,) = _resolve(df, [column])
    keys = _resolve(df, [key] if isinstance(key, str) else list(key))
    text = F.concat_ws("|", *[col(x).cast("string") for x in keys])
    u = _unit_hash(F.concat(F.lit(salt), text))
    if weight is not None:
        (w,) = _resolve(df, [weight])
        df = df.filter(col(w) > 0)
        u = -F.log(1 - u) / col(w)
    others = [x for x in df.columns if not df.schema[x].dataType.simpleString().startswith(("map", "variant", "interval"))]
    nth = free_name("nth", *df.columns)
    place = F.row_number().over(Window.partitionBy(col(c)).orderBy(u, text, *[col(x) for x in others]))
    return df.withColumn(nth, place).filter(F.col(nth) <= n).drop(nth)


# --------------------------------------------------------------------------- M18
def _agree(a: Column, b: Column, tol: float) -> Column:
    """True for two nulls, two NaN, two equal infinities and values at most ``tol`` apart, else
    false; never null."""
    if not tol:
        return a.eqNullSafe(b)
    return a.eqNullSafe(b) | F.coalesce(~F.isnan(a) & ~F.isnan(b) & (F.abs(a - b) <= F.lit(tol)), F.lit(False))


def reconcile_cols(df: DataFrame, a: str, b: str, tol: float = 0.0) -> DataFrame:
    """Rows where ``a`` and ``b`` disagree: differ by more than ``tol``, or exactly one is null or
    NaN.  Equal infinities agree."""
    ca, cb = (col(x) for x in _resolve(df, [a, b]))
    return df.filter(~_agree(ca, cb, tol))


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], cols: Sequence[str],
              tol: float = 0.0) -> DataFrame:
    """Compare two versions of a table by key.

    Rows: keys, status, left_rows, right_rows, and ``<c>_left`` / ``<c>_right``.
    status: matched, changed, left_only, right_only, or duplicate_key when a key
    is not unique on a side.  A null in a key is a value like any other; NaN agrees with NaN, an
    infinity with the same one.  The rows of both sides, told apart by the columns they fill, are
    collapsed by key in one grouping (partial aggregation map-side) instead of a join: a repeated key
    can never multiply rows, null keys meet too, and a key is held once, as one flat row."""
    tags = ("left", "right")
    ns = {t: free_name(f"{t}_n", *keys) for t in tags}
    vs = {t: [free_name(f"{t}_v{i}", *keys) for i in range(len(cols))] for t in tags}

    def side(df: DataFrame, tag: str) -> DataFrame:
        ks = _resolve(df, keys)
        cs = _resolve(df, cols)
        return df.select(*[col(k).alias(n) for k, n in zip(ks, keys, strict=True)], F.lit(1).cast("bigint").alias(ns[tag]),
                         *[col(c).alias(v) for c, v in zip(cs, vs[tag], strict=True)])
    both = side(left, "left").unionByName(side(right, "right"), allowMissingColumns=True)
    j = both.groupBy(*[col(k) for k in keys]).agg(*[F.sum(ns[t]).alias(ns[t]) for t in tags], *[F.min(v).alias(v) for t in tags for v in vs[t]])
    j = j.select(*[col(k) for k in keys], *[F.col(ns[t]).alias(f"{t}_rows") for t in tags],
                 *[F.col(vs[t][i]).alias(f"{c}_{t}") for i, c in enumerate(cols) for t in tags])
    same = F.lit(True)
    for c in cols:
        same = same & _agree(col(f"{c}_left"), col(f"{c}_right"), tol)
    status = (F.when(F.col("left_rows").isNull(), "right_only")
              .when(F.col("right_rows").isNull(), "left_only")
              .when((F.col("left_rows") > 1) | (F.col("right_rows") > 1), "duplicate_key")
              .when(same, "matched").otherwise("changed"))
    return j.select(*[col(k) for k in keys], status.alias("status"),
                    F.coalesce(F.col("left_rows"), F.lit(0)).cast("bigint").alias("left_rows"),
                    F.coalesce(F.col("right_rows"), F.lit(0)).cast("bigint").alias("right_rows"),
                    *[x for c in cols for x in (col(f"{c}_left"), col(f"{c}_right"))])


# --------------------------------------------------------------------------- C18 (re-aimed)
def locate(df: DataFrame, key_cols: Sequence[str], gazetteer: DataFrame, place_col: str = "place",
           lat: str = "lat", lon: str = "lon", broadcast: bool = False) -> DataFrame:
    """Geocode by lookup instead of a web service: join a gazetteer (place, lat, lon) on
    ``upper(trim(...))`` of the address columns joined by ', '.  Adds lat, lon and
    ``address_valid``, replacing columns of these names.  Gazetteer places are made unique first
    (the smallest position, one row's own pair), so a row is never repeated.
    ``broadcast=True`` only for a gazetteer of bounded size."""
    cs = [col(c).cast("string") for c in _resolve(df, key_cols)]
    norm = F.upper(F.trim(F.concat_ws(", ", *cs)))
    place, found, row = (free_name(n, *df.columns) for n in ("place", "found", "row"))
    g = (gazetteer.select(F.upper(F.trim(col(place_col))).alias(place), F.struct(col(lat).alias("lat"), col(lon).alias("lon")).alias(found))
         .groupBy(place).agg(F.min(found).alias(found)))
    if broadcast:
        g = F.broadcast(g)
    new = ("lat", "lon", "address_valid")
    j = df.withColumn(row, norm).join(g, F.col(row) == F.col(place), "left")
    return j.select(*[col(c) for c in df.columns if c.lower() not in new], F.col(f"{found}.lat").alias("lat"),
                    F.col(f"{found}.lon").alias("lon"), F.col(place).isNotNull().alias("address_valid"))
