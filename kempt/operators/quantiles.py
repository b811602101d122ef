"""Many exact ranks of many columns in one search (T8, T13).

``exact_quantile`` finds one rank of one column.  Here every wanted rank has a bracket of its own;
one pass counts a histogram inside all brackets of all columns, and what lies between them, and
the next pass looks only into the buckets that hold a wanted rank.  Eight medians or the edges of
a hundred bins so take the passes that one median takes.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kempt.functions.columns import col, is_fractional
from kempt.operators.cleanse import _resolve

_INF = float("inf")


def _values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, x): the finite values of all columns as doubles, both zeros alike."""
    x = [F.struct(F.lit(i).alias("i"), (col(c).cast("double") + F.lit(0.0)).alias("x")) for i, c in enumerate(cols)]
    return df.select(F.inline(F.array(*x))).filter(F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") < F.lit(_INF)))


def _cell(spans: Mapping[int, Sequence[tuple[float, float]]], buckets: int) -> Column:
    """(j, b) of a value: the number of its bracket and the bucket in it, ``b`` = -1 between brackets,
    where j is the number of brackets below."""
    none = F.struct(F.lit(-1).alias("j"), F.lit(-1).cast("long").alias("b"))
    expr = None
    x = F.col("x")
    for i, brackets in spans.items():
        lows, highs = F.lit([lo for lo, _ in brackets]), F.lit([hi for _, hi in brackets])
        # brackets are apart and ascending: the last one that starts at or below the value
        j = F.size(F.filter(lows, lambda lo: lo <= x)) - 1
        lo, hi = F.get(lows, j), F.get(highs, j)
        width = hi / buckets - lo / buckets
        # halves, so that the difference of two large numbers does not overflow; brackets too narrow
        # to be divided take the value's own bits, few of which then differ
        b = F.when(lo + width > lo, F.least(F.floor((x / 2 - lo / 2) / (width / 2)), F.lit(buckets - 1)))
        inside = F.struct(j.alias("j"), F.coalesce(b, F.xxhash64(x).bitwiseAND(F.lit((1 << 62) - 1))).alias("b"))
        outside = F.struct((j + 1).alias("j"), F.lit(-1).cast("long").alias("b"))
        cell = F.when((j >= 0) & (x <= hi), inside).otherwise(outside)
        expr = F.when(F.col("i") == i, cell) if expr is None else expr.when(F.col("i") == i, cell)
    return none if expr is None else expr.otherwise(none)


def _ranked(values: DataFrame, wanted: Mapping[int, Sequence[int]], spans: Mapping[int, list], few: int, buckets: int) -> dict:
    """{(i, rank): value} for the ranks ``wanted`` among the finite values of each column."""
    got, first = {}, True
    todo = {i: {k: None for k in ks} for i, ks in wanted.items() if ks}  # rank -> (values below its bracket, rows in it, its ends)
    while todo:
        n = max(16, buckets // max(1, sum(len(spans[i]) for i in todo)))
        spans = {i: spans[i] for i in todo}
        cells = values.select("i", "x", _cell(spans, n).alias("cell")).filter("cell.j >= 0")
        if not first:  # what lies between the brackets was counted by the first pass
            cells = cells.filter("cell.b >= 0")
        small = not first and all(s[1] <= few for held in todo.values() for s in held.values())
        key = [F.col("x").alias("at")] if small else [F.col("cell.j").alias("j"), F.col("cell.b").alias("b")]
        hist = cells.groupBy("i", *key).agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
        by_col: dict = {}
        for h in sorted(hist, key=lambda h: (h["i"], h["lo"])):
            by_col.setdefault(h["i"], []).append(h)
        again: dict = {}
        for i, held in todo.items():
            rows = by_col[i]
            lows = [h["lo"] for h in rows]
            total, before = 0, []
            for h in rows:
                before.append(total)
                total += h["c"]
            for k, known in held.items():
                if known is None:  # all rows were counted
                    skip = 0
                else:  # rows of earlier brackets of this pass do not count for this one
                    start = bisect_left(lows, known[2])
                    skip = known[0] - before[start]
                at = bisect_right(before, k - skip) - 1
                h = rows[at]
                if h["lo"] == h["hi"]:
                    got[i, k] = h["lo"]
                else:
                    again.setdefault(i, {})[k] = (skip + before[at], h["c"], h["lo"], h["hi"])
        spans = {i: sorted({(s[2], s[3]) for s in held.values()}) for i, held in again.items()}
        todo = again
        first = False
    return got


def exact_quantiles(df: DataFrame, spec: Mapping[str, Sequence[float]], few: int = 1000, buckets: int = 16384,
                    accuracy: int = 10000) -> dict[str, list[float | None]]:
    """Exact, interpolated quantiles (as SQL ``percentile``) of several columns: for each column of
    ``spec`` the values of its shares, in their order.

    Every result is that of ``exact_quantile``: nulls are ignored, NaN is larger than infinity, None
    for a column without values.  Each pass reads the columns once and brings at most about
    ``buckets`` rows to the driver (16 for each bracket, if that is more)."""
    cols = _resolve(df, list(spec))
    shares = {i: list(qs) for i, qs in enumerate(spec.values())}
    if any(not 0 <= q <= 1 for qs in shares.values() for q in qs):
        raise ValueError("shares must lie between 0 and 1")
    eps = 2.0 / accuracy
    aggs = []
    for i, c in enumerate(cols):
        x = col(c).cast("double")
        fin = F.when(~F.isnan(x) & (F.abs(x) < F.lit(_INF)), x + F.lit(0.0))
        ends = sorted({min(max(q + e, 0.0), 1.0) for q in shares[i] for e in (-eps, eps)}) or [0.5]
        aggs.append(F.struct(F.count(x).alias("n"), F.count_if(x == -_INF).alias("first"), F.count_if(F.isnan(x)).alias("nan"),
                             F.count(fin).alias("finite"), F.min(fin).alias("min"), F.max(fin).alias("max"),
                             F.percentile_approx(fin, ends, accuracy).alias("ends")).alias(f"c{i}"))
    facts = df.agg(*aggs).first() if aggs else []
    wanted: dict = {}
    spans: dict = {}
    for i in shares:
        f = facts[i]
        ks = {k for q in shares[i] for k in _pair(q, f["n"])}
        wanted[i] = sorted({k - f["first"] for k in ks if f["first"] <= k < f["first"] + f["finite"]})
        brackets: list = []
        for lo, hi in zip(*[iter(f["ends"] or [])] * 2, strict=False):  # neighbours in order; any disjoint brackets do
            if brackets and lo <= brackets[-1][1]:
                brackets[-1] = (brackets[-1][0], max(hi, brackets[-1][1]))
            else:
                brackets.append((lo, hi))
        spans[i] = brackets or [(f["min"], f["max"])]
    got = _ranked(_values(df, cols), wanted, spans, few, buckets)

    def value(i: int, k: int) -> float:
        f = facts[i]
        if k < f["first"]:
            return -_INF
        if k >= f["n"] - f["nan"]:
            return float("nan")
        return got[i, k - f["first"]] if k < f["first"] + f["finite"] else _INF

    def at(i: int, q: float) -> float | None:
        n = facts[i]["n"]
        if not n:
            return None
        k_lo, k_hi = _pair(q, n)
        lo, hi, w = value(i, k_lo), value(i, k_hi), q * (n - 1) - k_lo
        if lo == hi or not w:
            return lo
        return lo + w * (hi - lo) if abs(hi - lo) < _INF else (1 - w) * lo + w * hi

    return {name: [at(i, q) for q in shares[i]] for i, name in enumerate(spec)}


def _pair(q: float, n: int) -> tuple[int, int]:
    """The two neighbouring ranks between which share ``q`` of ``n`` values lies."""
    pos = q * (n - 1)
    return max(0, int(pos)), max(0, min(int(pos) + (pos != int(pos)), n - 1))


def _up_to(x: Column):
    return lambda edge: edge <= x


def equal_frequency(df: DataFrame, cols: Sequence[str], bins: int, suffix: str = "_bin") -> DataFrame:
    """Adds ``<c><suffix>`` for each column: the number from 1 of its bin, ``bins`` bins of equally many
    values with edges at the exact quantiles, low edge inside; equal edges make one bin.

    Null and NaN get null; all columns' edges are found in one search."""
    names = _resolve(df, cols)
    if bins < 1:
        raise ValueError("bins must be at least 1")
    ok = {c: F.when(~F.isnan(col(c)), col(c)) if is_fractional(df.schema[c].dataType) else col(c) for c in names}
    edges = exact_quantiles(df.select(*[v.alias(c) for c, v in ok.items()]), {c: [b / bins for b in range(1, bins)] for c in names})
    out = df
    for c in names:
        inner = sorted({e for e in edges[c] if e is not None})
        x = ok[c].cast("double")
        expr = F.size(F.filter(F.lit(inner), _up_to(x))) + 1 if inner else F.lit(1)
        out = out.withColumn(f"{c}{suffix}", F.when(ok[c].isNotNull(), expr).cast("int"))
    return out
