"""Whole-table statistics: fit once, apply row-wise.

Each operator that needs a statistic of the whole column has two halves:
``fit_*`` runs **one** aggregation over all requested columns (a single Spark
job with map-side partial aggregation; the result is one small row whose size
is proportional to the number of columns, never to the data) and returns a
plain dict; the apply half only adds expressions with those values as
literals.  On a stream, fit on a batch table and pass ``stats=`` explicitly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kempt.functions.columns import col, is_fractional, is_numeric, is_string
from kempt.operators.cleanse import _replace_cols, _resolve


def _one_row(df: DataFrame, exprs: list[Column]) -> dict:
    row = df.agg(*exprs).collect()[0]
    return row.asDict()


def finite(v: Column) -> Column:
    """``v`` where it is a number to fit on: null for NaN and the infinities, which would
    otherwise turn a whole column's mean, deviation or range into NaN."""
    return F.when(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), v)


# --------------------------------------------------------------------------- moments
def moment_exprs(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """The aggregates behind :func:`fit_moments`, for use in ``agg`` or ``observe``."""
    exprs = []
    for i, c in enumerate(_resolve(df, cols)):
        v = finite(col(c).cast("double"))
        exprs += [F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"),
                  F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.count(v).alias(f"n{i}")]
    return exprs


def moments_from(values: Mapping, df: DataFrame, cols: Sequence[str]) -> dict[str, dict]:
    """Turn the values of :func:`moment_exprs` into the per-column stats dict."""
    r = values
    return {c: {"mean": r[f"m{i}"], "sd": r[f"s{i}"], "min": r[f"lo{i}"], "max": r[f"hi{i}"],
                "n": r[f"n{i}"]} for i, c in enumerate(_resolve(df, cols))}


def fit_moments(df: DataFrame, cols: Sequence[str]) -> dict[str, dict]:
    """mean, sample stddev, min, max and count of the finite values of each column, one job."""
    return moments_from(_one_row(df, moment_exprs(df, cols)), df, cols)


# --------------------------------------------------------------------------- C5
def winsorize(df: DataFrame, cols: Sequence[str], threshold: float = 3.0, mode: str = "clamp",
              stats: Mapping[str, Mapping] | None = None) -> DataFrame:
    """Replace values whose |z-score| exceeds ``threshold``.

    ``mode="clamp"``: high outliers go to ``mean + t*sd``, low ones to ``mean - t*sd``.
    ``mode="reference"``: every outlier goes to ``mean + t*sd`` (the upper fence,
    also for low outliers).  Nulls stay null and NaN stays NaN; an infinity is an outlier
    like any other.  The fit sees finite values only; with sd null (one row) or 0 the
    column is unchanged.  Result columns are double.
    """
    if mode not in ("clamp", "reference"):
        raise ValueError("mode must be 'clamp' or 'reference'")
    cols = _resolve(df, cols)
    stats = stats or fit_moments(df, cols)
    new = {}
    for c in cols:
        mean, sd = stats[c]["mean"], stats[c]["sd"]
        v = col(c).cast("double")
        if mean is None or sd is None or sd == 0:
            new[c] = v
            continue
        z = F.abs((v - F.lit(mean)) / F.lit(sd))
        hi = F.lit(mean) + F.lit(threshold) * F.lit(sd)
        lo = F.lit(mean) - F.lit(threshold) * F.lit(sd)
        far = (z > threshold) & ~F.isnan(v)  # NaN is larger than any number
        if mode == "clamp":
            new[c] = F.when(far & (v > F.lit(mean)), hi).when(far, lo).otherwise(v)
        else:
            new[c] = F.when(far, hi).otherwise(v)
    return _replace_cols(df, new)


# --------------------------------------------------------------------------- M11 (as commented)
def standardize(df: DataFrame, cols: Sequence[str], suffix: str = "",
                stats: Mapping[str, Mapping] | None = None) -> DataFrame:
    """z-score: ``(x - mean) / sd`` with sample sd; sd 0 or null gives null.  Mean and sd are
    those of the finite values; NaN and the infinities stay what they are (null if sd is 0 or null)."""
    cols = _resolve(df, cols)
    stats = stats or fit_moments(df, cols)
    new = {}
    for c in cols:
        mean, sd = stats[c]["mean"], stats[c]["sd"]
        v = col(c).cast("double")
        expr = F.lit(None).cast("double") if mean is None or sd is None else \
            F.try_divide(v - F.lit(mean), F.lit(sd))
        new[c + suffix] = expr
    return _with(df, new)


# --------------------------------------------------------------------------- T9 / T11
def min_max(df: DataFrame, cols: Sequence[str], suffix: str = "_normalized",
            keep: Sequence[str] | None = None, stats: Mapping[str, Mapping] | None = None) -> DataFrame:
    """Scale to [0, 1]: ``(x - min) / (max - min)``; max = min gives null.  The range is that of
    the finite values; NaN and the infinities stay what they are (null if max = min).

    ``suffix=""`` scales in place (T11).  ``keep`` restricts the output to
    ``keep`` plus the scaled columns (T9 keeps ID and year)."""
    cols = _resolve(df, cols)
    stats = stats or fit_moments(df, cols)
    new = {}
    for c in cols:
        lo, hi = stats[c]["min"], stats[c]["max"]
        v = col(c).cast("double")
        expr = F.lit(None).cast("double") if lo is None else \
            F.try_divide(v - F.lit(lo), F.lit(hi) - F.lit(lo))
        new[c + suffix] = expr
    out = _with(df, new)
    if keep is not None:
        out = out.select(*[col(k) for k in _resolve(out, keep)], *[col(k) for k in new])
    return out


def _with(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns in one projection; every expression sees the input columns."""
    lower = {k.lower(): (k, v) for k, v in new.items()}
    existing = {f.name.lower() for f in df.schema.fields}
    out = [lower[f.name.lower()][1].alias(f.name) if f.name.lower() in lower else col(f.name)
           for f in df.schema.fields]
    out += [v.alias(k) for k, v in new.items() if k.lower() not in existing]
    return df.select(*out)


# --------------------------------------------------------------------------- exact quantile / mode
def exact_quantile(df: DataFrame, column: str, q: float = 0.5, max_bracket_rows: int = 1000,
                   buckets: int = 1024, accuracy: int = 10000) -> float | None:
    """Exact, interpolated quantile (same definition as SQL ``percentile`` / ``median``)
    with bounded memory everywhere.

    Spark's exact ``percentile`` keeps every distinct value in one map that is merged
    in a single task; here instead:
      1. one pass: counts and an approximate bracket around rank ``q*(n-1)``
         (``percentile_approx`` guarantees a rank error of at most n/accuracy);
      2. one pass: rows below the bracket and inside it;
      3. while the bracket holds more than ``max_bracket_rows`` rows, one pass of a
         ``buckets``-wide histogram narrows it to the bucket that holds the rank;
      4. the few values needed are taken with ``orderBy().limit()`` (top-k per task).
    The two ends of a bracket fall into different buckets, so every pass leaves fewer
    rows; if one bucket ends at the lower rank and the next starts at the upper one,
    the buckets' own ends are the answer. Nulls are ignored; NaN is larger than
    infinity. Returns None for a column without values."""
    (c,) = _resolve(df, [column])
    x = df.select(col(c).cast("double").alias("x")).filter(F.col("x").isNotNull())
    eps, inf = 2.0 / accuracy, float("inf")
    finite = x.filter(~F.isnan("x") & (F.abs("x") < F.lit(inf)))
    r = x.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("x") == -inf).alias("first"),
              F.count_if(F.col("x") == inf).alias("last"), F.count_if(F.isnan("x")).alias("nan"),
              F.percentile_approx(F.when(~F.isnan("x") & (F.abs("x") < F.lit(inf)), F.col("x")),
                                  [max(q - eps, 0.0), min(q + eps, 1.0)], accuracy).alias("b")).collect()[0]
    n = r["n"]
    if not n:
        return None
    pos = q * (n - 1)
    k_lo, k_hi = int(pos), min(int(pos) + (0 if pos == int(pos) else 1), n - 1)
    n_finite = n - r["first"] - r["last"] - r["nan"]

    def special(k: int) -> float | None:
        if k < r["first"]:
            return -inf
        if k >= n - r["nan"]:
            return float("nan")
        return inf if k >= r["first"] + n_finite else None

    v_lo, v_hi = special(k_lo), special(k_hi)
    inner = [k - r["first"] for k, v in ((k_lo, v_lo), (k_hi, v_hi)) if v is None]
    if inner:
        a, b = _finite_ranks(finite, n_finite, inner[0], inner[-1], r["b"], max_bracket_rows, buckets)
        v_lo, v_hi = (a if v_lo is None else v_lo), (b if v_hi is None else v_hi)
    if v_lo == v_hi:
        return v_lo
    w, gap = pos - k_lo, v_hi - v_lo
    return v_lo + w * gap if abs(gap) < inf else (1 - w) * v_lo + w * v_hi  # a gap may be too large for a double


def _finite_ranks(x: DataFrame, n: int, k_lo: int, k_hi: int, bracket: Sequence[float], few: int,
                  buckets: int) -> tuple[float, float]:
    """Values of the ranks ``k_lo`` and ``k_hi`` (equal or neighbours) of the finite column ``x``."""
    lo, hi = bracket
    r = x.agg(F.count_if(F.col("x") < lo).alias("below"), F.count_if(F.col("x").between(lo, hi)).alias("inside"),
              F.min("x").alias("min"), F.max("x").alias("max")).collect()[0]
    below, inside = r["below"], r["inside"]
    if not (below <= k_lo and k_hi < below + inside):  # bracket missed: the whole range
        lo, hi, below, inside = r["min"], r["max"], 0, n
    while lo < hi and inside > few:
        width = hi / buckets - lo / buckets
        rows = x.filter(F.col("x").between(lo, hi))
        if lo + width > lo:
            # halves, so that the difference of two large numbers does not overflow
            b = F.floor((F.col("x") / 2 - F.lit(lo / 2)) / F.lit(width / 2)).cast("int")
            hist = (rows.groupBy(F.least(b, F.lit(buckets - 1)).alias("b"))
                    .agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi")))
        else:  # so close that only about ``buckets`` different numbers fit between them
            hist = rows.groupBy(F.col("x").alias("b")).agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("lo"),
                                                           F.max("x").alias("hi"))
        hist = hist.orderBy("b").collect()
        acc = below
        for i, h in enumerate(hist):
            if acc + h["c"] > k_lo:
                break
            acc += h["c"]
        if acc + h["c"] <= k_hi:
            return h["hi"], hist[i + 1]["lo"]
        if h["c"] >= inside:
            raise AssertionError("a pass over the bracket must leave fewer rows")
        lo, hi, below, inside = h["lo"], h["hi"], acc, h["c"]
    if lo == hi:
        return lo, lo
    vals = [v[0] for v in x.filter(F.col("x").between(lo, hi)).orderBy("x").limit(k_hi - below + 1).collect()]
    return vals[k_lo - below], vals[k_hi - below]


def exact_mode(df: DataFrame, column: str):
    """Most frequent non-null value; ties go to the smallest value.

    ``groupBy(value).count()`` (partial aggregation map-side), then a top-1 by
    (count desc, value): no task ever holds more than one partition's values."""
    (c,) = _resolve(df, [column])
    top = (df.filter(col(c).isNotNull()).groupBy(col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.col("n").desc(), F.col("v").asc()).limit(1).collect())
    return top[0]["v"] if top else None


# --------------------------------------------------------------------------- M10 / T8
def _mean(df: DataFrame, c: str) -> Column:
    """Mean of the finite values."""
    return F.avg(finite(col(c)) if is_fractional(df.schema[c].dataType) else col(c))


def fit_impute(df: DataFrame, spec: Mapping[str, object], accuracy: int = 10000) -> dict[str, object]:
    """Resolve "mean" / "approx_median" in one job, "median" / "mode" with the bounded
    exact algorithms above; other values are constants."""
    stat_exprs, names = [], []
    values: dict[str, object] = {}
    medians = [name for name, how in spec.items() if how == "median"]
    if len(medians) > 1:  # all in the passes of one
        from kempt.operators.quantiles import exact_quantiles
        found = exact_quantiles(df, {name: [0.5] for name in medians})
    else:
        found = {name: [exact_quantile(df, name, 0.5)] for name in medians}
    for i, (name, how) in enumerate(spec.items()):
        (c,) = _resolve(df, [name])
        values[c] = how
        if how == "mean":
            stat_exprs.append(_mean(df, c).alias(f"v{i}"))
        elif how == "approx_median":
            stat_exprs.append(F.percentile_approx(col(c), 0.5, accuracy).alias(f"v{i}"))
        elif how == "median":
            (values[c],) = found[name]
            continue
        elif how == "mode":
            values[c] = exact_mode(df, c)
            continue
        else:
            continue
        names.append((i, c))
    if stat_exprs:
        r = _one_row(df, stat_exprs)
        for i, c in names:
            values[c] = r[f"v{i}"]
    return values


def impute_exprs(df: DataFrame, spec: Mapping[str, object], accuracy: int = 10000) -> list[Column] | None:
    """Aggregates that resolve ``spec`` in one pass (for ``agg`` or ``observe``); None when
    the spec needs the multi-pass exact median or mode."""
    if any(h in ("median", "mode") for h in spec.values()):
        return None
    exprs = []
    for i, (name, how) in enumerate(spec.items()):
        (c,) = _resolve(df, [name])
        if how == "mean":
            exprs.append(_mean(df, c).alias(f"v{i}"))
        elif how == "approx_median":
            exprs.append(F.percentile_approx(col(c), 0.5, accuracy).alias(f"v{i}"))
    return exprs or None


def impute_values_from(values: Mapping, df: DataFrame, spec: Mapping[str, object]) -> dict[str, object]:
    out = {}
    for i, (name, how) in enumerate(spec.items()):
        (c,) = _resolve(df, [name])
        out[c] = values[f"v{i}"] if how in ("mean", "approx_median") else how
    return out


def impute(df: DataFrame, spec: Mapping[str, object], values: Mapping[str, object] | None = None) -> DataFrame:
    """Fill nulls per column with a constant or a fitted statistic.

    ``spec`` maps column to a constant or one of "mean", "median",
    "approx_median", "mode".  A fill for an integral column is rounded half-up;
    a text constant for a numeric column is refused up front (ANSI would fail
    the job at run time instead).  A mean is that of the finite values; NaN and the
    infinities are values and are not filled."""
    values = values or fit_impute(df, spec)
    types = {f.name: f.dataType for f in df.schema.fields}
    new = {}
    for c, v in values.items():
        dt = types[c]
        if v is None:
            continue
        if isinstance(v, str) and not is_string(dt):
            raise TypeError(f"text fill {v!r} for {dt.simpleString()} column {c!r}")
        fill = F.lit(v)
        if is_numeric(dt) and dt.typeName() in ("integer", "long", "short", "byte"):
            fill = F.round(F.lit(float(v)), 0).cast(dt)
        else:
            fill = fill.cast(dt)
        new[c] = F.coalesce(col(c), fill)
    return _replace_cols(df, new)


# --------------------------------------------------------------------------- T1
def describe_cols(df: DataFrame, cols: Sequence[str], percentiles: Sequence[float] = (),
                  accuracy: int = 10000, text: bool = False) -> DataFrame:
    """One typed row per column: column, count, mean, stddev, min, max (+ ``p<q>`` columns).

    A single aggregation computes every statistic of every column; the one-row
    result is turned into one row per column with ``inline`` (no driver trip,
    unlike ``DataFrame.describe``, which also returns strings).  With ``text``, or if a
    column is not numeric, ``min_text`` and ``max_text`` hold the exact smallest and
    largest value as text; the numeric statistics of a column that is not numeric are
    null.  Percentiles are ``percentile_approx`` (bounded memory, rank error at most
    n/accuracy)."""
    cols = _resolve(df, cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    text = text or any(not is_numeric(types[c]) for c in cols)
    aggs = []
    for i, c in enumerate(cols):
        v = col(c).cast("double") if is_numeric(types[c]) else F.lit(None).cast("double")
        extra = [f(col(c)).cast("string").alias(n) for f, n in ((F.min, "min_text"), (F.max, "max_text"))] if text else []
        if percentiles:
            pa = F.percentile_approx(v, list(percentiles), accuracy)
            extra += [F.get(pa, j).alias(f"p{int(round(q * 100))}") for j, q in enumerate(percentiles)]
        aggs.append(F.struct(F.lit(c).alias("column"), F.count(col(c)).alias("count"), F.avg(v).alias("mean"),
                             F.stddev_samp(v).alias("stddev"), F.min(v).alias("min"), F.max(v).alias("max"),
                             *extra).alias(f"d{i}"))
    one = df.agg(*aggs)
    return one.select(F.inline(F.array(*[F.col(f"d{i}") for i in range(len(cols))])))


# --------------------------------------------------------------------------- T2
def fit_null_shares(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float | None]:
    """Percentage of nulls per column, one job; None for an empty frame."""
    return null_shares_from(_one_row(df, null_share_exprs(df, cols)), df, cols)


def null_share_exprs(df: DataFrame, cols: Sequence[str] | None = None) -> list[Column]:
    """The aggregates behind :func:`fit_null_shares`, for use in ``agg`` or ``observe``."""
    cols = _resolve(df, cols) if cols else df.columns
    return [F.count(F.lit(1)).alias("__n")] + \
        [F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]


def null_shares_from(values: Mapping, df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float | None]:
    cols = _resolve(df, cols) if cols else df.columns
    n = values["__n"]
    return {c: (None if not n else 100.0 * values[f"n{i}"] / n) for i, c in enumerate(cols)}


def drop_sparse_nulls(df: DataFrame, max_pct: float = 1.0, shares: Mapping[str, float] | None = None) -> DataFrame:
    """Drop rows that are null in a column whose null share is in (0, max_pct) percent.

    Shares are all measured on the input frame in one aggregation (the
    reference re-measured on the shrinking frame)."""
    shares = shares if shares is not None else fit_null_shares(df)
    subset = [c for c, p in shares.items() if p is not None and 0 < p < max_pct]
    return df.dropna(subset=subset) if subset else df
