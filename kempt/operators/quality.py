"""Profiling and data-quality checks, each one aggregation pass.

The reference ran one Spark job per column per statistic (139 jobs to profile a
34-column table).  Here every report is a lazy DataFrame over a single scan:
rule violations and type checks for all columns share one ``agg``; exact
profiles unpivot every value into a (column, typed value) pair and count per
pair, then per column (partial aggregation on the map side, so a value that
fills a third of the table is collapsed before the shuffle).  Results are one
row per column, produced on the executors (``inline``), never assembled from
data on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kempt.functions.columns import SPECIAL_CHARS, col, free_name, guarded_cast, is_string
from kempt.operators.cleanse import _resolve


# Relative standard deviation of estimated distinct counts: about 3 KB of state per column.
_RSD = 0.02


def _rows_per_column(one_row: DataFrame, structs: list[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*structs)))


# --------------------------------------------------------------------------- P3 / C11 distinct
def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """(column, distinct) per column; null counts as one value, as ``select(c).distinct().count()``.

    exact: unpivot to (column index, value digest of 16 bytes), distinct (partial
    aggregation map-side), count per column.  Otherwise HyperLogLog++
    (``approx_count_distinct``, one pass, no expansion) plus the null flag."""
    cols = _resolve(df, cols) if cols else df.columns
    if not exact:
        exprs = []
        for i, c in enumerate(cols):
            exprs.append(F.struct(F.lit(c).alias("column"),
                                  (F.approx_count_distinct(col(c), _RSD) +
                                   F.max(F.when(col(c).isNull(), 1).otherwise(0))).cast("bigint").alias("distinct")
                                  ).alias(f"d{i}"))
        return _rows_per_column(df.agg(*exprs), [F.col(f"d{i}") for i in range(len(cols))])
    per_col = _pairs(df, cols).distinct().groupBy("i").agg(F.count(F.lit(1)).alias("distinct"))
    names = F.array(*[F.lit(c) for c in cols])
    return per_col.select(F.get(names, F.col("i")).alias("column"), F.col("distinct"))


def _digest(df: DataFrame, c: str) -> tuple[Column, Column]:
    """The value of ``c`` as two longs, null for null, so that all columns share one small key:
    integers, dates and timestamps as they are, fractions as a hash that is different for
    different values, anything else as a 128-bit digest (two XXH64 of the value, equal only
    for equal values but for a chance of about n**2 / 2**129 among n distinct ones). Long text never travels."""
    dt = df.schema[c].dataType
    x = col(c)
    zero = F.lit(0).cast("bigint")
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return x.cast("bigint"), zero
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(x), zero
    if isinstance(dt, T.TimestampNTZType):
        # calendar arithmetic, not a cast through the session time zone (DST gaps would merge values)
        micros = (F.unix_date(F.to_date(x)).cast("bigint") * F.lit(86_400_000_000)
                  + F.hour(x).cast("bigint") * F.lit(3_600_000_000) + F.minute(x).cast("bigint") * F.lit(60_000_000)
                  + (F.date_part(F.lit("SECOND"), x) * F.lit(1_000_000)).cast("bigint"))
        return micros, zero
    if isinstance(dt, T.DateType):
        return F.unix_date(x).cast("bigint"), zero
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        # -0.0 and 0.0 are one value for Spark's grouping; keep them one value here. XXH64 of
        # eight bytes takes different values to different hashes, so one is enough
        x = F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double"))
        return F.when(x.isNotNull(), F.xxhash64(x)), zero
    if isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
        x = F.to_json(F.struct(x.alias("v")))
    elif not is_string(dt) and not isinstance(dt, T.BinaryType):
        x = x.cast("string")
    return F.when(x.isNotNull(), F.xxhash64(x)), F.xxhash64(F.lit(1), x)


def _pairs(df: DataFrame, cols: Sequence[str], *more: Mapping[str, Column]) -> DataFrame:
    """One row (i, a, b, extras) for every column of every row: the column's number and its
    value's digest. ``more``: {column: condition} of the extras x0, x1, ... (null is false)

    Unpivoted, not exploded from an array of all: a row's pairs are made one at a time, in
    methods short enough for the JVM to compile however many columns there are."""
    # Spark takes the nullability of one column for all: no field may be null there, a flag says which are
    slots = []
    for i, c in enumerate(cols):
        a, b = _digest(df, c)
        extras = [F.coalesce(m[c], F.lit(False)).alias(f"x{j}") for j, m in enumerate(more)]
        slots.append(F.struct(F.lit(i).alias("i"), F.coalesce(a, F.lit(0).cast("bigint")).alias("a"), a.isNotNull().alias("there"), b.alias("b"), *extras).alias(f"p{i}"))
    pairs = df.select(*slots).unpivot([], [f"p{i}" for i in range(len(slots))], "of", "pair").select("pair.*")
    return pairs.select("i", F.when(F.col("there"), F.col("a")).alias("a"), "b", *[f"x{j}" for j in range(len(more))])


# --------------------------------------------------------------------------- P1-P8
def profile(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """One row per column: column, position, type, rows, nulls, null_pct, distinct.

    exact: a single scan.  Every value becomes a (column, 16-byte digest) pair and is
    counted per pair (partial aggregation map-side, so a value that fills a third
    of the table is one row per task after the map side); a second aggregation
    per column gives rows = sum of counts, nulls = count of the null value,
    distinct = number of pairs.  ``exact=False``: one aggregate with
    HyperLogLog++ distinct counts, no row expansion."""
    cols = _resolve(df, cols) if cols else df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if not exact:
        return _profile_approx(df, cols, types)
    per_value = _pairs(df, cols).groupBy("i", "a", "b").agg(F.count(F.lit(1)).alias("c"))
    is_null = F.col("a").isNull()
    per_col = per_value.groupBy("i").agg(
        F.sum("c").alias("rows"), F.sum(F.when(is_null, F.col("c"))).alias("nulls"),
        F.count(F.lit(1)).alias("distinct"))
    # column metadata: one row per column, known on the driver (size = number of columns);
    # it also gives an empty input its rows of zeros
    meta = df.sparkSession.createDataFrame(
        [(i, c, types[c]) for i, c in enumerate(cols)], "i int, column string, type string")
    j = meta.join(F.broadcast(per_col), "i", "left")
    rows = F.coalesce(F.col("rows"), F.lit(0)).cast("bigint")
    nulls = F.coalesce(F.col("nulls"), F.lit(0)).cast("bigint")
    return j.select("column", F.col("i").alias("position"), "type", rows.alias("rows"), nulls.alias("nulls"),
                    (F.try_divide(nulls, rows) * 100.0).alias("null_pct"),
                    F.coalesce(F.col("distinct"), F.lit(0)).cast("bigint").alias("distinct"))


def _profile_approx(df: DataFrame, cols: list[str], types: Mapping[str, str]) -> DataFrame:
    rows = F.count(F.lit(1))
    structs = []
    for i, c in enumerate(cols):
        nulls = F.count_if(col(c).isNull())
        distinct = (F.approx_count_distinct(col(c), _RSD) + F.max(F.when(col(c).isNull(), 1).otherwise(0))).cast("bigint")
        structs.append(F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"),
                                F.lit(types[c]).alias("type"), rows.alias("rows"), nulls.alias("nulls"),
                                (F.try_divide(nulls, rows) * 100.0).alias("null_pct"),
                                F.coalesce(distinct, F.lit(0).cast("bigint")).alias("distinct")).alias(f"p{i}"))
    return _rows_per_column(df.agg(*structs), [F.col(f"p{i}") for i in range(len(cols))])


# --------------------------------------------------------------------------- C11 / M1
def validate(df: DataFrame, formats: Mapping[str, str] | None = None,
             domains: Mapping[str, Sequence] | None = None, cols: Sequence[str] | None = None,
             exact: bool = True) -> DataFrame:
    """Per column: type, nulls, distinct, plus invalid counts for format (regex) and domain rules.

    A null value is not counted invalid (``~rlike`` / ``~isin`` on null is null,
    and ``count_if`` skips it), as in the reference.  ``invalid_format`` /
    ``invalid_domain`` are null for columns without such a rule.  exact: one scan,
    as :func:`profile`; each row's rule results travel with its (column, value)
    pair and are summed per column."""
    cols = _resolve(df, cols) if cols else df.columns
    formats = {_resolve(df, [k])[0]: v for k, v in (formats or {}).items()}
    domains = {_resolve(df, [k])[0]: v for k, v in (domains or {}).items()}
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    none = F.lit(None).cast("boolean")
    if not exact:
        structs = []
        for i, c in enumerate(cols):
            fmt = F.count_if(~col(c).cast("string").rlike(formats[c])) if c in formats else F.lit(None).cast("bigint")
            dom = F.count_if(~col(c).isin(list(domains[c]))) if c in domains else F.lit(None).cast("bigint")
            structs.append(F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"),
                                    F.count_if(col(c).isNull()).alias("nulls"),
                                    fmt.alias("invalid_format"), dom.alias("invalid_domain")).alias(f"v{i}"))
        base = _rows_per_column(df.agg(*structs), [F.col(f"v{i}") for i in range(len(cols))])
        return base.join(distinct_counts(df, cols, False), "column", "left").select(
            "column", "type", "nulls", F.coalesce(F.col("distinct"), F.lit(0).cast("bigint")).alias("distinct"),
            "invalid_format", "invalid_domain")
    # A rule is part of the value's own pair: it is tested per row, where the value is at
    # hand, so that no text has to travel with the pair.
    bad_fmt = {c: (~col(c).cast("string").rlike(formats[c]) if c in formats else none) for c in cols}
    bad_dom = {c: (~col(c).isin(list(domains[c])) if c in domains else none) for c in cols}
    per_value = _pairs(df, cols, bad_fmt, bad_dom).groupBy("i", "a", "b").agg(
        F.count(F.lit(1)).alias("c"), F.count_if(F.col("x0")).alias("fb"), F.count_if(F.col("x1")).alias("db"))
    is_null = F.col("a").isNull()
    per_col = per_value.groupBy("i").agg(
        F.sum(F.when(is_null, F.col("c"))).alias("nulls"), F.count(F.lit(1)).alias("distinct"),
        F.sum("fb").alias("fb"), F.sum("db").alias("db"))
    meta = df.sparkSession.createDataFrame(
        [(i, c, types[c], c in formats, c in domains) for i, c in enumerate(cols)],
        "i int, column string, type string, has_fmt boolean, has_dom boolean")
    j = meta.join(F.broadcast(per_col), "i", "left")
    zero = F.lit(0).cast("bigint")
    return j.select(
        "column", "type", F.coalesce(F.col("nulls"), zero).cast("bigint").alias("nulls"),
        F.coalesce(F.col("distinct"), zero).cast("bigint").alias("distinct"),
        F.when(F.col("has_fmt"), F.coalesce(F.col("fb"), zero)).cast("bigint").alias("invalid_format"),
        F.when(F.col("has_dom"), F.coalesce(F.col("db"), zero)).cast("bigint").alias("invalid_domain"))


# --------------------------------------------------------------------------- T15 / P7 / V3
def duplicate_stats(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One row: rows, distinct_rows, duplicate_groups (groups of 2+), surplus_rows (rows - distinct).

    Text and binary columns are compared by a 128-bit digest, so long text does not travel."""
    keys = []
    for c in _resolve(df, subset) if subset else df.columns:
        if is_string(df.schema[c].dataType) or isinstance(df.schema[c].dataType, T.BinaryType):
            a, b = _digest(df, c)
            keys.append(F.struct(a, b))
        else:
            keys.append(col(c))
    keys = [k.alias(f"__k{i}") for i, k in enumerate(keys)]
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("rows"),
                 F.count(F.lit(1)).alias("distinct_rows"),
                 F.count_if(F.col("__n") > 1).alias("duplicate_groups"),
                 F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"))


# Short type names and their canonical Spark spelling.
_TYPE_ALIASES = {"integer": "int", "long": "bigint", "short": "smallint", "byte": "tinyint",
                 "bool": "boolean", "str": "string", "text": "string", "real": "float"}


def _norm_type(t: str) -> str:
    t = t.strip().lower().replace(" ", "")
    return _TYPE_ALIASES.get(t, t)


# --------------------------------------------------------------------------- M2 / V1 / V2
def schema_diff(df: DataFrame, expected: T.StructType | Mapping[str, str]) -> DataFrame:
    """Compare ``df`` with an expected schema, and count values that do not fit it.

    Rows: column, expected, actual, status (match / type / missing / extra) and
    bad_values = non-null values that ``try_cast`` cannot turn into the expected
    type (null for missing and extra columns).  All counts in one aggregation."""
    if isinstance(expected, T.StructType):
        exp = {f.name: f.dataType.simpleString() for f in expected.fields}
    else:
        exp = {k: _norm_type(v) for k, v in expected.items()}
    actual = {f.name.lower(): (f.name, f.dataType.simpleString()) for f in df.schema.fields}
    structs = []
    seen = set()
    for name, etype in exp.items():
        hit = actual.get(name.lower())
        if hit is None:
            structs.append((name, etype, None, "missing", F.lit(None).cast("bigint")))
            continue
        real, atype = hit
        seen.add(real)
        status = "match" if atype == etype else "type"
        bad = F.count_if(col(real).isNotNull() & guarded_cast(col(real), etype, df.schema[real].dataType).isNull())
        structs.append((name, etype, atype, status, bad))
    for f in df.schema.fields:
        if f.name not in seen:
            structs.append((f.name, None, f.dataType.simpleString(), "extra", F.lit(None).cast("bigint")))
    exprs = [F.struct(F.lit(n).alias("column"), F.lit(e).cast("string").alias("expected"),
                      F.lit(a).cast("string").alias("actual"), F.lit(s).alias("status"),
                      b.alias("bad_values")).alias(f"s{i}")
             for i, (n, e, a, s, b) in enumerate(structs)]
    return _rows_per_column(df.agg(*exprs), [F.col(f"s{i}") for i in range(len(structs))])


# --------------------------------------------------------------------------- V4-V10
def quality_report(df: DataFrame, checks: Sequence[Mapping]) -> DataFrame:
    """Run declared checks in one aggregation: rows (check, column, violations, total, passed).

    Checks (``{"check": name, "column": c, ...}``):
      not_null; uppercase; decimal (``scale``); allowed (``values``);
      special_chars (``pattern``); format (``regex``); row_count (``min``);
      column_count (``expected``); duplicates (``subset``, surplus rows).
    Negated predicates skip nulls: a null is neither valid nor a violation.
    """
    total = F.count(F.lit(1))
    structs: list[Column] = []
    extra: list[DataFrame] = []
    for i, ch in enumerate(checks):
        kind = ch["check"]
        name = ch.get("column")
        c = col(_resolve(df, [name])[0]) if name else None
        if kind == "not_null":
            v = F.count_if(c.isNull())
        elif kind == "uppercase":
            v = F.count_if(c != F.upper(c))
        elif kind == "decimal":
            # NaN and infinity have no decimal places to check: they violate
            number = c.cast("double")
            v = F.count_if((c != F.round(c, ch.get("scale", 2))) | F.isnan(number) | (F.abs(number) == F.lit(float("inf"))))
        elif kind == "allowed":
            v = F.count_if(~c.isin(list(ch["values"])))
        elif kind == "special_chars":
            v = F.count_if(c.cast("string").rlike(ch.get("pattern", SPECIAL_CHARS)))
        elif kind == "format":
            v = F.count_if(~c.cast("string").rlike(ch["regex"]))
        elif kind == "row_count":
            v = F.when(total < F.lit(ch.get("min", 1)), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
        elif kind == "column_count":
            v = F.lit(abs(len(df.columns) - int(ch["expected"]))).cast("bigint")
        elif kind == "duplicates":
            d = duplicate_stats(df, ch.get("subset"))
            extra.append(d.select(F.lit("duplicates").alias("check"), F.lit(name).cast("string").alias("column"),
                                  F.col("surplus_rows").alias("violations"), F.col("rows").alias("total")))
            continue
        else:
            raise ValueError(f"unknown check {kind!r}")
        structs.append(F.struct(F.lit(kind).alias("check"), F.lit(name).cast("string").alias("column"),
                                v.cast("bigint").alias("violations"), total.alias("total")).alias(f"q{i}"))
    parts: list[DataFrame] = []
    if structs:
        parts.append(_rows_per_column(df.agg(*structs), [F.col(f"q{i}") for i, ch in enumerate(checks)
                                                         if ch["check"] != "duplicates"]))
    parts += extra
    if not parts:  # no checks, no rows
        return df.sparkSession.createDataFrame([], "check string, column string, violations bigint, total bigint, passed boolean")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("violations") == 0)


# --------------------------------------------------------------------------- C17
def orphans(df: DataFrame, fk: str, ref: DataFrame, ref_key: str, ignore_null: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``fk`` has no match in ``ref.ref_key``.

    A null key is an orphan unless ``ignore_null``.  Repeated reference keys do
    not repeat rows.  Planned in two steps so the rows themselves are never
    shuffled for the check: the distinct keys of ``df`` (partial aggregation
    map-side) are anti-joined with the reference keys, then ``df`` keeps its rows
    with a semi join on that orphan-key set, which AQE broadcasts when it is
    small (the usual case) and otherwise joins with its skew split."""
    (f,) = _resolve(df, [fk])
    left = df.filter(col(f).isNotNull()) if ignore_null else df
    keys = left.select(col(f).alias("__k")).distinct()
    missing = keys.join(ref.select(F.col(ref_key).alias("__r")), F.col("__k") == F.col("__r"), "left_anti")
    return left.join(missing, col(f).eqNullSafe(F.col("__k")), "left_semi")


def fk_report(df: DataFrame, fks: Mapping[str, tuple[DataFrame, str]], ignore_null: bool = False) -> DataFrame:
    """Rows (column, orphan_rows, orphan_keys, rows) per foreign-key column.

    Keys are counted before the join (``groupBy(fk).count()``, partial
    aggregation map-side), so the join sees each key once however hot it is.
    The distinct reference keys are hash-partitioned on the key, which the
    following join reuses without another exchange."""
    parts = []
    for fk, (ref, ref_key) in fks.items():
        (f,) = _resolve(df, [fk])
        keys = df.groupBy(col(f).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
        refk = ref.select(F.col(ref_key).alias("__r")).distinct()
        j = keys.join(refk, F.col("__k") == F.col("__r"), "left")
        orphan = F.col("__r").isNull()
        if ignore_null:
            orphan = orphan & F.col("__k").isNotNull()
        parts.append(j.agg(F.lit(fk).alias("column"),
                           F.coalesce(F.sum(F.when(orphan, F.col("__n"))), F.lit(0)).cast("bigint").alias("orphan_rows"),
                           F.count_if(orphan).alias("orphan_keys"),
                           F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------------------------- V8
def suggest_spelling(df: DataFrame, column: str, allowed: Sequence[str], out: str | None = None,
                     max_distance: int | None = None, ignore_case: bool = True) -> DataFrame:
    """For values outside ``allowed``, the nearest allowed value by Levenshtein distance.

    Adds ``<col>_suggestion`` (null for allowed values and nulls, or when the
    nearest is farther than ``max_distance``) and ``<col>_distance``.  Ties go to
    the allowed value that sorts first; an empty list gives nulls.  The allowed list is given, so
    this is one expression per row, no join: for a list of a few dozen values.  For a large one use
    :func:`suggest_from`."""
    (c,) = _resolve(df, [column])
    if not allowed:
        return df.select("*", F.lit(None).cast("string").alias(out or f"{c}_suggestion"), F.lit(None).cast("int").alias(f"{c}_distance"))
    x = F.upper(col(c)) if ignore_case else col(c)
    cands = [F.struct(F.levenshtein(x, F.lit(a.upper() if ignore_case else a)).alias("d"), F.lit(a).alias("v"))
             for a in sorted(allowed)]
    best = F.least(*cands) if len(cands) > 1 else cands[0]
    ok = col(c).isin(list(allowed))
    dist = F.when(~ok, best["d"])
    sugg = F.when(~ok, best["v"])
    if max_distance is not None:
        sugg = F.when(dist <= F.lit(max_distance), sugg)
    name = out or f"{c}_suggestion"
    return df.select("*", sugg.alias(name), dist.alias(f"{c}_distance"))


def _deletions(word: Column, times: int) -> Column:
    """``word`` and all that is left of it after deleting up to ``times`` characters."""
    out = F.array(word)
    for _ in range(times):
        shorter = F.flatten(F.transform(out, lambda w: F.when(F.length(w) > 0, F.transform(
            F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)))).otherwise(F.array(w))))
        out = F.array_distinct(F.concat(out, shorter))
    return out


def suggest_from(df: DataFrame, column: str, allowed: DataFrame, allowed_col: str, max_distance: int = 2,
                 ignore_case: bool = True, out: str | None = None) -> DataFrame:
    """:func:`suggest_spelling` with ``max_distance`` against a dictionary of any size, given as a frame.

    Words at most d edits apart have a common rest after deleting at most d characters of each, so
    both sides are indexed by these rests and joined on equality; only words that meet are compared.
    Each different value is looked up once, however many rows have it; the rests of a word of n
    letters are about n**d / d!, so d is at most 3.  Adds ``<col>_suggestion`` and ``<col>_distance``:
    null for allowed values, nulls, and values without an allowed one so near."""
    if not 0 <= max_distance <= 3:
        raise ValueError("max_distance must be 0 to 3: the index grows with its power")
    (c,) = _resolve(df, [column])
    (a,) = _resolve(allowed, [allowed_col])
    words = allowed.select(col(a).cast("string").alias("word")).filter("word IS NOT NULL").distinct()
    fold = F.upper if ignore_case else (lambda x: x)
    values = df.select(col(c).alias("value")).filter("value IS NOT NULL").distinct().join(
        words, F.col("value") == F.col("word"), "left_anti")
    mine = values.select("value", F.explode(_deletions(fold(F.col("value")), max_distance)).alias("rest"))
    theirs = words.select("word", F.explode(_deletions(fold(F.col("word")), max_distance)).alias("rest"))
    d = F.levenshtein(fold(F.col("value")), fold(F.col("word")))
    met = mine.join(theirs, "rest").select("value", "word").distinct().withColumn("d", d).filter(F.col("d") <= max_distance)
    best = met.groupBy("value").agg(F.min(F.struct("d", "word")).alias("best"))
    value, found = free_name("value", *df.columns), free_name("best", *df.columns)
    best = best.select(F.col("value").alias(value), F.col("best").alias(found))
    return df.join(best, col(c) == F.col(value), "left").select(
        *[col(x) for x in df.columns], F.col(f"{found}.word").alias(out or f"{c}_suggestion"), F.col(f"{found}.d").alias(f"{c}_distance"))
