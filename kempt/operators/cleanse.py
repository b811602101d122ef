"""Row-wise cleansing operators and de-duplication.

Every function is ``(df, ...) -> DataFrame`` and only extends the logical plan;
none of them runs a Spark job.  Operators that touch many columns build a
single ``select`` so the analyzer sees one projection, not one per column.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kempt.functions.columns import (
    SPECIAL_CHARS,
    blank_as_null,
    col,
    is_numeric,
    guarded_cast,
    string_columns,
)


def _replace_cols(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """One projection that swaps the given columns in place (case-insensitive names)."""
    lower = {k.lower(): v for k, v in new.items()}
    out = [lower[f.name.lower()].alias(f.name) if f.name.lower() in lower else col(f.name)
           for f in df.schema.fields]
    return df.select(*out)


def _resolve(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Map user names to the frame's actual names (Spark resolves case-insensitively)."""
    by_lower = {f.name.lower(): f.name for f in df.schema.fields}
    out = []
    for n in names:
        if n.lower() not in by_lower:
            raise ValueError(f"column {n!r} not in {df.columns}")
        out.append(by_lower[n.lower()])
    return out


# --------------------------------------------------------------------------- C1 / M9
def dedupe(df: DataFrame, subset: Sequence[str] | None = None,
           order_by: Sequence[str] | None = None, keep: str = "any") -> DataFrame:
    """Drop duplicate rows (whole row, or by ``subset`` keys).

    ``keep="any"``: ``dropDuplicates`` (a hash aggregate with map-side partial
    aggregation, so one hot key is collapsed before the shuffle).
    ``keep="latest"`` / ``"earliest"``: per key keep the row with the greatest /
    smallest ``order_by`` tuple.  Written as ``max_by``/``min_by`` over a struct,
    which also aggregates partially map-side; a window with ``row_number`` would
    instead sort every row of a hot key inside one task.
    """
    if keep == "any":
        return df.dropDuplicates(list(subset) if subset else None)
    if keep not in ("latest", "earliest"):
        raise ValueError("keep must be 'any', 'latest' or 'earliest'")
    if not subset or not order_by:
        raise ValueError("keep='latest'/'earliest' needs subset and order_by")
    keys = _resolve(df, subset)
    order = _resolve(df, order_by)
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if keep == "latest" else F.min_by
    row = F.struct(*[col(c) for c in rest])
    rank = F.struct(*[col(c) for c in order])
    out = df.groupBy(*[col(k) for k in keys]).agg(pick(row, rank).alias("__row"))
    return out.select(*[col(k) for k in keys], "__row.*").select(*df.columns)


# --------------------------------------------------------------------------- C2
def blank_to_null(df: DataFrame, cols: Sequence[str] | None = None, trim: bool = False) -> DataFrame:
    """Empty strings (or whitespace-only with ``trim``) become null, string columns only.

    Non-string columns are never compared with '' (that raises under ANSI)."""
    targets = string_columns(df, cols)
    return _replace_cols(df, {c: blank_as_null(col(c), trim) for c in targets})


# --------------------------------------------------------------------------- C3 / M4
def upper_strings(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Upper-case string columns (all of them by default)."""
    return _replace_cols(df, {c: F.upper(col(c)) for c in string_columns(df, cols)})


# --------------------------------------------------------------------------- C9
def trim_strings(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Strip leading and trailing spaces from string columns."""
    return _replace_cols(df, {c: F.trim(col(c)) for c in string_columns(df, cols)})


# --------------------------------------------------------------------------- C4 / C10 / C16 / M6
def map_values(df: DataFrame, mapping: Mapping[str, Mapping] | None = None, *,
               table: DataFrame | None = None, column: str | None = None,
               from_col: str = "from", to_col: str = "to") -> DataFrame:
    """Exact-value replacement per column; unmapped values and nulls stay as they are, a value
    mapped to null becomes null.

    One lookup per value (no cascading: with a->b and b->c, 'a' becomes 'b').
    A dict becomes a literal map in the row expression, whatever its size: meant for
    the short lists of a configuration.  For long lists give a mapping ``table`` for
    ``column``: it is joined on the value, and Spark broadcasts it only when its
    measured size is under the threshold.
    """
    if table is not None:
        if column is None:
            raise ValueError("column is required with a mapping table")
        return _map_by_join(df, column, table, from_col, to_col)
    inline: dict[str, Column] = {}
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    for name, m in (mapping or {}).items():
        (real,) = _resolve(df, [name])
        dt = types[real.lower()]
        if not m:
            continue
        kv: list[Column] = []
        for k, v in m.items():
            kv += [F.lit(k).cast(dt), F.lit(v).cast(dt)]
        lookup = F.create_map(*kv)
        c = col(real)
        inline[real] = F.when(F.map_contains_key(lookup, c), F.try_element_at(lookup, c)).otherwise(c)
    return _replace_cols(df, inline) if inline else df


def _map_by_join(df: DataFrame, column: str, table: DataFrame, from_col: str, to_col: str) -> DataFrame:
    (real,) = _resolve(df, [column])
    m = table.select(F.col(from_col).alias("__from"), F.col(to_col).alias("__to")).dropDuplicates(["__from"])
    joined = df.join(m, col(real) == F.col("__from"), "left")
    mapped = F.when(F.col("__from").isNotNull(), F.col("__to")).otherwise(col(real))
    return _replace_cols(joined, {real: mapped}).drop("__from", "__to")


# --------------------------------------------------------------------------- C6 / D2
def round_cols(df: DataFrame, cols: Sequence[str], scale: int = 2) -> DataFrame:
    """Round numeric columns to ``scale`` places, half-up on the value as written
    (2083.095 -> 2083.10). NaN, infinity and null stay as they are."""
    return _replace_cols(df, {c: F.round(col(c), scale) for c in _resolve(df, cols)})


# --------------------------------------------------------------------------- C15 / M11 (as coded)
def round_to_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Round half-up to whole numbers and store as int; NaN, infinity and values out of int
    range become null."""
    return _replace_cols(df, {c: F.round(col(c), 0).try_cast("int") for c in _resolve(df, cols)})


# --------------------------------------------------------------------------- C7
def drop_incomplete(df: DataFrame, min_non_null: int, subset: Sequence[str] | None = None) -> DataFrame:
    """Keep rows with at least ``min_non_null`` values (among ``subset``) that are neither null nor NaN."""
    return df.dropna(thresh=min_non_null, subset=_resolve(df, subset) if subset else None)


# --------------------------------------------------------------------------- C8 / M3
def cast_cols(df: DataFrame, types: Mapping[str, str], on_error: str = "null") -> DataFrame:
    """Cast columns to the given Spark SQL types.

    ``on_error="null"`` uses ``try_cast`` (bad values become null);
    ``"fail"`` uses ``cast`` (ANSI: the job fails on the first bad value)."""
    if on_error not in ("null", "fail"):
        raise ValueError("on_error must be 'null' or 'fail'")
    new = {}
    src = {f.name: f.dataType for f in df.schema.fields}
    for name, t in types.items():
        (c,) = _resolve(df, [name])
        new[c] = guarded_cast(col(c), t, src[c]) if on_error == "null" else col(c).cast(t)
    return _replace_cols(df, new)


# --------------------------------------------------------------------------- C12
def parse_dates(df: DataFrame, formats: Mapping[str, Sequence[str] | str]) -> DataFrame:
    """Parse text to ``date`` trying each format in turn; unparseable values become null.

    ``'yyyy'`` alone gives the 1st of January of that year."""
    new = {}
    for name, fmts in formats.items():
        (c,) = _resolve(df, [name])
        fl = [fmts] if isinstance(fmts, str) else list(fmts)
        text = col(c).cast("string")
        new[c] = F.coalesce(*[F.try_to_date(text, f) for f in fl]) if len(fl) > 1 \
            else F.try_to_date(text, fl[0])
    return _replace_cols(df, new)


# --------------------------------------------------------------------------- C13 / T20
def drop_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; names that are absent are ignored (as ``DataFrame.drop``)."""
    present = {f.name.lower() for f in df.schema.fields}
    return df.drop(*[c for c in cols if c.lower() in present])


# Other names of character sets and the names Spark accepts.
_CHARSETS = {"ASCII": "US-ASCII", "LATIN1": "ISO-8859-1", "LATIN-1": "ISO-8859-1", "ISO8859-1": "ISO-8859-1",
             "UTF8": "UTF-8", "UTF16": "UTF-16", "UTF32": "UTF-32"}


# --------------------------------------------------------------------------- C14
def reencode(df: DataFrame, cols: Sequence[str] | None = None, charset: str = "UTF-8",
             on_error: str = "replace") -> DataFrame:
    """Round-trip string columns through ``charset`` (``encode`` then ``decode``).

    For UTF-8 this is the identity on valid text.  Spark refuses unmappable
    characters for narrow charsets, so with ``on_error="replace"`` and US-ASCII
    non-ASCII characters are first replaced by '?'; ISO-8859-1 keeps U+0000-U+00FF."""
    cs = charset.upper().replace("_", "-")
    cs = _CHARSETS.get(cs, cs)
    targets = string_columns(df, cols)
    new = {}
    for c in targets:
        v = col(c)
        if on_error == "replace":
            if cs == "US-ASCII":
                v = F.regexp_replace(v, r"[^\x00-\x7F]", "?")
            elif cs == "ISO-8859-1":
                v = F.regexp_replace(v, r"[^\x00-\xFF]", "?")
        new[c] = F.decode(F.encode(v, cs), cs)
    return _replace_cols(df, new)


# --------------------------------------------------------------------------- C19 / M8
def strip_special(df: DataFrame, cols: Sequence[str] | None = None, exclude: Sequence[str] = (),
                  pattern: str = SPECIAL_CHARS, replacement: str = "") -> DataFrame:
    """Delete characters matching ``pattern`` from string columns in one projection.

    Numeric columns are left alone (stripping '-' from a negative number, as a
    text cast would, corrupts it).  No pre-count: replacing in a column with no
    match is a no-op, so one pass replaces the reference's per-column count jobs."""
    skip = {c.lower() for c in exclude}
    targets = [c for c in string_columns(df, cols) if c.lower() not in skip]
    return _replace_cols(df, {c: F.regexp_replace(col(c), pattern, replacement) for c in targets})


# --------------------------------------------------------------------------- T18 / D3
def convert_unit(df: DataFrame, column: str, factor: float, out: str | None = None,
                 scale: int | None = 2) -> DataFrame:
    """``out = round(column * factor, scale)`` (in place when ``out`` is None)."""
    (c,) = _resolve(df, [column])
    v = col(c) * F.lit(factor)
    if scale is not None:
        v = F.round(v, scale)
    return df.withColumn(out or c, v)


def numeric_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    wanted = None if cols is None else {c.lower() for c in cols}
    return [f.name for f in df.schema.fields
            if is_numeric(f.dataType) and (wanted is None or f.name.lower() in wanted)]
