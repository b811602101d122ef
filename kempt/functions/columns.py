"""Small Column builders.  Nothing here runs an action."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the special-character class removed by the cleanser
# (anything that is not an ASCII letter, digit, dot or whitespace).
SPECIAL_CHARS = r"[^a-zA-Z0-9.\s]"


def q(name: str) -> str:
    """Back-tick a column name for SQL text (names may hold '-', ' ' or '.')."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Column reference that is safe for names with dots or hyphens."""
    return F.col(q(name))


def free_name(name: str, *taken: str) -> str:
    """``name``, with as many underscores before it as it takes to be none of ``taken``."""
    low = {x.lower() for x in taken}
    name = f"__{name}"
    while name.lower() in low:
        name = f"_{name}"
    return name


def is_string(dt: T.DataType) -> bool:
    return isinstance(dt, (T.StringType, T.VarcharType, T.CharType))


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def is_fractional(dt: T.DataType) -> bool:
    return isinstance(dt, (T.FloatType, T.DoubleType))


def string_columns(df: DataFrame, cols: Iterable[str] | None = None) -> list[str]:
    """String-typed columns of ``df`` (restricted to ``cols`` when given)."""
    wanted = None if cols is None else {c.lower() for c in cols}
    return [f.name for f in df.schema.fields
            if is_string(f.dataType) and (wanted is None or f.name.lower() in wanted)]


def blank_as_null(c: Column, trim: bool = False) -> Column:
    """'' (or whitespace only, with ``trim``) becomes null; other values stay."""
    probe = F.trim(c) if trim else c
    return F.when(probe == F.lit(""), F.lit(None)).otherwise(c)


# Shapes of text that a numeric cast can accept.  Checked before ``try_cast`` because
# a failing string-to-number ``try_cast`` costs an exception per row inside the JVM,
# about ten times the rest of a simple projection; the regex test is cheap.
_INT_TEXT = r"^\s*[+-]?\d+\s*$"
_FLOAT_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[dDfF]?\s*$"
_DECIMAL_TEXT = r"^\s*[+-]?(\p{Nd}+\.?\p{Nd}*|\.\p{Nd}+)([eE][+-]?\d+)?\s*$"
_SPECIAL_FLOAT_TEXT = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"
_INTEGRAL = ("tinyint", "smallint", "int", "integer", "bigint", "long", "short", "byte")


def guarded_cast(c: Column, target: str, source: T.DataType | None = None) -> Column:
    """``try_cast`` with a cheap pre-check for text -> number (same results, no exceptions)."""
    t = target.strip().lower()
    if source is not None and not is_string(source):
        return c.try_cast(target)
    if t in _INTEGRAL:
        return F.when(c.rlike(_INT_TEXT), c.try_cast(target))
    if t in ("double", "float", "real"):
        return F.when(c.rlike(_FLOAT_TEXT) | c.rlike(_SPECIAL_FLOAT_TEXT), c.try_cast(target))
    if t.startswith("decimal"):
        return F.when(c.rlike(_DECIMAL_TEXT), c.try_cast(target))
    return c.try_cast(target)
