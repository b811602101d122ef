"""Column-expression helpers shared by the operators (all JVM-side built-ins)."""

from kempt.functions.columns import (
    SPECIAL_CHARS,
    blank_as_null,
    col,
    free_name,
    guarded_cast,
    is_numeric,
    is_string,
    q,
    string_columns,
)

__all__ = [
    "SPECIAL_CHARS",
    "blank_as_null",
    "col",
    "free_name",
    "guarded_cast",
    "is_numeric",
    "is_string",
    "q",
    "string_columns",
]
