"""Privacy operators: one-way hashing and redaction (C20, M13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.functions.columns import col, q
from kempt.operators.cleanse import _replace_cols, _resolve


def hash_cols(df: DataFrame, cols: Sequence[str], bits: int = 256, salt: str | None = None) -> DataFrame:
    """Replace each column by the hex SHA-2 digest of its text (salted when ``salt`` is given).

    Null stays null.  The result type is string."""
    if bits not in (224, 256, 384, 512):
        raise ValueError("bits must be 224, 256, 384 or 512")
    new = {}
    for c in _resolve(df, cols):
        text = col(c).cast("string")
        if salt:
            text = F.concat(F.lit(salt), text)
        new[c] = F.sha2(text, bits)
    return _replace_cols(df, new)


def redact(df: DataFrame, cols: Sequence[str], mode: str = "replace", token: str = "REDACTED",
           keep_last: int = 0, mask_char: str = "*", suffix: str = "_Redacted") -> DataFrame:
    """Hide values.

    mode="replace": the value becomes ``token`` (null stays null).
    mode="add": keep the column and add ``<col><suffix>`` = ``token`` (the reference's form;
    it does not hide the original, so it is not the default).
    mode="mask": every character but the last ``keep_last`` becomes ``mask_char``; a value
    not longer than ``keep_last`` is masked whole, so a short value is never shown in clear.
    """
    names = _resolve(df, cols)
    if mode == "add":
        return df.select("*", *[F.when(col(c).isNotNull(), F.lit(token)).alias(c + suffix) for c in names])
    new = {}
    for c in names:
        if mode == "replace":
            new[c] = F.when(col(c).isNotNull(), F.lit(token))
        elif mode == "mask":
            text = f"CAST({q(c)} AS STRING)"
            n = int(keep_last)
            m = mask_char.replace("'", "''")
            new[c] = F.expr(
                f"CASE WHEN length({text}) > {n} "
                f"THEN concat(repeat('{m}', length({text}) - {n}), right({text}, {n})) "
                f"ELSE repeat('{m}', length({text})) END")
        else:
            raise ValueError("mode must be 'replace', 'add' or 'mask'")
    return _replace_cols(df, new)
