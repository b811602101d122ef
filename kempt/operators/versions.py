"""Difference of two versions of a table by a tree of digests (M18, K2).

Every row gets a hash of its key and two hashes of its whole content. Rows are summed up by the
leading bits of the key hash, the left version's content counted up and the right one's down: a
range whose count and sums are all zero holds the same rows on both sides. Only ranges that
differ are looked at again, with more bits, down to single key hashes. So equal ranges never
move a row; what is shuffled are the sums of ranges (combined where they are read) and the rows
of keys that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kempt.functions.columns import col, is_fractional
from kempt.operators.cleanse import _resolve
from kempt.operators.relate import reconcile
from kempt.session import materialize


def _parts(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Values for a hash: nulls told apart by position, both zeros alike."""
    out = []
    for n in names:
        out += [col(n).isNull(), col(n) + F.lit(0.0).cast(df.schema[n].dataType) if is_fractional(df.schema[n].dataType) else col(n)]
    return out


def _hashed(df: DataFrame, keys: Sequence[str], cols: Sequence[str], sign: int) -> DataFrame:
    ks, cs = _resolve(df, keys), _resolve(df, cols)
    rows = [F.xxhash64(F.lit(seed), *_parts(df, [*ks, *cs])) for seed in (1, 2)]
    halves = [x for r in rows for x in (r.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(r, 32))]
    return df.select(F.xxhash64(*_parts(df, ks)).alias("h"), F.lit(sign).cast("long").alias("n"),
                     *[(F.lit(sign) * x).alias(f"s{i}") for i, x in enumerate(halves)])


def _range(h: Column, bits: int) -> Column:
    return F.shiftrightunsigned(h, 64 - bits) if bits < 64 else h


def differing_ranges(left: DataFrame, right: DataFrame, keys: Sequence[str], cols: Sequence[str],
                     bits: Sequence[int] = (12, 24, 64)) -> DataFrame:
    """(h): hashes of the keys whose rows differ between the versions.

    ``bits``: leading bits of the key hash by level, ascending, the last 64. A level has at most
    2**bits sums, and reads the rows again but only groups those of ranges that differed before."""
    if list(bits) != sorted(set(bits)) or not bits or bits[-1] != 64 or bits[0] < 1:
        raise ValueError("bits must ascend to 64")
    both = _hashed(left, keys, cols, 1).unionByName(_hashed(right, keys, cols, -1))
    sums = ["n", *[f"s{i}" for i in range(4)]]
    found, above = None, 0
    for b in bits:
        rows = both if found is None else both.join(found, _range(F.col("h"), above) == F.col("range"), "left_semi")
        per = rows.groupBy(_range(F.col("h"), b).alias("range")).agg(*[F.sum(s).alias(s) for s in sums])
        unequal = F.lit(False)
        for s in sums:
            unequal = unequal | (F.col(s) != 0)
        # written, so that Spark sees how few ranges are left when it chooses the next join
        found, above = materialize(per.filter(unequal).select("range"), f"ranges-{b}"), b
    return found.withColumnRenamed("range", "h")


def diff_versions(left: DataFrame, right: DataFrame, keys: Sequence[str], cols: Sequence[str],
                  bits: Sequence[int] = (12, 24, 64)) -> DataFrame:
    """The rows of ``reconcile(left, right, keys, cols)`` for the keys whose rows differ: status
    changed, left_only, right_only, or duplicate_key where a repeated key's rows are not the same on
    both sides.  Nulls, NaN and both zeros are values as in ``reconcile``; columns outside ``keys``
    and ``cols`` are not compared.  Two different contents agree by accident with probability 2**-128
    at most; maps cannot be hashed and are refused by Spark."""
    found = differing_ranges(left, right, keys, cols, bits)

    def suspects(df: DataFrame) -> DataFrame:
        ks, cs = _resolve(df, keys), _resolve(df, cols)
        slim = df.select(*[col(c) for c in dict.fromkeys([*ks, *cs])])
        return slim.join(found, F.xxhash64(*_parts(df, ks)) == F.col("h"), "left_semi")

    return reconcile(suspects(left), suspects(right), keys, cols).filter("status <> 'matched'")
