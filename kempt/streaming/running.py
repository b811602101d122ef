"""A profile that grows with the data: one stored summary per batch, merged when it is read.

A batch is read once and leaves one row: counts, smallest and largest value, moments about its own
mean, a HyperLogLog sketch and, for numbers, a KLL sketch of every column.  These merge without
the rows, so the profile of everything that ever arrived reads one short row per batch.  A
batch's row lies in a folder named by its id: a batch that is processed again replaces it and is
not counted twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kempt.functions.columns import col, is_numeric
from kempt.operators.cleanse import _resolve
from kempt.operators.quality import _digest

# Registers of a sketch are 2**14: the standard error of a distinct count is 1.04 / 2**7 = 0.8 %.
_LG_K = 14
# Size of a quantile sketch: the rank of an estimated median is off by about 0.4 % of the rows.
_KLL_K = 800


def _ordered(dt: T.DataType) -> bool:
    """Whether values have a smallest and a largest one (maps, variants and intervals have none)."""
    return not any(x in dt.simpleString() for x in ("map<", "variant", "interval"))


def _summary(df: DataFrame, c: str) -> Column:
    dt, x = df.schema[c].dataType, col(c)
    parts = [F.count(F.lit(1)).alias("rows"), F.count_if(x.isNull()).alias("nulls"),
             F.hll_sketch_agg(_digest(df, c)[0], F.lit(_LG_K)).alias("sketch")]
    if _ordered(dt):
        parts += [F.min(x).alias("min"), F.max(x).alias("max")]
    if is_numeric(dt):
        v = x.cast("double")
        v = F.when(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), v)
        parts += [F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"),
                  F.kll_sketch_agg_double(v, F.lit(_KLL_K)).alias("quantiles")]
    return F.struct(*parts).alias(c)


def batch_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: column ``columns``, a struct with a summary for each column of ``df``, whatever
    their names.  One pass, a state of about 16 KB a column."""
    cols = _resolve(df, cols) if cols else df.columns
    one = df.agg(*[_summary(df, c).alias(f"s{i}") for i, c in enumerate(cols)])
    return one.select(F.struct(*[F.col(f"s{i}").alias(c) for i, c in enumerate(cols)]).alias("columns"))


def store_summary(df: DataFrame, path: str, batch: str | int, cols: Sequence[str] | None = None) -> None:
    """Store the summary of ``df`` as that of ``batch`` below ``path``, in place of an earlier one."""
    batch_summary(df, cols).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def running_profile(spark: SparkSession, path: str) -> DataFrame:
    """One row per column over all batches stored below ``path``: column, position, type, rows, nulls,
    null_pct, distinct, min, max (as text), mean, stddev, median.

    rows, nulls, min and max are exact; mean and stddev (of a sample) are those of the finite values,
    exact but for rounding, merged about the common mean so that large values with a small spread
    keep their digits; distinct (null is one value, as in ``profile``) has a standard error of
    0.8 %; median is an estimate whose rank is off by about 0.4 %.  NaN is the largest number.
    min and max are null for maps, variants and intervals, the moments for what is no number.  A column
    that came later counts the rows of the batches that have it; a column whose type changed
    between batches is refused by Spark."""
    stored = spark.read.option("mergeSchema", "true").parquet(path).select("columns")
    names = [f.name for f in stored.schema["columns"].dataType.fields]
    kinds = {f.name: f.dataType for f in stored.schema["columns"].dataType.fields}
    flat = stored.select(*[F.col("columns").getField(n).alias(f"s{i}") for i, n in enumerate(names)])
    numbers = [i for i, n in enumerate(names) if "m2" in kinds[n].names]
    # totals by column, one row: the common means, from which the second pass over the summaries measures
    means = flat.agg(F.lit(0).alias("none"), *[
        F.try_divide(F.sum(F.col(f"s{i}.n") * F.col(f"s{i}.mean")), F.sum(f"s{i}.n")).alias(f"s{i}") for i in numbers]).first()
    null = F.lit(None)
    structs = []
    for i, name in enumerate(names):
        fields = kinds[name].names
        s = {f: F.col(f"s{i}.{f}") for f in fields}
        rows, nulls = F.sum(s["rows"]), F.sum(s["nulls"])
        mean, sd, median, kind = null.cast("double"), null.cast("double"), null.cast("double"), "map"
        low = high = null.cast("string")
        if "min" in fields:
            dt = kinds[name]["min"].dataType
            kind = dt.simpleString()
            text = (lambda x: F.to_json(x)) if isinstance(dt, (T.ArrayType, T.StructType)) else (lambda x: x.cast("string"))
            low, high = text(F.min(s["min"])), text(F.max(s["max"]))
        if i in numbers and means[f"s{i}"] is not None:
            m, n = F.lit(means[f"s{i}"]), F.sum(s["n"])
            mean = m
            about = F.sum(s["m2"]) + F.sum(s["n"] * (s["mean"] - m) * (s["mean"] - m))
            sd = F.sqrt(F.try_divide(about, F.nullif(n - 1, F.lit(0))))
            sketch = F.kll_merge_agg_double(F.when(s["n"] > 0, s["quantiles"]), F.lit(_KLL_K))
            median = F.kll_sketch_get_quantile_double(sketch, F.lit(0.5))
        distinct = F.hll_sketch_estimate(F.hll_union_agg(s["sketch"])) + F.when(nulls > 0, 1).otherwise(0)
        structs.append(F.struct(
            F.lit(name).alias("column"), F.lit(i).alias("position"), F.lit(kind).alias("type"), rows.alias("rows"), nulls.alias("nulls"),
            (F.try_divide(nulls, rows) * 100.0).alias("null_pct"), distinct.cast("bigint").alias("distinct"), low.alias("min"),
            high.alias("max"), mean.alias("mean"), sd.alias("stddev"), median.alias("median")).alias(f"p{i}"))
    return flat.agg(*structs).select(F.inline(F.array(*[F.col(f"p{i}") for i in range(len(names))])))
