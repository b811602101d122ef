"""Mixing sources to target weights by temperature.

A source's weight is its share of the tokens to the power of an exponent between 0 (all
sources alike) and 1 (as they are). The exponent is bisected on a grid of 1 / GRID: the
largest that still gives the mixture the target entropy, raised if needed until no
document is repeated more often than the limit. Each step of the bisection is one
aggregation over the sources for several exponents at once, so the number of sources
does not matter to the driver.

The weights become token budgets. Without a given budget the mixture is as small as it can
be with every document in it at least once. A source's budget is spent in epochs: each
epoch is a permutation of its documents by a hash of id and epoch, and the last one ends
where the budget does. The end is found by its hash: token histograms over the leading
bits of the hash, each finer one only inside the bin that holds the end, so no source,
however large, is ever sorted or gathered. Epochs are spread evenly over the mixture, which is
cut into blocks, so every block mixes the sources by their weights.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kempt.llm.common import stored

GRID = 10_000
_BITS, _LEVEL = 60, 12  # of the hash; of one histogram
_AT_ONCE = 24  # exponents tried by one aggregation


def token_count(text: Column) -> Column:
    """Words: runs of anything but ASCII white space; null text has none."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def place(doc_id: Column, epoch: Column, seed: int) -> Column:
    """60-bit hash of id and epoch: the place of a document in an epoch's permutation."""
    text = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), epoch.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def exponent(totals: DataFrame, entropy: float, repeats: float) -> float:
    """The exponent for sources with ``total`` > 0 tokens: largest multiple of 1 / GRID with at
    least ``entropy`` times the largest possible entropy, or the smallest above it that
    repeats no source more than ``repeats`` times as often as the largest one."""
    n, low, high = totals.agg(F.count(F.lit(1)), F.min("total"), F.max("total")).first()
    if not n:
        return 1.0
    target = entropy * math.log(n) - 1e-9
    lo, hi = 0, GRID + 1  # entropy falls with the exponent; at lo it suffices, at hi it does not
    while hi - lo > 1:
        tried = sorted({lo + (hi - lo) * i // (_AT_ONCE + 1) for i in range(1, _AT_ONCE + 1)} - {lo, hi}) or [(lo + hi) // 2]
        sums = []
        for k in tried:
            w = F.pow(F.col("total").cast("double") / high, F.lit(k / GRID))
            sums += [F.sum(w), F.sum(w * F.log(F.col("total").cast("double") / high))]
        got = totals.agg(*sums).first()
        for i, k in enumerate(tried):
            z, zl = got[2 * i], got[2 * i + 1]
            if math.log(z) - k / GRID * zl / z >= target:
                lo = k
            else:
                hi = min(hi, k)
                break
    if lo < GRID and (high / low) ** (1 - lo / GRID) > repeats + 1e-9:
        hi = GRID  # an exponent of 1 repeats nothing
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if (high / low) ** (1 - mid / GRID) <= repeats + 1e-9 else (mid, hi)
        lo = hi
    return lo / GRID


def schedule(rows: DataFrame, entropy: float = 0.999, repeats: float = 1.5, budget: int | None = None, seed: int = 0) -> DataFrame:
    """One row per source: source, epochs (full ones), stop (documents of the next epoch whose
    ``place`` is smaller are in the mixture too), passes (budget as a multiple of the source).
    ``rows``: doc_id, source, tokens."""
    rows = stored(rows, "mix-rows")
    totals = stored(rows.groupBy("source").agg(F.sum("tokens").cast("long").alias("total")), "mix-totals")
    filled = totals.filter("total > 0")
    alpha = exponent(filled, entropy, repeats)
    high = filled.agg(F.max("total")).first()[0]
    # relative to the largest source, whose documents are then taken once
    quota = F.col("total") * F.pow(F.lit(float(high or 1)) / F.col("total").cast("double"), F.lit(1 - alpha))
    scale = 1.0
    if budget is not None and high:
        scale = budget / float(filled.agg(F.sum(quota)).first()[0])
    state = stored(totals.select(
        "source", "total", F.when(F.col("total") > 0, F.round(quota * scale)).otherwise(0).cast("long").alias("quota"))
        .select("source", "total", "quota",
                F.when(F.col("total") > 0, F.floor(F.col("quota") / F.col("total"))).otherwise(1).cast("long").alias("epochs"))
        .withColumn("left", F.col("quota") - F.col("epochs") * F.col("total"))
        .withColumn("prefix", F.lit(0).cast("long")), "mix-state")

    placed = rows.join(state.select("source", "epochs"), "source").select(
        "source", "tokens", place(F.col("doc_id"), F.col("epochs"), seed).alias("h"))
    placed = stored(placed.groupBy("source", "h").agg(F.sum("tokens").alias("tokens")), "mix-places")
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for shift in range(_BITS - _LEVEL, -1, -_LEVEL):
        inside = placed.join(state.filter("total > 0").select("source", "prefix"), "source").filter(
            F.expr(f"shiftright(h, {shift + _LEVEL})") == F.col("prefix"))
        bins = inside.groupBy("source", F.expr(f"shiftright(h, {shift})").alias("bin")).agg(F.sum("tokens").alias("n"))
        over = (bins.withColumn("upto", F.sum("n").over(upto)).join(state.select("source", "left"), "source")
                .filter(F.col("upto") > F.col("left")).groupBy("source")
                .agg(F.min("bin").alias("bin"), F.min_by(F.col("upto") - F.col("n"), "bin").alias("before")))
        state = stored(state.join(over, "source", "left").select(
            "source", "total", "quota", "epochs", (F.col("left") - F.coalesce("before", F.lit(0))).alias("left"),
            F.coalesce("bin", F.expr(f"shiftleft(prefix, {_LEVEL})")).alias("prefix")), "mix-state")
    return state.select("source", "epochs", F.when(F.col("total") > 0, F.col("prefix")).otherwise(0).alias("stop"),
                        F.when(F.col("total") > 0, F.col("quota") / F.col("total")).otherwise(1.0).alias("passes"))


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), _source(source_col).alias("source"),
                       token_count(F.col(f"`{text_col}`")).alias("tokens"))


def _source(source_col: str) -> Column:
    return F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit(""))


def _copies(doc_id: Column, seed: int) -> Column:
    epochs = F.col("epochs")
    return (epochs + (place(doc_id, epochs, seed) < F.col("stop")).cast("long")).cast("int")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", entropy: float = 0.999,
        repeats: float = 1.5, budget: int | None = None, blocks: int = 1024, seed: int = 0) -> DataFrame:
    """One row per copy of a document in the mixture: doc_id, source, tokens, epoch (from 0),
    block (0 to ``blocks`` - 1), position (0 to 1; the order of the mixture).

    Documents of the last epoch are taken in the order of ``place`` while the source's budget
    lasts; documents with the same place (rows of one id) are taken together or not at all. A
    null source is the source "". Sources without any token are taken once. An empty table
    gives no rows."""
    rows = _rows(docs, id_col, text_col, source_col)
    plan = stored(schedule(rows, entropy, repeats, budget, seed), "mix-schedule")
    copies = rows.join(plan, "source").withColumn("copies", _copies(F.col("doc_id"), seed)).filter("copies > 0")
    out = copies.select("doc_id", "source", "tokens", "passes", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("epoch"))
    part = place(F.col("doc_id"), F.col("epoch"), seed).cast("double") / float(1 << _BITS)
    position = F.least((F.col("epoch") + part) / F.greatest("passes", F.lit(1.0)), F.lit(1.0))
    return out.select("doc_id", "source", "tokens", "epoch", F.least(F.floor(position * blocks), F.lit(blocks - 1)).cast("int").alias("block"),
                      position.alias("position"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    entropy: float = 0.999, repeats: float = 1.5, seed: int = 0) -> DataFrame:
    """``docs`` with each row as often as the mixture has it; columns unchanged."""
    plan = stored(schedule(_rows(docs, id_col, text_col, source_col), entropy, repeats, None, seed)
                  .withColumnRenamed("source", "planned"), "mix-schedule")
    # rows travel as one struct, so that no column of theirs can clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{id_col}`").cast("long").alias("doc_id"), _source(source_col).alias("source"))
    joined = rows.join(plan, F.col("source") == F.col("planned"))
    copies = joined.select("row", F.explode(F.sequence(F.lit(1), _copies(F.col("doc_id"), seed))).alias("copy"))
    return copies.select(*[F.col(f"row.`{c}`") for c in docs.columns])
