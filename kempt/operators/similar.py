"""Matching by similar token sets (C18): a set-similarity join by prefix filter and verification.

Two sets whose Jaccard similarity reaches a threshold must share a token among the rarest few of
each (the prefix), as otherwise too few are left to share.  So sets meet in an equality join on
prefix tokens, rarest first by their counts on both sides.  A pair is compared once, at its first
common token, and only if the tokens after it on both sides are enough to reach the threshold and
64-bit signatures of the sets do not differ in more bits than the sets may differ in tokens.
Rows are collapsed to different sets before, and a token that is in the prefix of many sets is
dealt out in blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kempt.functions.columns import col, free_name
from kempt.operators.cleanse import _resolve


def token_set(text: Column, grams: int | None = None) -> Column:
    """The sorted, different tokens of a text in lower case: its runs of letters and digits, or with
    ``grams`` its runs of that many characters (a shorter text is one).  Null and a text without
    any give an empty set."""
    x = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    if grams is None:
        parts = F.split(x, r"[^\p{L}\p{N}]+")
    else:
        starts = F.sequence(F.lit(1), F.greatest(F.length(x) - F.lit(grams - 1), F.lit(1)))
        parts = F.transform(starts, lambda i: F.substring(x, i, F.lit(grams)))
    return F.array_sort(F.array_distinct(F.filter(parts, lambda p: p != "")))


def _least_shared(size: Column, threshold: float) -> Column:
    """Tokens that a set must share with any partner; rounding may only make it smaller."""
    return F.ceil(size * F.lit(threshold) - F.lit(1e-9))


def _signature(tokens: Column) -> Column:
    """One bit, by a hash, for each token: a bit that only one of two sets has is a token that the
    other lacks, so the sets differ in at least as many tokens as their signatures in bits."""
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), F.xxhash64(t).bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda acc, t: acc.bitwiseOR(bit(t)))


def similar_sets(left: DataFrame, right: DataFrame, threshold: float, block: int = 4096) -> DataFrame:
    """(left_set, right_set, similarity): all pairs of different token sets, one of each side, whose
    Jaccard similarity is at least ``threshold`` (above 0, up to 1).

    ``left`` and ``right`` hold one column ``tokens`` (see :func:`token_set`); repeats count once, empty
    and null sets take no part.  ``block``: sets of the right side that one task holds at a time
    for one token; a token with more is split into blocks, and the left sets are copied to each."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")

    def sets(df: DataFrame) -> DataFrame:
        return df.select("tokens").filter(F.size("tokens") > 0).distinct()

    both = sets(left).withColumn("side", F.lit(0)).unionByName(sets(right).withColumn("side", F.lit(1)))
    tokens = both.select("side", "tokens", F.explode("tokens").alias("token"))
    often = both.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    # each set again, rarest token first: counts of one width before the tokens order them as text
    order = F.concat(F.lpad(F.col("n").cast("string"), 19, "0"), F.col("token"))
    ranked = tokens.join(often, "token").groupBy("side", "tokens").agg(F.array_sort(F.collect_list(order)).alias("ranked"))
    size = F.size("ranked")
    prefix = F.slice("ranked", F.lit(1), (size - _least_shared(size, threshold) + 1).cast("int"))
    keyed = ranked.select("side", "tokens", "ranked", size.alias("size"), _signature(F.col("ranked")).alias("bits"), F.posexplode(prefix).alias("pos", "key"))

    def of(side: int, name: str) -> DataFrame:
        """The sets of a side by prefix token, and how many tokens they have from it on."""
        return keyed.filter(F.col("side") == side).select(
            "key", F.col("tokens").alias(f"{name}_set"), F.col("ranked").alias(f"{name}_ranked"),
            F.col("size").alias(f"{name}_size"), F.col("bits").alias(f"{name}_bits"), (F.col("size") - F.col("pos")).alias(f"{name}_rest"))

    lefts, rights = of(0, "left"), of(1, "right")
    # tokens that lie in the prefix of more than a block of sets: at most one for each block of rows
    hot = rights.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > block).select(
        "key", F.ceil(F.col("m") / block).cast("int").alias("parts"))
    parts = F.coalesce(F.col("parts"), F.lit(1))
    rights = rights.join(hot, "key", "left").withColumn("part", F.pmod(F.xxhash64("right_set"), parts).cast("int")).drop("parts")
    lefts = lefts.join(hot, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    # the work is in the pairs, not in the bytes that adaptive execution would join partitions by
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lefts, rights = (x.repartition(tasks, "key", "part") for x in (lefts, rights))
    # |a & b| >= t |a | b| asks for t / (1 + t) of both sizes, whatever the sizes are
    sizes = F.col("left_size") + F.col("right_size")
    needed = F.ceil(sizes * F.lit(threshold / (1 + threshold)) - F.lit(1e-9))
    shared = F.array_intersect("left_ranked", "right_ranked")
    similarity = F.size(shared) / (sizes - F.size(shared))
    # one condition, the cheap tests first: Spark puts later filters before earlier ones in a join
    differ = F.bit_count(F.col("left_bits").bitwiseXOR(F.col("right_bits")))
    may = (F.least("left_rest", "right_rest") >= needed) & (differ <= sizes - 2 * needed)
    alike = may & (F.get(shared, F.lit(0)) == F.col("key")) & (similarity >= F.lit(threshold))
    return lefts.join(rights, ["key", "part"]).filter(alike).select("left_set", "right_set", similarity.alias("similarity"))


def match_similar(df: DataFrame, column: str, known: DataFrame, known_col: str, threshold: float = 0.8,
                  grams: int | None = None, prefix: str = "match") -> DataFrame:
    """Each row of ``df`` with the most similar text of ``known``: columns ``<prefix>_text`` and
    ``<prefix>_similarity`` (Jaccard of token sets), null if none reaches ``threshold``.  They replace
    columns of these names.

    Ties go to the smaller text.  Null texts, and texts without tokens, match nothing.  Rows are
    never repeated, and equal texts are compared once: what is joined back is one row per
    different token set."""
    (c,), (k,) = _resolve(df, [column]), _resolve(known, [known_col])
    out = (f"{prefix}_text", f"{prefix}_similarity")
    texts = (known.select(token_set(col(k), grams).alias("tokens"), col(k).cast("string").alias("text"))
             .groupBy("tokens").agg(F.min("text").alias("text")))
    asked = df.select(token_set(col(c), grams).alias("tokens"))
    pairs = similar_sets(asked, texts, threshold).join(texts, F.col("right_set") == F.col("tokens"))
    # the largest struct: highest similarity, then the smallest text, by way of the negative similarity
    best = pairs.groupBy("left_set").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "text")).alias("best"))
    row, found, own = (free_name(n, *df.columns) for n in ("tokens", "best", "left_set"))
    best = best.select(F.col("left_set").alias(own), F.col("best").alias(found))
    j = df.withColumn(row, token_set(col(c), grams)).join(best, F.col(row) == F.col(own), "left")
    keep = [col(x) for x in df.columns if x.lower() not in {o.lower() for o in out}]
    return j.select(*keep, F.col(f"{found}.text").alias(out[0]), (-F.col(f"{found}.s")).alias(out[1]))
