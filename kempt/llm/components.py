"""Connected components of a large edge table by alternating large-star and small-star
steps (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014).

Every step is a partial aggregation (the smallest neighbour of each node) and an equality
join with it; each result is written, so joins read tables of known size and Spark can
split a hub's rows. Nothing of the graph reaches the driver but a row count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) except the roots themselves, where
    root is the smallest node of the component. No edges: no rows."""
    def mark(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = stored(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
               "edges")
    before = mark(e)
    while before[0]:
        # large star: larger neighbours of u move to the smallest of u and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")), "low")
        e = stored(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
                   "large-star")
        # small star: smaller neighbours of u, and u itself, move to the smallest of them
        low = stored(e.groupBy("u").agg(F.min("v").alias("m")), "low")
        moved = e.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(moved.unionByName(low.withColumnRenamed("m", "v")).distinct(), "small-star")
        after = mark(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
