"""``dirty_orders``: the driver's orders with dirt added by rule.

The driver tables have no nulls, blanks, duplicates or outliers, so the
cleansing operators get their input from this derivation, written once with
the DataFrame API and once as SQL text for the DuckDB oracle.  Every order
is kept (4 % are repeated), so the work grows with the orders table.  The
modulo rules decide where dirt goes; they never remove rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dirty_orders(spark: SparkSession, sf_dir: str, hot_customer: bool = False) -> DataFrame:
    """``hot_customer``: every third order is moved to customer 0, so one key holds a
    third of all rows (the skew every keyed operator here must survive)."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k = F.col("o_orderkey")
    cust = F.when(k % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("o_custkey")) if hot_customer \
        else F.col("o_custkey")
    amount = (F.when(k % 50 == 0, F.lit(None).cast("double"))
              .when(k % 97 == 0, F.col("o_totalprice") * 20)
              .when(k % 101 == 0, F.col("o_totalprice") * -20)
              .otherwise(F.col("o_totalprice")))
    priority = (F.when(k % 40 == 0, F.lit(""))
                .when(k % 230 == 1, F.lit(None).cast("string"))
                .otherwise(F.col("o_orderpriority")))
    status = (F.when(k % 9 == 0, F.concat(F.lit("  "), F.lower(F.col("o_orderstatus")), F.lit(" ")))
              .when(k % 11 == 0, F.lit("Fx"))
              .otherwise(F.col("o_orderstatus")))
    year_txt = F.concat(F.year("o_orderdate").cast("string"), F.when(k % 60 == 0, F.lit("x")).otherwise(F.lit("")))
    region_txt = (F.when(k % 13 == 0, F.lit("NORTH-EAST"))
                  .when(k % 17 == 0, F.lit(None).cast("string"))
                  .otherwise(F.lit("north")))
    # every 25th order appears twice: one scan, the copy made by a generator
    copies = F.when(k % 25 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return o.select(k.alias("id"), cust.alias("custkey"), amount.alias("amount"),
                    priority.alias("priority"), status.alias("status"), year_txt.alias("year_txt"),
                    region_txt.alias("region_txt"), F.explode(copies).alias("__copy")).drop("__copy")


# The same derivation for DuckDB, as CTEs named b and dirty_orders.
DIRTY_CTE = """b AS (
  SELECT o_orderkey AS id, o_custkey AS custkey,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL
         WHEN o_orderkey % 97 = 0 THEN o_totalprice * 20
         WHEN o_orderkey % 101 = 0 THEN o_totalprice * -20
         ELSE o_totalprice END AS amount,
    CASE WHEN o_orderkey % 40 = 0 THEN '' WHEN o_orderkey % 230 = 1 THEN NULL
         ELSE o_orderpriority END AS priority,
    CASE WHEN o_orderkey % 9 = 0 THEN concat('  ', lower(o_orderstatus), ' ')
         WHEN o_orderkey % 11 = 0 THEN 'Fx' ELSE o_orderstatus END AS status,
    concat(CAST(year(o_orderdate) AS varchar),
           CASE WHEN o_orderkey % 60 = 0 THEN 'x' ELSE '' END) AS year_txt,
    CASE WHEN o_orderkey % 13 = 0 THEN 'NORTH-EAST' WHEN o_orderkey % 17 = 0 THEN NULL
         ELSE 'north' END AS region_txt
  FROM orders),
dirty_orders AS (SELECT * FROM b UNION ALL SELECT * FROM b WHERE id % 25 = 0)"""


# The hot-customer variant for DuckDB.
DIRTY_HOT_CTE = DIRTY_CTE.replace(
    "SELECT o_orderkey AS id, o_custkey AS custkey,",
    "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN CAST(0 AS BIGINT) ELSE o_custkey END AS custkey,")
