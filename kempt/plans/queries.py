"""Registered queries: each one runs an operator over the driver's whole tables and has,
where SQL can say the same thing, a DuckDB oracle text with identical column names.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE[name] -> str``.
Computed doubles are rounded half-up through a decimal in both engines
(``stable_round`` / ``rnd``), since the two engines may sum in a different order.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kempt.operators import cleanse, derive, privacy, quality, relate, stats
from kempt.plans.dirty import DIRTY_CTE, DIRTY_HOT_CTE, dirty_orders
from kempt.plans.pipeline import run_pipeline
from kempt.session import materialize, scratch_dir
from kempt.sources import files, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def stable_round(c: Column, scale: int = 2) -> Column:
    """For comparing sums and means only, whose last bits depend on the order of addition:
    half-up through six decimals, which absorbs that noise."""
    return F.round(c.cast("decimal(38,6)"), scale).cast("double")


def rnd(x: str, s: int = 2) -> str:
    """SQL twin of ``stable_round``."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,6)), {s}) AS DOUBLE)"


def rnd_text(x: str, s: int = 2) -> str:
    """Half-up rounding of a double as written, for the operators that round."""
    return f"CAST(ROUND(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {s}) AS DOUBLE)"


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def W(sql: str) -> str:
    """Prefix the dirty_orders CTEs."""
    return f"WITH {DIRTY_CTE},\n{sql}" if not sql.lstrip().upper().startswith("SELECT") else \
        f"WITH {DIRTY_CTE}\n{sql}"


# Fixed values for the dirt-fixing maps (cf. the reference's typo and category maps).
STATUS_FIX = {"Fx": "F"}
REGION_FIX = {"NORTH-EAST": "north", "north": "south"}


# =========================================================================== flagship
def flagship_df(spark: SparkSession, sf: str, materialize_clean: bool = True, hot_customer: bool = False) -> DataFrame:
    """read -> dedupe -> blank_to_null -> map_values -> winsorize -> aggregate by region.

    Orders are pre-aggregated per customer before the dimension joins (a hot
    customer collapses map-side), the customer join is left to AQE (it grows
    with the data), nation and region are fixed-size (25 / 5 rows) and broadcast."""
    x = dirty_orders(spark, sf, hot_customer)
    x = cleanse.dedupe(x)
    x = cleanse.blank_to_null(x)
    x = cleanse.map_values(x, {"status": STATUS_FIX})
    fitted = None
    if materialize_clean:
        # the winsorize fit and the aggregation both need the de-duplicated rows: write
        # them once, and compute the amount statistics during that same write
        x = x.select("custkey", "amount", "priority", "status")
        x, metrics = materialize(x, "flagship-clean", observe=stats.moment_exprs(x, ["amount"]))
        fitted = stats.moments_from(metrics, x, ["amount"])
    x = stats.winsorize(x, ["amount"], threshold=3.0, mode="clamp", stats=fitted)
    per_cust = x.groupBy("custkey").agg(F.count(F.lit(1)).alias("n"), F.count("amount").alias("na"),
                                        F.sum("amount").alias("s"), F.max("amount").alias("hi"),
                                        F.min("amount").alias("lo"),
                                        F.count_if(F.col("priority").isNull()).alias("np"),
                                        F.count_if(F.col("status") == "F").alias("nf"))
    cust = t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = F.broadcast(t(spark, sf, "nation").select("n_nationkey", "n_regionkey"))
    region = F.broadcast(t(spark, sf, "region").select("r_regionkey", "r_name"))
    j = (per_cust.join(cust, per_cust.custkey == cust.c_custkey)
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    return j.groupBy("r_name").agg(
        F.sum("n").cast("bigint").alias("n_orders"),
        F.sum("na").cast("bigint").alias("n_amount"),
        stable_round(F.sum("s") / F.sum("na"), 2).alias("avg_amount"),
        stable_round(F.max("hi"), 2).alias("max_amount"),
        stable_round(F.min("lo"), 2).alias("min_amount"),
        F.sum("np").cast("bigint").alias("null_priority"), F.sum("nf").cast("bigint").alias("finished"))


_CLEAN_SQL = """d AS (SELECT DISTINCT * FROM dirty_orders),
c AS (SELECT id, custkey, amount,
        CASE WHEN priority = '' THEN NULL ELSE priority END AS priority,
        CASE WHEN status = 'Fx' THEN 'F' ELSE status END AS status,
        year_txt,
        CASE WHEN region_txt = '' THEN NULL ELSE region_txt END AS region_txt
      FROM d),
s AS (SELECT avg(amount) AS m, stddev_samp(amount) AS sd FROM c),
w AS (SELECT c.id, c.custkey, c.priority, c.status,
        CASE WHEN abs((amount - m) / sd) > 3 AND amount > m THEN m + 3 * sd
             WHEN abs((amount - m) / sd) > 3 THEN m - 3 * sd
             ELSE amount END AS amount
      FROM c, s)"""

_FLAGSHIP_SQL = _CLEAN_SQL + f""",
r AS (SELECT r_name, amount, priority, status FROM w
      JOIN customer ON w.custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey)
SELECT r_name, count(*) AS n_orders, count(amount) AS n_amount,
       {rnd('avg(amount)')} AS avg_amount, {rnd('max(amount)')} AS max_amount,
       {rnd('min(amount)')} AS min_amount,
       CAST(sum(CASE WHEN priority IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_priority,
       count(*) FILTER (WHERE status = 'F') AS finished
FROM r GROUP BY r_name"""

query("flagship", W(_FLAGSHIP_SQL))(flagship_df)


@query("flagship_hot_customer", f"WITH {DIRTY_HOT_CTE},\n{_FLAGSHIP_SQL}")
def q_flagship_hot(spark, sf):
    """The flagship with one customer holding a third of the orders."""
    return flagship_df(spark, sf, hot_customer=True)


@query("fk_report_hot_customer", f"""WITH {DIRTY_HOT_CTE},
k AS (SELECT custkey AS k, count(*) AS n FROM dirty_orders GROUP BY custkey),
r AS (SELECT DISTINCT c_custkey AS r FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')
SELECT 'custkey' AS "column", CAST(coalesce(sum(n) FILTER (WHERE r IS NULL), 0) AS BIGINT) AS orphan_rows,
  count(*) FILTER (WHERE r IS NULL) AS orphan_keys, CAST(sum(n) AS BIGINT) AS rows
FROM k LEFT JOIN r ON k = r""")
def q_fk_report_hot(spark, sf):
    ref = t(spark, sf, "customer").filter(F.col("c_mktsegment") != "AUTOMOBILE")
    return quality.fk_report(dirty_orders(spark, sf, hot_customer=True), {"custkey": (ref, "c_custkey")})


@query("dedupe_latest_hot_customer", f"""WITH {DIRTY_HOT_CTE}
SELECT id, custkey, amount, priority, status, year_txt, region_txt FROM (
  SELECT *, row_number() OVER (PARTITION BY custkey ORDER BY id DESC) AS rn FROM dirty_orders) WHERE rn = 1""")
def q_dedupe_latest_hot(spark, sf):
    return cleanse.dedupe(dirty_orders(spark, sf, hot_customer=True), ["custkey"], ["id"], keep="latest")


# =========================================================================== C1 / M9
@query("dedupe_rows", W("SELECT DISTINCT * FROM dirty_orders"))
def q_dedupe_rows(spark, sf):
    return cleanse.dedupe(dirty_orders(spark, sf))


@query("dedupe_latest", """SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def q_dedupe_latest(spark, sf):
    return cleanse.dedupe(t(spark, sf, "events"), ["user_id"], ["ts", "event_id"], keep="latest")


@query("dedupe_keys", W("""SELECT DISTINCT id, custkey, amount, priority, status, year_txt, region_txt, true AS from_input
FROM dirty_orders"""))
def q_dedupe_keys(spark, sf):
    """One whole row per key; repeats of an order are equal rows, so any of them is right."""
    x = dirty_orders(spark, sf)
    d = cleanse.dedupe(x, ["id"])
    cols = d.columns
    there = x.select(*[F.col(c).alias(f"x_{c}") for c in cols]).distinct().withColumn("found", F.lit(True))
    same = F.lit(True)
    for c in cols:
        same = same & d[c].eqNullSafe(F.col(f"x_{c}"))
    return d.join(there, same, "left").select(*cols, F.col("found").isNotNull().alias("from_input"))


# =========================================================================== C2 / C7 / T2
def _sql_blank(c: str, trim: bool = False) -> str:
    probe = f"trim({c})" if trim else c
    return f"CASE WHEN {probe} = '' THEN NULL ELSE {c} END AS {c}"


_DO_STR = ["priority", "status", "year_txt", "region_txt"]
_DO_ALL = ["id", "custkey", "amount", "priority", "status", "year_txt", "region_txt"]


def _do_select(over: dict[str, str]) -> str:
    return ", ".join(over.get(c, c) for c in _DO_ALL)


@query("blank_to_null", W(f"SELECT {_do_select({c: _sql_blank(c, True) for c in _DO_STR})} FROM dirty_orders"))
def q_blank_to_null(spark, sf):
    return cleanse.blank_to_null(dirty_orders(spark, sf), trim=True)


_NONNULL = " + ".join(f"(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END)" for c in _DO_ALL)


@query("drop_incomplete", W(f"SELECT * FROM dirty_orders WHERE {_NONNULL} >= 6"))
def q_drop_incomplete(spark, sf):
    return cleanse.drop_incomplete(dirty_orders(spark, sf), 6)


_SHARES = ", ".join(f"CAST(count(*) - count({c}) AS DOUBLE) * 100.0 / count(*) AS s_{c}" for c in _DO_ALL)
_SPARSE = " AND ".join(f"NOT ({c} IS NULL AND s_{c} > 0 AND s_{c} < 1)" for c in _DO_ALL)


@query("drop_sparse_nulls", W(f"""s AS (SELECT {_SHARES} FROM dirty_orders)
SELECT {', '.join('dirty_orders.' + c for c in _DO_ALL)} FROM dirty_orders, s WHERE {_SPARSE}"""))
def q_drop_sparse_nulls(spark, sf):
    return stats.drop_sparse_nulls(dirty_orders(spark, sf), 1.0)


# =========================================================================== C9 C3 C19 C4
@query("trim_strings", W(f"SELECT {_do_select({c: f'trim({c}) AS {c}' for c in _DO_STR})} FROM dirty_orders"))
def q_trim_strings(spark, sf):
    return cleanse.trim_strings(dirty_orders(spark, sf))


@query("upper_strings", """SELECT p_partkey, upper(p_name) AS p_name, upper(p_brand) AS p_brand,
  upper(p_type) AS p_type, p_size, p_retailprice FROM part""")
def q_upper_strings(spark, sf):
    return cleanse.upper_strings(t(spark, sf, "part"))


# RE2 spelling of the same class: Java's \s also holds \x0B, RE2's does not.
_SPECIAL_RE2 = r"[^a-zA-Z0-9.\t\n\x0B\f\r ]"


@query("strip_special", f"""SELECT p_partkey, regexp_replace(p_name, '{_SPECIAL_RE2}', '', 'g') AS p_name,
  regexp_replace(p_brand, '{_SPECIAL_RE2}', '', 'g') AS p_brand,
  regexp_replace(p_type, '{_SPECIAL_RE2}', '', 'g') AS p_type, p_size, p_retailprice FROM part""")
def q_strip_special(spark, sf):
    return cleanse.strip_special(t(spark, sf, "part"))


@query("strip_special_docs", f"""SELECT doc_id, regexp_replace(text, '{_SPECIAL_RE2}', '', 'g') AS text,
  lang, source, n_chars FROM documents""")
def q_strip_special_docs(spark, sf):
    return cleanse.strip_special(t(spark, sf, "documents"), cols=["text"])


@query("map_values", W(f"""SELECT {_do_select({
    'status': "CASE WHEN status = 'Fx' THEN 'F' ELSE status END AS status",
    'region_txt': "CASE WHEN region_txt = 'NORTH-EAST' THEN 'north' WHEN region_txt = 'north' THEN 'south' "
                  "ELSE region_txt END AS region_txt"})} FROM dirty_orders"""))
def q_map_values(spark, sf):
    return cleanse.map_values(dirty_orders(spark, sf), {"status": STATUS_FIX, "region_txt": REGION_FIX})


@query("map_values_table", """SELECT p_partkey, coalesce(m.to_brand, p_brand) AS p_brand FROM part
LEFT JOIN (SELECT DISTINCT p_brand AS from_brand, upper(replace(p_brand, '#', '_')) AS to_brand FROM part) m
  ON p_brand = m.from_brand""")
def q_map_values_table(spark, sf):
    p = t(spark, sf, "part")
    mapping = p.select(F.col("p_brand").alias("from"), F.upper(F.replace("p_brand", F.lit("#"), F.lit("_"))).alias("to"))
    return cleanse.map_values(p, table=mapping, column="p_brand").select("p_partkey", "p_brand")


# =========================================================================== C8 C6 C15 C12 C14
@query("cast_cols", W(f"""SELECT {_do_select({
    'year_txt': 'TRY_CAST(year_txt AS INTEGER) AS year_txt',
    'id': 'CAST(id AS VARCHAR) AS id'})} FROM dirty_orders"""))
def q_cast_cols(spark, sf):
    return cleanse.cast_cols(dirty_orders(spark, sf), {"year_txt": "int", "id": "string"})


@query("round_cols", f"""SELECT l_orderkey, l_linenumber,
  {rnd_text('l_extendedprice * (1 - l_discount)')} AS net, {rnd_text('l_extendedprice * (1 + l_tax)', 1)} AS gross
FROM lineitem""")
def q_round_cols(spark, sf):
    li = t(spark, sf, "lineitem")
    d = derive.derive(li, {"net": "l_extendedprice * (1 - l_discount)", "gross": "l_extendedprice * (1 + l_tax)"})
    d = cleanse.round_cols(d, ["net"], 2)
    d = cleanse.round_cols(d, ["gross"], 1)
    return d.select("l_orderkey", "l_linenumber", "net", "gross")


@query("round_to_int", f"""SELECT l_orderkey, l_linenumber,
  TRY_CAST({rnd_text('l_extendedprice', 0)} AS INTEGER) AS l_extendedprice,
  TRY_CAST({rnd_text('l_quantity', 0)} AS INTEGER) AS l_quantity FROM lineitem""")
def q_round_to_int(spark, sf):
    li = t(spark, sf, "lineitem")
    return cleanse.round_to_int(li, ["l_extendedprice", "l_quantity"]).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")


@query("round_scale8", f"""SELECT l_orderkey, l_linenumber,
  {rnd_text('l_extendedprice * (1 - l_discount) / 7', 8)} AS net FROM lineitem""")
def q_round_scale8(spark, sf):
    """More decimals than money has: nothing may be cut before the eighth."""
    d = derive.derive(t(spark, sf, "lineitem"), {"net": "l_extendedprice * (1 - l_discount) / 7"})
    return cleanse.round_cols(d, ["net"], 8).select("l_orderkey", "l_linenumber", "net")


@query("round_ties", f"""SELECT l_orderkey, l_linenumber,
  {rnd_text("CAST(l_quantity || '.1249996' AS DOUBLE)")} AS below, {rnd_text("CAST(l_quantity || '.125' AS DOUBLE)")} AS tie,
  {rnd_text("CAST('-' || l_quantity || '.12500001' AS DOUBLE)")} AS minus
FROM (SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS l_quantity FROM lineitem)""")
def q_round_ties(spark, sf):
    """Values at, just below and just above a tie."""
    d = derive.derive(t(spark, sf, "lineitem"), {
        "below": "cast(concat(cast(l_quantity as bigint), '.1249996') as double)",
        "tie": "cast(concat(cast(l_quantity as bigint), '.125') as double)",
        "minus": "cast(concat('-', cast(l_quantity as bigint), '.12500001') as double)"})
    return cleanse.round_cols(d, ["below", "tie", "minus"], 2).select("l_orderkey", "l_linenumber", "below", "tie", "minus")


@query("parse_dates", W(f"""SELECT {_do_select({
    'year_txt': "CAST(TRY_STRPTIME(year_txt, '%Y') AS DATE) AS year_txt"})} FROM dirty_orders"""))
def q_parse_dates(spark, sf):
    return cleanse.parse_dates(dirty_orders(spark, sf), {"year_txt": "yyyy"})


@query("parse_dates_multi", """SELECT o_orderkey, CAST(coalesce(TRY_STRPTIME(t, '%Y-%m-%d'),
  TRY_STRPTIME(t, '%d/%m/%Y')) AS DATE) AS d FROM (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%d/%m/%Y')
                          ELSE strftime(o_orderdate, '%Y-%m-%d') END AS t FROM orders)""")
def q_parse_dates_multi(spark, sf):
    o = t(spark, sf, "orders")
    txt = o.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd/MM/yyyy"))
                   .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d"))
    return cleanse.parse_dates(txt, {"d": ["yyyy-MM-dd", "dd/MM/yyyy"]})


@query("reencode", r"""SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', '?', 'g') AS text,
  lang, source, n_chars FROM documents""")
def q_reencode(spark, sf):
    return cleanse.reencode(t(spark, sf, "documents"), ["text"], charset="US-ASCII")


@query("reencode_utf8", "SELECT * FROM customer")
def q_reencode_utf8(spark, sf):
    return cleanse.reencode(t(spark, sf, "customer"), charset="UTF-8")


@query("drop_cols", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def q_drop_cols(spark, sf):
    return cleanse.drop_cols(t(spark, sf, "orders"), ["o_orderstatus", "O_ORDERPRIORITY", "not_there"])


@query("convert_unit", f"""SELECT o_orderkey, {rnd_text('o_totalprice * 0.012')} AS amount_usd FROM orders""")
def q_convert_unit(spark, sf):
    o = t(spark, sf, "orders")
    return cleanse.convert_unit(o, "o_totalprice", 0.012, out="amount_usd").select("o_orderkey", "amount_usd")


# =========================================================================== C5
_W_SQL = """s AS (SELECT avg(amount) AS m, stddev_samp(amount) AS sd FROM dirty_orders)
SELECT id, {expr} AS amount FROM dirty_orders, s"""


@query("winsorize_clamp", W(_W_SQL.format(expr=rnd(
    "CASE WHEN abs((amount - m) / sd) > 3 AND amount > m THEN m + 3 * sd "
    "WHEN abs((amount - m) / sd) > 3 THEN m - 3 * sd ELSE amount END"))))
def q_winsorize_clamp(spark, sf):
    w = stats.winsorize(dirty_orders(spark, sf), ["amount"], 3.0, "clamp")
    return w.select("id", stable_round(F.col("amount"), 2).alias("amount"))


@query("winsorize_reference", W(_W_SQL.format(expr=rnd(
    "CASE WHEN abs((amount - m) / sd) > 3 THEN m + 3 * sd ELSE amount END"))))
def q_winsorize_reference(spark, sf):
    w = stats.winsorize(dirty_orders(spark, sf), ["amount"], 3.0, "reference")
    return w.select("id", stable_round(F.col("amount"), 2).alias("amount"))


# =========================================================================== M11 T9 T11
@query("standardize", f"""WITH s AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq,
  avg(l_extendedprice) AS mp, stddev_samp(l_extendedprice) AS sp FROM lineitem)
SELECT l_orderkey, l_linenumber, {rnd('(l_quantity - mq) / sq', 6)} AS l_quantity_z,
  {rnd('(l_extendedprice - mp) / sp', 6)} AS l_extendedprice_z FROM lineitem, s""")
def q_standardize(spark, sf):
    z = stats.standardize(t(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], suffix="_z")
    return z.select("l_orderkey", "l_linenumber", stable_round(F.col("l_quantity_z"), 6).alias("l_quantity_z"),
                    stable_round(F.col("l_extendedprice_z"), 6).alias("l_extendedprice_z"))


@query("min_max", f"""WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
  min(l_discount) AS dlo, max(l_discount) AS dhi FROM lineitem)
SELECT l_orderkey, l_linenumber, {rnd('(l_extendedprice - lo) / (hi - lo)', 6)} AS l_extendedprice_normalized,
  {rnd('(l_discount - dlo) / (dhi - dlo)', 6)} AS l_discount_normalized FROM lineitem, s""")
def q_min_max(spark, sf):
    m = stats.min_max(t(spark, sf, "lineitem"), ["l_extendedprice", "l_discount"],
                      keep=["l_orderkey", "l_linenumber"])
    return m.select("l_orderkey", "l_linenumber",
                    *[stable_round(F.col(c), 6).alias(c) for c in ("l_extendedprice_normalized",
                                                                  "l_discount_normalized")])


@query("min_max_inplace", f"""WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
SELECT event_id, {rnd('(value - lo) / (hi - lo)', 6)} AS value FROM events, s""")
def q_min_max_inplace(spark, sf):
    m = stats.min_max(t(spark, sf, "events"), ["value"], suffix="")
    return m.select("event_id", stable_round(F.col("value"), 6).alias("value"))


# =========================================================================== M10 T8
@query("impute_const", W(f"""SELECT {_do_select({
    'priority': "coalesce(priority, 'UNKNOWN') AS priority",
    'region_txt': "coalesce(region_txt, 'none') AS region_txt"})} FROM dirty_orders"""))
def q_impute_const(spark, sf):
    return stats.impute(dirty_orders(spark, sf), {"priority": "UNKNOWN", "region_txt": "none"})


@query("impute_mean", W(f"""s AS (SELECT avg(amount) AS m FROM dirty_orders)
SELECT id, {rnd('coalesce(amount, m)')} AS amount FROM dirty_orders, s"""))
def q_impute_mean(spark, sf):
    d = stats.impute(dirty_orders(spark, sf), {"amount": "mean"})
    return d.select("id", stable_round(F.col("amount"), 2).alias("amount"))


@query("impute_median_balanced", """WITH h AS (SELECT o_orderkey, ntile(2) OVER (ORDER BY o_orderkey) - 1 AS half,
  count(*) OVER () AS n, row_number() OVER (ORDER BY o_orderkey) AS nth FROM orders),
x AS (SELECT o_orderkey, CASE WHEN nth = n AND n % 2 = 1 THEN NULL ELSE CAST(half AS DOUBLE) END AS bit FROM h)
SELECT o_orderkey, coalesce(bit, (SELECT median(bit) FROM x)) AS bit FROM x
UNION ALL SELECT -1, (SELECT median(bit) FROM x)""")
def q_impute_median_balanced(spark, sf):
    """Exactly as many zeros as ones: the median lies between two heavy values."""
    o = t(spark, sf, "orders").select("o_orderkey")
    n = o.count()
    middle = stats.exact_quantile(o, "o_orderkey", (n // 2 - 1 + n % 2) / max(1, n - 1))
    last = o.agg(F.max("o_orderkey")).first()[0]
    bit = F.when((F.col("o_orderkey") == last) & F.lit(n % 2 == 1), None).otherwise((F.col("o_orderkey") > middle).cast("double"))
    x = o.withColumn("bit", bit).unionByName(o.agg(F.min(F.lit(-1)).cast("bigint").alias("o_orderkey"), F.min(F.lit(None).cast("double")).alias("bit")))
    return stats.impute(x, {"bit": "median"})


@query("impute_median", W(f"""s AS (SELECT median(amount) AS m FROM dirty_orders)
SELECT id, {rnd('coalesce(amount, m)')} AS amount FROM dirty_orders, s"""))
def q_impute_median(spark, sf):
    d = stats.impute(dirty_orders(spark, sf), {"amount": "median"})
    return d.select("id", stable_round(F.col("amount"), 2).alias("amount"))


# =========================================================================== T1
def _describe_sql(cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS count, {rnd(f'avg({c})', 4)} AS mean,
  {rnd(f'stddev_samp({c})', 4)} AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max
  FROM lineitem""")
    return "\nUNION ALL\n".join(parts)


_DESC = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]


@query("describe_text", """SELECT 'c_name' AS "column", count(c_name) AS count, CAST(NULL AS DOUBLE) AS mean,
  CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, min(c_name) AS min_text,
  max(c_name) AS max_text FROM customer
UNION ALL SELECT 'big', count(*), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
  CAST(min(c_custkey + 9007199254740993) AS VARCHAR), CAST(max(c_custkey + 9007199254740993) AS VARCHAR) FROM customer""")
def q_describe_text(spark, sf):
    """Text columns, and integers beyond the exact range of doubles."""
    c = t(spark, sf, "customer").withColumn("big", (F.col("c_custkey") + 9007199254740993).cast("bigint"))
    null = F.lit(None).cast("double")
    big = F.col("column") == "big"
    d = stats.describe_cols(c, ["c_name", "big"])
    return d.select("column", "count", *[F.when(~big, F.col(x)).otherwise(null).alias(x) for x in ("mean", "stddev", "min", "max")],
                    "min_text", "max_text")


@query("describe_cols", _describe_sql(_DESC))
def q_describe_cols(spark, sf):
    d = stats.describe_cols(t(spark, sf, "lineitem"), _DESC)
    return d.select("column", "count", stable_round(F.col("mean"), 4).alias("mean"),
                    stable_round(F.col("stddev"), 4).alias("stddev"), "min", "max")


# =========================================================================== P1-P8 C11 V
_DO_TYPES = {"id": "bigint", "custkey": "bigint", "amount": "double", "priority": "string", "status": "string",
             "year_txt": "string", "region_txt": "string"}


def _profile_sql(table: str, types: dict[str, str]) -> str:
    parts = []
    for i, (c, ty) in enumerate(types.items()):
        parts.append(f"""SELECT '{c}' AS "column", {i} AS position, '{ty}' AS type, count(*) AS rows,
  count(*) - count({c}) AS nulls, CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100.0 AS null_pct,
  count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS "distinct" FROM {table}""")
    return "\nUNION ALL\n".join(parts)


@query("profile", W(_profile_sql("dirty_orders", _DO_TYPES)))
def q_profile(spark, sf):
    return quality.profile(dirty_orders(spark, sf))


_DOC_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


@query("profile_docs", _profile_sql("documents", _DOC_TYPES))
def q_profile_docs(spark, sf):
    return quality.profile(t(spark, sf, "documents"))


_WIDE_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
    "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string",
    "p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int",
    "p_retailprice": "double",
    "s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double",
    "n_nationkey": "int", "n_name": "string", "n_regionkey": "int",
}


def wide_lineitem(spark, sf):
    """Line items with their order, customer, part, supplier and customer nation: 35 columns."""
    li, o, c = t(spark, sf, "lineitem"), t(spark, sf, "orders"), t(spark, sf, "customer")
    p, s, n = t(spark, sf, "part"), t(spark, sf, "supplier"), t(spark, sf, "nation")
    w = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
         .join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey)
         .join(F.broadcast(n), c.c_nationkey == n.n_nationkey))
    return w.select(*_WIDE_TYPES)


@query("profile_wide", """WITH wide AS MATERIALIZED (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON c_nationkey = n_nationkey)
""" + _profile_sql("wide", _WIDE_TYPES))
def q_profile_wide(spark, sf):
    """The reference's profiler ran 4 jobs per column; here the job count does not grow with width."""
    return quality.profile(wide_lineitem(spark, sf))


_LI_COLS = [c for c in _WIDE_TYPES if c.startswith("l_")]


@query("profile_approx", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, true AS distinct_within_5_pct FROM lineitem"""
    for c in _LI_COLS))
def q_profile_approx(spark, sf):
    """Rows and nulls exactly; the estimated distinct counts against exact ones."""
    li = t(spark, sf, "lineitem").select(*_LI_COLS)
    exact = quality.distinct_counts(li).withColumnRenamed("distinct", "__exact")
    near = quality.profile(li, exact=False).join(exact, "column")
    return near.select("column", "rows", "nulls", (F.abs(F.col("distinct") - F.col("__exact")) <= 0.05 * F.col("__exact"))
                       .alias("distinct_within_5_pct"))


def _validate_sql() -> str:
    parts = []
    for c, ty in _DO_TYPES.items():
        fmt = "count(*) FILTER (WHERE NOT regexp_matches(year_txt, '^\\d{4}$'))" if c == "year_txt" else "NULL"
        dom = "count(*) FILTER (WHERE status NOT IN ('F', 'O', 'P'))" if c == "status" else "NULL"
        parts.append(f"""SELECT '{c}' AS "column", '{ty}' AS type, count(*) - count({c}) AS nulls,
  count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS "distinct",
  CAST({fmt} AS BIGINT) AS invalid_format, CAST({dom} AS BIGINT) AS invalid_domain FROM dirty_orders""")
    return "\nUNION ALL\n".join(parts)


@query("validate", W(_validate_sql()))
def q_validate(spark, sf):
    return quality.validate(dirty_orders(spark, sf), formats={"year_txt": r"^\d{4}$"},
                            domains={"status": ["F", "O", "P"]})


_CHECKS = [
    {"check": "not_null", "column": "amount"},
    {"check": "uppercase", "column": "status"},
    {"check": "decimal", "column": "amount", "scale": 2},
    {"check": "allowed", "column": "status", "values": ["F", "O", "P"]},
    {"check": "special_chars", "column": "region_txt"},
    {"check": "format", "column": "year_txt", "regex": r"^\d{4}$"},
    {"check": "row_count", "min": 1},
    {"check": "column_count", "expected": 7},
    {"check": "duplicates"},
]


_QR_SQL = W(f"""q AS (
  SELECT 'not_null' AS "check", 'amount' AS "column", count(*) - count(amount) AS violations, count(*) AS total
    FROM dirty_orders
  UNION ALL SELECT 'uppercase', 'status', count(*) FILTER (WHERE status <> upper(status)), count(*) FROM dirty_orders
  UNION ALL SELECT 'decimal', 'amount', count(*) FILTER (WHERE amount <> {rnd_text('amount')}), count(*) FROM dirty_orders
  UNION ALL SELECT 'allowed', 'status', count(*) FILTER (WHERE status NOT IN ('F', 'O', 'P')), count(*)
    FROM dirty_orders
  UNION ALL SELECT 'special_chars', 'region_txt',
    count(*) FILTER (WHERE regexp_matches(region_txt, '{_SPECIAL_RE2}')), count(*) FROM dirty_orders
  UNION ALL SELECT 'format', 'year_txt', count(*) FILTER (WHERE NOT regexp_matches(year_txt, '^\\d{{4}}$')),
    count(*) FROM dirty_orders
  UNION ALL SELECT 'row_count', NULL, CASE WHEN count(*) < 1 THEN 1 ELSE 0 END, count(*) FROM dirty_orders
  UNION ALL SELECT 'column_count', NULL, 0, count(*) FROM dirty_orders
  UNION ALL SELECT 'duplicates', NULL, sum(n - 1), sum(n) FROM (
    SELECT count(*) AS n FROM dirty_orders GROUP BY {', '.join(_DO_ALL)}))
SELECT "check", "column", CAST(violations AS BIGINT) AS violations, CAST(total AS BIGINT) AS total,
  violations = 0 AS passed FROM q""")


@query("quality_report", _QR_SQL)
def q_quality_report(spark, sf):
    return quality.quality_report(dirty_orders(spark, sf), _CHECKS)


_DUP_SQL = """SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows,
  count(*) FILTER (WHERE n > 1) AS duplicate_groups, CAST(sum(n - 1) AS BIGINT) AS surplus_rows
FROM (SELECT count(*) AS n FROM {src} GROUP BY {keys})"""


@query("duplicate_stats", W(_DUP_SQL.format(src="dirty_orders", keys=", ".join(_DO_ALL))))
def q_duplicate_stats(spark, sf):
    return quality.duplicate_stats(dirty_orders(spark, sf))


@query("duplicate_stats_docs", _DUP_SQL.format(src="documents", keys="text"))
def q_duplicate_stats_docs(spark, sf):
    return quality.duplicate_stats(t(spark, sf, "documents"), ["text"])


_EXPECTED = {"id": "bigint", "custkey": "int", "amount": "double", "priority": "string", "year_txt": "int",
             "status": "string", "loan_amount": "double"}


@query("schema_diff", W("""SELECT 'id' AS "column", 'bigint' AS expected, 'bigint' AS actual, 'match' AS status,
  count(*) FILTER (WHERE id IS NOT NULL AND TRY_CAST(id AS BIGINT) IS NULL) AS bad_values FROM dirty_orders
UNION ALL SELECT 'custkey', 'int', 'bigint', 'type',
  count(*) FILTER (WHERE custkey IS NOT NULL AND TRY_CAST(custkey AS INTEGER) IS NULL) FROM dirty_orders
UNION ALL SELECT 'amount', 'double', 'double', 'match',
  count(*) FILTER (WHERE amount IS NOT NULL AND TRY_CAST(amount AS DOUBLE) IS NULL) FROM dirty_orders
UNION ALL SELECT 'priority', 'string', 'string', 'match',
  count(*) FILTER (WHERE priority IS NOT NULL AND TRY_CAST(priority AS VARCHAR) IS NULL) FROM dirty_orders
UNION ALL SELECT 'year_txt', 'int', 'string', 'type',
  count(*) FILTER (WHERE year_txt IS NOT NULL AND TRY_CAST(year_txt AS INTEGER) IS NULL) FROM dirty_orders
UNION ALL SELECT 'status', 'string', 'string', 'match',
  count(*) FILTER (WHERE status IS NOT NULL AND TRY_CAST(status AS VARCHAR) IS NULL) FROM dirty_orders
UNION ALL SELECT 'loan_amount', 'double', NULL, 'missing', NULL
UNION ALL SELECT 'region_txt', NULL, 'string', 'extra', NULL"""))
def q_schema_diff(spark, sf):
    return quality.schema_diff(dirty_orders(spark, sf), _EXPECTED)


@query("suggest_spelling", """WITH d AS (SELECT DISTINCT status FROM (
  SELECT CASE WHEN o_orderkey % 9 = 0 THEN concat('  ', lower(o_orderstatus), ' ')
              WHEN o_orderkey % 11 = 0 THEN 'Fx' ELSE o_orderstatus END AS status FROM orders)),
c AS (SELECT status, v, dist, row_number() OVER (PARTITION BY status ORDER BY dist, v) AS rn FROM (
  SELECT status, v, levenshtein(upper(status), v) AS dist FROM d, (VALUES ('F'), ('O'), ('P')) a(v)))
SELECT status, CASE WHEN status IN ('F', 'O', 'P') THEN NULL ELSE v END AS status_suggestion,
  CAST(CASE WHEN status IN ('F', 'O', 'P') THEN NULL ELSE dist END AS INTEGER) AS status_distance FROM c WHERE rn = 1""")
def q_suggest_spelling(spark, sf):
    d = dirty_orders(spark, sf).select("status").distinct()
    return quality.suggest_spelling(d, "status", ["F", "O", "P"])


# =========================================================================== C17
@query("orphans", """SELECT * FROM lineitem WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderkey = l_orderkey)""")
def q_orphans(spark, sf):
    done = t(spark, sf, "orders").filter(F.col("o_orderstatus").isin("F", "P"))
    return quality.orphans(t(spark, sf, "lineitem"), "l_orderkey", done, "o_orderkey")


@query("fk_report", W("""k AS (SELECT custkey AS k, count(*) AS n FROM dirty_orders GROUP BY custkey),
r AS (SELECT DISTINCT c_custkey AS r FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'),
SELECT 'custkey' AS "column", CAST(coalesce(sum(n) FILTER (WHERE r IS NULL), 0) AS BIGINT) AS orphan_rows,
  count(*) FILTER (WHERE r IS NULL) AS orphan_keys, CAST(sum(n) AS BIGINT) AS rows
FROM k LEFT JOIN r ON k = r"""))
def q_fk_report(spark, sf):
    ref = t(spark, sf, "customer").filter(F.col("c_mktsegment") != "AUTOMOBILE")
    return quality.fk_report(dirty_orders(spark, sf), {"custkey": (ref, "c_custkey")})


# =========================================================================== C18
def _gazetteer(spark, sf):
    n = t(spark, sf, "nation")
    return n.filter(F.col("n_regionkey") != 4).select(
        F.lower(F.col("n_name")).alias("place"),
        (F.col("n_nationkey") * 3.5 - 40.0).alias("lat"), (F.col("n_regionkey") * 60.0 - 120.0).alias("lon"))


@query("locate", """WITH g AS (SELECT upper(trim(lower(n_name))) AS place, min(n_nationkey * 3.5 - 40.0) AS lat,
  min(n_regionkey * 60.0 - 120.0) AS lon FROM nation WHERE n_regionkey <> 4 GROUP BY 1),
a AS (SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, c_name, n_name, CAST(g.lat AS DOUBLE) AS lat, CAST(g.lon AS DOUBLE) AS lon,
  g.place IS NOT NULL AS address_valid
FROM a LEFT JOIN g ON upper(trim(n_name)) = g.place""")
def q_locate(spark, sf):
    c = t(spark, sf, "customer").join(t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    a = c.select("c_custkey", "c_name", "n_name")
    return relate.locate(a, ["n_name"], _gazetteer(spark, sf))


# =========================================================================== C20 M13
@query("hash_cols", """SELECT sha256(CAST(c_custkey AS VARCHAR)) AS c_custkey, sha256(c_name) AS c_name,
  c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def q_hash_cols(spark, sf):
    return privacy.hash_cols(t(spark, sf, "customer"), ["c_custkey", "c_name"], 256)


@query("hash_cols_salted", """SELECT c_nationkey, sha256('pepper' || c_name) AS c_name FROM customer""")
def q_hash_cols_salted(spark, sf):
    return privacy.hash_cols(t(spark, sf, "customer"), ["c_name"], 256, salt="pepper").select("c_nationkey", "c_name")


@query("redact_replace", """SELECT c_custkey, CASE WHEN c_name IS NOT NULL THEN 'REDACTED' END AS c_name,
  c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def q_redact_replace(spark, sf):
    return privacy.redact(t(spark, sf, "customer"), ["c_name"])


@query("redact_add", """SELECT *, CASE WHEN c_name IS NOT NULL THEN 'REDACTED' END AS c_name_Redacted FROM customer""")
def q_redact_add(spark, sf):
    return privacy.redact(t(spark, sf, "customer"), ["c_name"], mode="add")


@query("mask", """SELECT c_custkey, CASE WHEN length(c_name) > 4 THEN repeat('*', length(c_name) - 4) || right(c_name, 4)
  ELSE repeat('*', length(c_name)) END AS c_name FROM customer""")
def q_mask(spark, sf):
    return privacy.redact(t(spark, sf, "customer"), ["c_name"], mode="mask", keep_last=4).select("c_custkey", "c_name")


# =========================================================================== M5 T19 M12
@query("parse_address", """SELECT page_id, url, string_split_regex(url, '/+')[1] AS scheme,
  string_split_regex(url, '/+')[2] AS host, string_split_regex(url, '/+')[3] AS lang,
  string_split_regex(url, '/+')[4] AS rest, string_split_regex(url, '/+')[5] AS extra FROM pages""")
def q_parse_address(spark, sf):
    p = t(spark, sf, "pages").select("page_id", "url")
    return derive.parse_address(p, "url", ["scheme", "host", "lang", "rest", "extra"], sep="/+")


_URL_RE = r"^(https?)://([^/]+)/([a-z]{2})/"


@query("extract_all", """SELECT page_id, array_to_string(regexp_extract_all(url, '[a-z]+'), '|') AS words FROM pages""")
def q_extract_all(spark, sf):
    p = t(spark, sf, "pages")
    return derive.extract_all(p, "url", "[a-z]+", out="words", group=0).select("page_id", F.concat_ws("|", "words").alias("words"))


@query("extract_pattern", f"""SELECT page_id, regexp_extract(url, '{_URL_RE}', 1) AS scheme,
  regexp_extract(url, '{_URL_RE}', 2) AS host, regexp_extract(url, '{_URL_RE}', 3) AS lang FROM pages""")
def q_extract_pattern(spark, sf):
    p = t(spark, sf, "pages").select("page_id", "url")
    return derive.extract_pattern(p, {"url": (_URL_RE, ["scheme", "host", "lang"])}).drop("url")


@query("json_fields", """SELECT event_id, json_extract_string(props, '$.k') AS k,
  json_extract_string(props, '$.missing') AS missing FROM events""")
def q_json_fields(spark, sf):
    e = t(spark, sf, "events").select("event_id", "props")
    return derive.json_fields(e, "props", {"k": "$.k", "missing": "$.missing"}).drop("props")


@query("concat_default", W("""SELECT id, priority || status AS label FROM dirty_orders"""))
def q_concat_default(spark, sf):
    """The default form: null if any part is null."""
    return derive.concat_cols(dirty_orders(spark, sf), ["priority", "status"], "label").select("id", "label")


@query("concat_cols", """SELECT c_custkey, concat_ws(' / ', c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS label
FROM customer""")
def q_concat_cols(spark, sf):
    c = t(spark, sf, "customer")
    return derive.concat_cols(c, ["c_name", "c_mktsegment", "c_nationkey"], "label", sep=" / ", null_safe=True).select(
        "c_custkey", "label")


# =========================================================================== M7 T10 T13 T17
@query("derive", f"""SELECT l_orderkey, l_linenumber, {rnd('l_extendedprice * (1 - l_discount)')} AS net,
  l_quantity / 2 AS half_qty FROM lineitem""")
def q_derive(spark, sf):
    d = derive.derive(t(spark, sf, "lineitem"), {"net": "l_extendedprice * (1 - l_discount)",
                                                   "half_qty": "l_quantity / 2"})
    return d.select("l_orderkey", "l_linenumber", stable_round(F.col("net"), 2).alias("net"), "half_qty")


@query("encode_map", """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS c_mktsegment_encoded_1,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 2 ELSE 0 END AS c_mktsegment_encoded_2 FROM customer""")
def q_encode_map(spark, sf):
    e = derive.encode_map(t(spark, sf, "customer"), {"c_mktsegment": {"BUILDING": 1, "MACHINERY": 2}})
    return e.select("c_custkey", "c_mktsegment_encoded_1", "c_mktsegment_encoded_2")


@query("one_hot", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS status_F,
  CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS status_O,
  CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS status_P FROM orders""")
def q_one_hot(spark, sf):
    o = derive.one_hot(t(spark, sf, "orders"), "o_orderstatus", ["F", "O", "P"], prefix="status")
    return o.select("o_orderkey", "status_F", "status_O", "status_P")


@query("label_index", """WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand),
r AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY n DESC, p_brand ASC) - 1 AS BIGINT) AS p_brand_index FROM c)
SELECT p_partkey, part.p_brand, r.p_brand_index FROM part LEFT JOIN r ON part.p_brand = r.p_brand""")
def q_label_index(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", "p_brand")
    return derive.label_index(p, "p_brand")


_SPLITS = [-1000, 0, 2500, 5000, 7500, 9000]
_LABELS = ["overdrawn", "low", "middle", "high", "top"]


@query("bin_col", """SELECT c_custkey, c_acctbal, CASE
  WHEN c_acctbal >= -1000 AND c_acctbal < 0 THEN 'overdrawn' WHEN c_acctbal >= 0 AND c_acctbal < 2500 THEN 'low'
  WHEN c_acctbal >= 2500 AND c_acctbal < 5000 THEN 'middle' WHEN c_acctbal >= 5000 AND c_acctbal < 7500 THEN 'high'
  WHEN c_acctbal >= 7500 AND c_acctbal <= 9000 THEN 'top' ELSE 'Unknown' END AS acctbal_band FROM customer""")
def q_bin_col(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return derive.bin_col(c, "c_acctbal", _SPLITS, _LABELS, out="acctbal_band")


@query("age_from_bracket", W("""SELECT id, 2024 - TRY_CAST(substr(year_txt, 1, 2) AS INTEGER) AS Age,
  2024 - TRY_CAST(substr(status, 1, 2) AS INTEGER) AS status_age FROM dirty_orders"""))
def q_age_from_bracket(spark, sf):
    d = derive.age_from_bracket(dirty_orders(spark, sf), "year_txt", "2024-06-30")
    d = derive.age_from_bracket(d, "status", "2024-06-30", out="status_age")
    return d.select("id", "Age", "status_age")


# =========================================================================== M14 M16 T14 T3
@query("where_gt", "SELECT * FROM orders WHERE o_totalprice > 250000")
def q_where_gt(spark, sf):
    return relate.where_cmp(t(spark, sf, "orders"), "o_totalprice", ">", 250000)


@query("where_eq", "SELECT * FROM orders WHERE o_orderstatus = 'P'")
def q_where_eq(spark, sf):
    return relate.where(t(spark, sf, "orders"), "o_orderstatus = 'P'")


@query("project", "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def q_project(spark, sf):
    return relate.project(t(spark, sf, "orders"), ["o_orderkey", "O_TOTALPRICE", "o_orderdate"])


@query("sort_top_k", """SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 100""")
def q_sort_top_k(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return relate.top_k(o, 100, [("o_totalprice", False), ("o_orderkey", True)])


@query("sort_by", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey")
def q_sort_by(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return relate.sort_by(o, [("o_orderdate", False), "o_orderkey"])


# =========================================================================== T4
# Keys shifted by a third of the customers, so that both sides have rows without a match.
_CUST_S = "(SELECT c_custkey + (SELECT max(c_custkey) // 3 FROM customer) AS k, c_name FROM customer)"


def _cust_s(spark, sf):
    c = t(spark, sf, "customer")
    shift = c.agg(F.max("c_custkey")).first()[0] // 3
    return c.select((F.col("c_custkey") + shift).alias("o_custkey"), "c_name")


def _orders_k(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("merge_inner", f"""SELECT o_orderkey, o_custkey, o_totalprice, c_name FROM orders
JOIN {_CUST_S} c ON o_custkey = c.k""")
def q_merge_inner(spark, sf):
    return relate.merge(_orders_k(spark, sf), _cust_s(spark, sf), "o_custkey", "inner")


@query("merge_left", f"""SELECT o_orderkey, o_custkey, o_totalprice, c_name FROM orders
LEFT JOIN {_CUST_S} c ON o_custkey = c.k""")
def q_merge_left(spark, sf):
    return relate.merge(_orders_k(spark, sf), _cust_s(spark, sf), "o_custkey", "left")


@query("merge_right", f"""SELECT o_orderkey, c.k AS o_custkey, o_totalprice, c_name FROM orders
RIGHT JOIN {_CUST_S} c ON o_custkey = c.k""")
def q_merge_right(spark, sf):
    return relate.merge(_orders_k(spark, sf), _cust_s(spark, sf), "o_custkey", "right")


@query("merge_full", f"""SELECT coalesce(o_custkey, c.k) AS o_custkey, o_orderkey, o_totalprice, c_name
FROM orders FULL JOIN {_CUST_S} c ON o_custkey = c.k""")
def q_merge_full(spark, sf):
    return relate.merge(_orders_k(spark, sf), _cust_s(spark, sf), "o_custkey", "full")


@query("merge_full_hot", f"""WITH {DIRTY_HOT_CTE}
SELECT coalesce(custkey, c.k) AS custkey, id, c_name FROM dirty_orders FULL JOIN {_CUST_S} c ON custkey = c.k""")
def q_merge_full_hot(spark, sf):
    """A full join in which one key holds a third of the left rows."""
    left = dirty_orders(spark, sf, True).select("custkey", "id")
    return relate.merge(left, _cust_s(spark, sf).withColumnRenamed("o_custkey", "custkey"), "custkey", "full")


@query("merge_semi", f"""SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT k FROM {_CUST_S} c)""")
def q_merge_semi(spark, sf):
    return relate.merge(_orders_k(spark, sf), _cust_s(spark, sf), "o_custkey", "left_semi")


@query("merge_anti", f"""SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey NOT IN (SELECT k FROM {_CUST_S} c)""")
def q_merge_anti(spark, sf):
    return relate.merge(_orders_k(spark, sf), _cust_s(spark, sf), "o_custkey", "left_anti")


@query("merge_hot_identical", """SELECT o_custkey, c_name, count(*) AS n FROM (
  SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey FROM orders)
LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def q_merge_hot_identical(spark, sf):
    """A third of the rows are one key and nothing else, so that no value tells them apart."""
    k = F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey")).cast("bigint")
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    j = relate.merge(t(spark, sf, "orders").select(k.alias("o_custkey")), c, "o_custkey", "left", salt_buckets=8)
    return j.groupBy("o_custkey", "c_name").agg(F.count(F.lit(1)).alias("n"))


@query("merge_salted", """SELECT l_orderkey, l_linenumber, o_orderstatus FROM lineitem
JOIN orders ON l_orderkey = o_orderkey""")
def q_merge_salted(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    return relate.merge(li, o, "l_orderkey", "inner", salt_buckets=4)


# =========================================================================== T5 T6 T7
@query("split_by", f"""SELECT o_orderstatus AS split, count(*) AS rows, {rnd('sum(o_totalprice)')} AS total
FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY o_orderstatus""")
def q_split_by(spark, sf):
    parts = relate.split_by(t(spark, sf, "orders"), "o_orderstatus", ["F", "O"])
    out = None
    for v, d in parts.items():
        a = d.agg(F.lit(v).alias("split"), F.count(F.lit(1)).alias("rows"),
                  stable_round(F.sum("o_totalprice"), 2).alias("total"))
        out = a if out is None else out.unionByName(a)
    return out


@query("split_write", """SELECT o_orderstatus, count(*) AS rows FROM orders GROUP BY o_orderstatus""")
def q_split_write(spark, sf):
    path = scratch_dir(spark, "split")
    tables.write_split(t(spark, sf, "orders"), "o_orderstatus", path)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"))


@query("pivot_table", f"""SELECT o_orderpriority,
  {rnd("sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F')")} AS F,
  {rnd("sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O')")} AS O,
  {rnd("sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P')")} AS P
FROM orders GROUP BY o_orderpriority""")
def q_pivot_table(spark, sf):
    p = relate.pivot_table(t(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", "o_totalprice", "sum",
                           values=["F", "O", "P"])
    return p.select("o_orderpriority", *[stable_round(F.col(v), 2).alias(v) for v in ("F", "O", "P")])


@query("to_long", """SELECT l_orderkey, l_linenumber, "column", value FROM lineitem
UNPIVOT (value FOR "column" IN (l_quantity, l_discount, l_tax))""")
def q_to_long(spark, sf):
    return relate.to_long(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                          ["l_quantity", "l_discount", "l_tax"])


@query("transpose", """WITH s AS (SELECT o_orderstatus, CAST(count(*) AS VARCHAR) AS n_orders,
  CAST(count(DISTINCT o_custkey) AS VARCHAR) AS n_customers, CAST(min(o_orderkey) AS VARCHAR) AS first_key,
  CAST(max(o_orderkey) AS VARCHAR) AS last_key FROM orders GROUP BY o_orderstatus),
l AS (SELECT o_orderstatus, "column", value FROM s
      UNPIVOT (value FOR "column" IN (n_orders, n_customers, first_key, last_key)))
SELECT "column", max(value) FILTER (WHERE o_orderstatus = 'F') AS F,
  max(value) FILTER (WHERE o_orderstatus = 'O') AS O, max(value) FILTER (WHERE o_orderstatus = 'P') AS P
FROM l GROUP BY "column\"""")
def q_transpose(spark, sf):
    s = t(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count_distinct("o_custkey").alias("n_customers"),
        F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))
    return relate.transpose(s, "o_orderstatus", max_rows=100)


# =========================================================================== M19 D1 T12
@query("aggregate_median", """SELECT o_orderstatus, median(o_totalprice) AS mid, median(o_custkey) AS mid_customer, count(*) AS n
FROM orders GROUP BY 1""")
def q_aggregate_median(spark, sf):
    return relate.aggregate(t(spark, sf, "orders"), ["o_orderstatus"], {
        "mid": ("median", "o_totalprice"), "mid_customer": ("median", "o_custkey"), "n": ("count", "*")})


@query("pivot_no_values", """SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F,
  count(*) FILTER (WHERE o_orderstatus = 'O') AS O, count(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders GROUP BY 1""")
def q_pivot_no_values(spark, sf):
    """Columns found in the data."""
    return relate.pivot_table(t(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", "o_orderkey", "count")


@query("aggregate", f"""SELECT o_orderpriority, count(*) AS n, {rnd('sum(o_totalprice)')} AS total,
  {rnd('avg(o_totalprice)')} AS mean, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY o_orderpriority""")
def q_aggregate(spark, sf):
    a = relate.aggregate(t(spark, sf, "orders"), ["o_orderpriority"],
                         {"n": ("count", "*"), "total": ("sum", "o_totalprice"), "mean": ("avg", "o_totalprice"),
                          "customers": ("count_distinct", "o_custkey")})
    return a.select("o_orderpriority", "n", stable_round(F.col("total"), 2).alias("total"),
                    stable_round(F.col("mean"), 2).alias("mean"), "customers")


@query("aggregate_lineitem", f"""SELECT l_returnflag, l_linestatus, {rnd('sum(l_quantity)')} AS sum_qty,
  {rnd('sum(l_extendedprice * (1 - l_discount))')} AS revenue, count(*) AS n FROM lineitem
GROUP BY l_returnflag, l_linestatus""")
def q_aggregate_lineitem(spark, sf):
    li = derive.derive(t(spark, sf, "lineitem"), {"rev": "l_extendedprice * (1 - l_discount)"})
    a = relate.aggregate(li, ["l_returnflag", "l_linestatus"],
                         {"sum_qty": ("sum", "l_quantity"), "revenue": ("sum", "rev"), "n": ("count", "*")})
    return a.select("l_returnflag", "l_linestatus", stable_round(F.col("sum_qty"), 2).alias("sum_qty"),
                    stable_round(F.col("revenue"), 2).alias("revenue"), "n")


@query("agg_timeframe", f"""SELECT date_trunc('day', ts) AS period, event_type, count(*) AS n,
  {rnd('sum(value)')} AS total FROM events GROUP BY 1, 2""")
def q_agg_timeframe(spark, sf):
    a = derive.agg_timeframe(t(spark, sf, "events"), "ts", "day", ["event_type"],
                             {"n": ("count", "*"), "total": ("sum", "value")})
    return a.select("period", "event_type", "n", stable_round(F.col("total"), 2).alias("total"))


# =========================================================================== M15 T16
_U = "CAST(('0x' || substr(md5({x}), 1, 8)) AS BIGINT) / 4294967296.0"


@query("hash_sample", f"""SELECT * FROM events WHERE {_U.format(x="CAST(event_id AS VARCHAR)")} < 0.2""")
def q_hash_sample(spark, sf):
    return relate.hash_sample(t(spark, sf, "events"), "event_id", 0.2)


@query("stratified_sample", f"""SELECT * FROM events WHERE {_U.format(x="CAST(event_id AS VARCHAR)")} <
  CASE event_type WHEN 'click' THEN 0.1 WHEN 'purchase' THEN 0.5 WHEN 'error' THEN 1.0 END""")
def q_stratified_sample(spark, sf):
    return relate.stratified_sample(t(spark, sf, "events"), "event_type",
                                    {"click": 0.1, "purchase": 0.5, "error": 1.0}, "event_id")


@query("sample", """SELECT true AS size_near_share, true AS all_from_input, true AS no_repeats, count(*) AS input_rows
FROM events""")
def q_sample(spark, sf):
    """A random tenth: its size within five standard deviations, rows of the input, none twice."""
    ev = t(spark, sf, "events")
    got = relate.sample(ev, 0.1, seed=7).select(F.col("event_id").alias("id"), F.struct(*ev.columns).alias("row"))
    whole = ev.select(F.col("event_id").alias("id"), F.struct(*ev.columns).alias("origin"))
    n = F.count(F.lit(1))
    j = whole.join(got, "id", "left").agg(
        (F.abs(F.count("row") - n * 0.1) <= 5 * F.sqrt(n * 0.09)).alias("size_near_share"),
        (F.count_if(F.col("row") == F.col("origin")) == F.count("row")).alias("all_from_input"),
        (n == F.count_distinct("id")).alias("no_repeats"), F.count_distinct("id").alias("input_rows"))
    return j


# =========================================================================== M18
@query("reconcile_cols", """SELECT * FROM lineitem WHERE (l_tax IS NULL) <> (l_discount IS NULL)
  OR (l_tax IS NOT NULL AND l_discount IS NOT NULL AND abs(l_tax - l_discount) > 0.02)""")
def q_reconcile_cols(spark, sf):
    return relate.reconcile_cols(t(spark, sf, "lineitem"), "l_tax", "l_discount", tol=0.02)


@query("reconcile", f"""WITH l AS (SELECT o_orderkey AS k, count(*) AS left_rows, min(o_totalprice) AS total_left
  FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, o_totalprice FROM orders)
  GROUP BY 1),
r AS (SELECT l_orderkey AS k, count(*) AS right_rows, min(t) AS total_right FROM (
  SELECT l_orderkey, {rnd('sum(l_extendedprice * (1 + l_tax) * (1 - l_discount))')} AS t FROM lineitem
  GROUP BY l_orderkey) GROUP BY 1)
SELECT coalesce(l.k, r.k) AS k, CASE WHEN left_rows IS NULL THEN 'right_only' WHEN right_rows IS NULL THEN 'left_only'
  WHEN left_rows > 1 OR right_rows > 1 THEN 'duplicate_key'
  WHEN coalesce(abs(total_left - total_right) <= 1000.0, false) THEN 'matched' ELSE 'changed' END AS status,
  CAST(coalesce(left_rows, 0) AS BIGINT) AS left_rows, CAST(coalesce(right_rows, 0) AS BIGINT) AS right_rows,
  total_left, total_right
FROM l FULL JOIN r ON l.k = r.k""")
def q_reconcile(spark, sf):
    key = F.when(F.col("o_orderstatus") == "P", -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    left = t(spark, sf, "orders").select(key.alias("k"), F.col("o_totalprice").alias("total"))
    li = t(spark, sf, "lineitem")
    right = li.groupBy(F.col("l_orderkey").alias("k")).agg(stable_round(F.sum(
        F.col("l_extendedprice") * (1 + F.col("l_tax")) * (1 - F.col("l_discount"))), 2).alias("total"))
    return relate.reconcile(left, right, ["k"], ["total"], tol=1000.0)


# =========================================================================== H1-H3
def _incoming(spark, sf):
    """A change batch derived from orders: open orders are closed (two versions each,
    the later one wins), and low-priority orders arrive again under new keys."""
    o = t(spark, sf, "orders")
    opened = o.filter(F.col("o_orderstatus") == "O")
    v1 = opened.withColumn("o_orderstatus", F.lit("X")).withColumn("ver", F.lit(1))
    v2 = opened.withColumn("o_orderstatus", F.lit("F")).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1.0).withColumn("ver", F.lit(2))
    new = o.filter(F.col("o_orderpriority") == "5-LOW").withColumn(
        "o_orderkey", F.col("o_orderkey") + 1_000_000_000).withColumn("ver", F.lit(1))
    return v1.unionByName(v2).unionByName(new)


@query("upsert", """WITH inc AS (
  SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 1 AS ver
    FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT o_orderkey, o_custkey, 'F', o_totalprice + 1.0, o_orderdate, o_orderpriority, 2
    FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 1
    FROM orders WHERE o_orderpriority = '5-LOW'),
latest AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ver DESC) AS rn FROM inc) WHERE rn = 1)
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM latest)
UNION ALL SELECT * FROM latest""")
def q_upsert(spark, sf):
    inc = _incoming(spark, sf)
    return tables.upsert(t(spark, sf, "orders"), inc, ["o_orderkey"], ["ver"])


@query("upsert_null_keys", """WITH old AS (SELECT CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey END AS k, o_orderpriority AS p,
  count(*) AS n FROM orders GROUP BY 1, 2),
inc AS (SELECT CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey + 1 END AS k, '1-URGENT' AS p, -count(*) AS n FROM orders GROUP BY 1)
SELECT * FROM inc UNION ALL SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM inc WHERE inc.k IS NOT DISTINCT FROM old.k
  AND inc.p = old.p)""")
def q_upsert_null_keys(spark, sf):
    """A null in a key is a value: the null row is replaced, and a second run changes nothing."""
    o = t(spark, sf, "orders")
    null_4th = lambda c: F.when(F.col("o_orderkey") % 4 != 0, c)
    old = o.groupBy(null_4th(F.col("o_custkey")).alias("k"), F.col("o_orderpriority").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    inc = o.groupBy(null_4th(F.col("o_custkey") + 1).alias("k")).agg((-F.count(F.lit(1))).alias("n")).select(
        "k", F.lit("1-URGENT").alias("p"), "n")
    once = tables.upsert(old, inc, ["k", "p"])
    return tables.upsert(once, inc, ["k", "p"])


@query("upsert_table", """WITH inc AS (SELECT o_orderkey, 'X' AS o_orderstatus FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT o_orderkey + 1000000000, 'N' FROM orders WHERE o_orderpriority = '5-LOW')
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM inc)
UNION ALL SELECT * FROM inc UNION ALL SELECT -1, 'A'""")
def q_upsert_table(spark, sf):
    """The catalog path: a database at a scratch location, first load, the same upsert twice into a
    bucketed table, an append with the columns in another order, and the table read back."""
    db = tables.ensure_database(spark, f"kempt_{scratch_dir(spark, 'db').rsplit('-', 1)[-1]}", scratch_dir(spark, "database"))
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    inc = (o.filter("o_orderstatus = 'O'").withColumn("o_orderstatus", F.lit("X"))
           .unionByName(t(spark, sf, "orders").filter("o_orderpriority = '5-LOW'")
                        .select((F.col("o_orderkey") + 1_000_000_000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"))))
    tables.upsert_table(spark, "orders_now", o, ["o_orderkey"], database=db, buckets=4)
    for _ in range(2):
        tables.upsert_table(spark, "orders_now", inc, ["o_orderkey"], database=db, buckets=4)
    more = o.agg(F.lit("A").alias("o_orderstatus"), (F.count(F.lit(1)) * 0 - 1).cast("bigint").alias("o_orderkey"))
    tables.append_table(more, "orders_now", db)
    return spark.table(f"{db}.orders_now")


@query("upsert_twice", """SELECT o_orderstatus, count(*) AS n FROM (
  SELECT CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus FROM orders
  UNION ALL SELECT o_orderstatus FROM orders WHERE o_orderpriority = '5-LOW') GROUP BY 1""")
def q_upsert_twice(spark, sf):
    inc = _incoming(spark, sf)
    once = tables.upsert(t(spark, sf, "orders"), inc, ["o_orderkey"], ["ver"])
    twice = tables.upsert(once, inc, ["o_orderkey"], ["ver"])
    return twice.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


# =========================================================================== H4 K2
@query("build_marts", W("""SELECT regexp_replace(lower(trim(region_txt)), '[^0-9a-z]+', '', 'g') AS mart,
  count(*) AS rows, CAST(count(DISTINCT id) AS BIGINT) AS orders FROM dirty_orders GROUP BY 1"""))
def q_build_marts(spark, sf):
    path = scratch_dir(spark, "marts")
    marts = tables.build_marts(dirty_orders(spark, sf), "region_txt", path)
    return marts["*"].groupBy("mart").agg(F.count(F.lit(1)).alias("rows"),
                                          F.count_distinct("id").cast("bigint").alias("orders"))


@query("marts_rerun", W("""SELECT regexp_replace(lower(trim(status)), '[^0-9a-z]+', '', 'g') AS mart, count(*) AS rows
FROM dirty_orders WHERE regexp_replace(lower(trim(status)), '[^0-9a-z]+', '', 'g') IN ('f', 'p') GROUP BY 1"""))
def q_marts_rerun(spark, sf):
    """A second run with fewer marts leaves nothing of the first."""
    path = scratch_dir(spark, "marts")
    tables.build_marts(dirty_orders(spark, sf), "status", path)
    tables.build_marts(dirty_orders(spark, sf), "status", path, values=["F", "P"])
    return tables.build_marts(dirty_orders(spark, sf), "status", path, values=["F", "P"])["datamart_f"].sparkSession.read.parquet(
        path).groupBy("mart").agg(F.count(F.lit(1)).alias("rows"))


@query("marts_empty", """SELECT 'datamart_nowhere' AS mart, 0 AS rows, count(*) AS input_rows FROM orders""")
def q_marts_empty(spark, sf):
    """A mart that no row belongs to is an empty frame with the mart's columns."""
    o = t(spark, sf, "orders")
    marts = tables.build_marts(o, "o_orderpriority", scratch_dir(spark, "marts"), values=["Nowhere"])
    (name, mart), = marts.items()
    rows = mart.agg(F.lit(name).alias("mart"), F.count("o_orderkey").cast("int").alias("rows"), F.lit(1).alias("one"))
    return rows.join(o.agg(F.lit(1).alias("one"), F.count(F.lit(1)).alias("input_rows")), "one").drop("one")


@query("version_schema_change", """SELECT '1' AS version, o_orderkey, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders
UNION ALL SELECT '02', o_orderkey, o_orderpriority FROM orders""")
def q_version_schema_change(spark, sf):
    """A later version has a column more; version names that look like numbers stay text."""
    base = scratch_dir(spark, "versions")
    o = t(spark, sf, "orders")
    tables.save_version(o.select("o_orderkey"), base, "1")
    tables.save_version(o.select("o_orderkey", "o_orderpriority"), base, "02")
    return tables.read_version(spark, base).select("version", "o_orderkey", "o_orderpriority")


@query("version_columns", """SELECT o_orderkey, o_orderpriority FROM orders""")
def q_version_columns(spark, sf):
    """One version has its own columns."""
    base = scratch_dir(spark, "versions")
    o = t(spark, sf, "orders")
    tables.save_version(o.select("o_orderkey"), base, "v1")
    tables.save_version(o.select("o_orderkey", "o_orderpriority"), base, "v2")
    return tables.read_version(spark, base, "v2")


@query("build_marts_named", W("""SELECT 'datamart_north_east' AS mart, count(*) AS rows FROM dirty_orders
WHERE region_txt = 'NORTH-EAST'"""))
def q_build_marts_named(spark, sf):
    path = scratch_dir(spark, "marts")
    marts = tables.build_marts(dirty_orders(spark, sf), "region_txt", path, values=["North-East"])
    out = None
    for name, d in marts.items():
        a = d.agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("rows"))
        out = a if out is None else out.unionByName(a)
    return out


@query("save_version", f"""SELECT 'v1' AS version, count(*) AS rows, {rnd('sum(o_totalprice)')} AS total FROM orders
UNION ALL SELECT 'v2', count(*), {rnd('sum(' + rnd_text('o_totalprice * 0.012') + ')')} FROM orders""")
def q_save_version(spark, sf):
    base = scratch_dir(spark, "versions")
    o = t(spark, sf, "orders")
    tables.save_version(o, base, "v1")
    tables.save_version(cleanse.convert_unit(o, "o_totalprice", 0.012), base, "v2")
    # saving a version again (as a retried job would) replaces that version only
    tables.save_version(o, base, "v2")
    tables.save_version(cleanse.convert_unit(o, "o_totalprice", 0.012), base, "v2")
    v = tables.read_version(spark, base)
    return v.groupBy("version").agg(F.count(F.lit(1)).alias("rows"),
                                    stable_round(F.sum("o_totalprice"), 2).alias("total"))


# =========================================================================== S1 S2 S6 K1
_DO_SCHEMA = ("id bigint, custkey bigint, amount double, priority string, status string, "
              "year_txt string, region_txt string")


@query("read_csv_options", W("SELECT * FROM dirty_orders"))
def q_read_csv_options(spark, sf):
    path = scratch_dir(spark, "csv")
    files.write_table(dirty_orders(spark, sf), path, "csv", mode="overwrite",
                      options={"header": "true", "nullValue": "NA", "emptyValue": '""',
                               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    return files.read_table(spark, path, "csv", schema=_DO_SCHEMA, header=True, null_value="NA")


@query("read_csv_inferred", """SELECT o_orderkey AS o_orderkey, o_totalprice, o_orderstatus, o_orderdate FROM orders""")
def q_read_csv_inferred(spark, sf):
    """Types guessed from the text, as the reference reads its CSV."""
    path = scratch_dir(spark, "csv")
    o = t(spark, sf, "orders").select((F.col("o_orderkey") + 5_000_000_000).alias("o_orderkey"), "o_totalprice", "o_orderstatus",
                                      F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"))
    files.write_table(o, path, "csv", mode="overwrite", options={"header": "true"})
    got = files.read_table(spark, path, "csv", infer_schema=True)
    return got.select((F.col("o_orderkey") - 5_000_000_000).alias("o_orderkey"), "o_totalprice", "o_orderstatus",
                      F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))


@query("write_parquet_stage", """SELECT o_orderpriority, count(*) AS rows FROM orders GROUP BY 1""")
def q_write_parquet_stage(spark, sf):
    """A stage's output saved twice as partitioned Parquet; the second run replaces the first."""
    path = scratch_dir(spark, "stage")
    o = t(spark, sf, "orders")
    files.write_table(o.withColumn("o_orderpriority", F.lit("old")), path, partition_by=["o_orderpriority"])
    files.write_table(o, path, mode="overwrite", partition_by=["o_orderpriority"])
    return files.read_table(spark, path).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("rows"))


@query("file_stats", """SELECT 4 AS files, count(*) AS rows, true AS sizes_positive FROM lineitem""")
def q_file_stats(spark, sf):
    """Four files of lineitem. A file has one writer, so a task has to read a quarter of the table: it
    reads it as compressed columns that many tasks have laid out, not as shuffled rows."""
    path, staged = scratch_dir(spark, "files"), scratch_dir(spark, "quarters")
    rows = t(spark, sf, "lineitem")
    dealt = rows.withColumn("quarter", F.pmod(F.monotonically_increasing_id(), F.lit(4)).cast("int"))
    files.write_table(dealt, staged, partition_by=["quarter"], options={"compression": "zstd"})
    laid = files.read_table(spark, staged, schema=dealt.schema)
    quarters = laid.filter(F.col("quarter") > 3)  # none; without this part, Spark makes a union of parts of one task one task
    for i in range(4):
        quarters = quarters.union(laid.filter(F.col("quarter") == i).coalesce(1))
    quarters.drop("quarter").write.mode("overwrite").parquet(path)
    return files.file_stats(spark, path).agg(F.count(F.lit(1)).cast("int").alias("files"), F.sum("rows").alias("rows"),
                                             (F.min("size_kb") > 0).alias("sizes_positive"))


# =========================================================================== ST1
_EV_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
_STREAM_STEPS = [
    {"op": "upper_strings", "params": {"cols": ["event_type"]}},
    {"op": "json_fields", "params": {"column": "props", "paths": {"k": "$.k"}}},
    {"op": "round_cols", "params": {"cols": ["value"], "scale": 1}},
]


@query("ingest_stream", f"""SELECT event_id, ts, user_id, upper(event_type) AS event_type,
  {rnd_text('value', 1)} AS value, props, json_extract_string(props, '$.k') AS k FROM events""")
def q_ingest_stream(spark, sf):
    from kempt.streaming.ingest import ingest_stream
    src = scratch_dir(spark, "stream-src")
    sink = scratch_dir(spark, "stream-sink")
    ckpt = scratch_dir(spark, "stream-ckpt")
    ev = t(spark, sf, "events")
    # two arrivals: the second file set lands after the first run
    ev.filter(F.col("event_type") != "view").write.mode("overwrite").parquet(f"{src}/part1")
    ingest_stream(spark, f"{src}/part1", sink, ckpt, _EV_SCHEMA, steps=_STREAM_STEPS, max_files_per_trigger=2)
    ev.filter(F.col("event_type") == "view").write.mode("append").parquet(f"{src}/part1")
    ingest_stream(spark, f"{src}/part1", sink, ckpt, _EV_SCHEMA, steps=_STREAM_STEPS, max_files_per_trigger=2)
    return spark.read.parquet(sink).drop("stream", "batch")


# =========================================================================== running profile, matching, discovery
_EV_COLS = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}


def _running_sql() -> str:
    parts = []
    for i, (n, ty) in enumerate(_EV_COLS.items()):
        number = ty in ("bigint", "double")
        parts.append(f"""SELECT '{n}' AS "column", {i} AS position, '{ty}' AS type, count(*) AS rows, count(*) - count({n}) AS nulls,
  CAST(min({n}) AS VARCHAR) AS min, CAST(max({n}) AS VARCHAR) AS max, {rnd(f'avg({n})', 4) if number else 'CAST(NULL AS DOUBLE)'} AS mean,
  {rnd(f'stddev_samp({n})', 4) if number else 'CAST(NULL AS DOUBLE)'} AS stddev, true AS distinct_close, true AS median_close FROM events""")
    return "\nUNION ALL\n".join(parts)


@query("running_profile", _running_sql())
def q_running_profile(spark, sf):
    """Events that arrive in four batches, one of which is processed twice; estimates against exact figures
    (distinct within 3 %, the median's rank within 0.01 of a half; equal values share their ranks)."""
    from kempt.streaming.running import running_profile, store_summary
    path, ev = scratch_dir(spark, "running"), t(spark, sf, "events")
    batch = F.pmod(F.xxhash64("event_id"), F.lit(4))
    store_summary(ev, path, 3)  # a batch that is replaced below, as by a replay after a failure
    for b in range(4):
        store_summary(ev.filter(batch == b), path, b)
    got = materialize(running_profile(spark, path), "running-profile")
    exact = quality.distinct_counts(ev).withColumnRenamed("distinct", "exact")
    medians = {r["column"]: r["median"] for r in got.filter("median IS NOT NULL").collect()}  # one number a column
    ranks = ev.agg(*[F.struct(F.avg((F.col(c) < F.lit(m)).cast("double")).alias("first"),
                              F.avg((F.col(c) <= F.lit(m)).cast("double")).alias("last")).alias(c) for c, m in medians.items()])
    share = ranks.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("share")) for c in medians])))
    j = got.join(F.broadcast(exact), "column").join(F.broadcast(share), "column", "left")
    return j.select("column", "position", "type", "rows", "nulls", "min", "max", stable_round(F.col("mean"), 4).alias("mean"),
                    stable_round(F.col("stddev"), 4).alias("stddev"),
                    (F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.03 * F.col("exact"))).alias("distinct_close"),
                    F.coalesce((F.col("share.first") <= 0.51) & (F.col("share.last") >= 0.49), F.lit(True)).alias("median_close"))


_TOKENS = r"list_sort(list_distinct(list_filter(string_split_regex(lower({x}), '[^\p{{L}}\p{{N}}]+'), lambda p: p <> '')))"


@query("match_similar", rf"""WITH a AS (SELECT c_custkey, concat_ws(' ', c_mktsegment || ',', 'Street No.', CAST(c_custkey % 97 AS VARCHAR), n_name, r_name) AS address
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
g AS (SELECT {_TOKENS.format(x="text")} AS s, min(text) AS text FROM
  (SELECT concat_ws(' ', CAST(c_custkey % 89 AS VARCHAR), lower(c_mktsegment), 'street', n_name, 'in', r_name) AS text
   FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) GROUP BY 1),
l AS (SELECT DISTINCT {_TOKENS.format(x="address")} AS s FROM a),
lt AS (SELECT s, unnest(s) AS token FROM l), gt AS (SELECT s, unnest(s) AS token FROM g),
p AS (SELECT lt.s AS l, gt.s AS g, count(*) AS n FROM lt JOIN gt USING (token) GROUP BY 1, 2),
b AS (SELECT p.l, text, n / (len(p.l) + len(p.g) - n) AS similarity,
  row_number() OVER (PARTITION BY p.l ORDER BY n / (len(p.l) + len(p.g) - n) DESC, text) AS nth
  FROM p JOIN g ON p.g = g.s WHERE n / (len(p.l) + len(p.g) - n) >= 0.75)
SELECT c_custkey, address, b.text AS match_text, similarity AS match_similarity FROM a LEFT JOIN b ON {_TOKENS.format(x="address")} = b.l AND nth = 1""")
def q_match_similar(spark, sf):
    """Customers' addresses against a register that writes them otherwise, by their words."""
    from kempt.operators.similar import match_similar
    c = (t(spark, sf, "customer").join(t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
         .join(t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    number = lambda m: (F.col("c_custkey") % m).cast("string")
    a = c.select("c_custkey", F.concat_ws(" ", F.concat("c_mktsegment", F.lit(",")), F.lit("Street No."), number(97), "n_name", "r_name").alias("address"))
    register = c.select(F.concat_ws(" ", number(89), F.lower("c_mktsegment"), F.lit("street"), "n_name", F.lit("in"), "r_name").alias("text"))
    return match_similar(a, "address", register, "text", 0.75)


_REL_COLS = {
    "region": {"r_regionkey": "i", "r_name": "t"},
    "nation": {"n_nationkey": "i", "n_name": "t", "n_regionkey": "i"},
    "customer": {"c_custkey": "i", "c_name": "t", "c_nationkey": "i", "c_acctbal": "d", "c_mktsegment": "t"},
    "supplier": {"s_suppkey": "i", "s_name": "t", "s_nationkey": "i", "s_acctbal": "d"},
    "part": {"p_partkey": "i", "p_name": "t", "p_brand": "t", "p_type": "t", "p_size": "i", "p_retailprice": "d"},
    "orders": {"o_orderkey": "i", "o_custkey": "i", "o_orderstatus": "t", "o_totalprice": "d", "o_orderdate": "ts", "o_orderpriority": "t"},
    "events": {"event_id": "i", "ts": "ts", "user_id": "i", "event_type": "t", "value": "d", "props": "t"},
}


def _inclusions_sql() -> str:
    cols = [(tab, c, k) for tab, cs in _REL_COLS.items() for c, k in cs.items()]
    values = " UNION ALL ".join(f"SELECT DISTINCT '{tab}.{c}' AS c, '{k}' AS k, CAST({c} AS VARCHAR) AS v FROM {tab} WHERE {c} IS NOT NULL" for tab, c, k in cols)
    facts = " UNION ALL ".join(f"SELECT '{tab}.{c}' AS c, count(DISTINCT {c}) AS n, count({c}) = count(DISTINCT {c}) AS u FROM {tab}" for tab, c, _ in cols)
    return f"""WITH u AS MATERIALIZED ({values}), f AS MATERIALIZED ({facts}),
s AS (SELECT a.c AS d, b.c AS r, count(*) AS shared FROM u a JOIN u b ON a.k = b.k AND a.v = b.v AND a.c <> b.c GROUP BY 1, 2)
SELECT d AS dependent, r AS referenced, x.n AS distinct_values, shared AS shared_values, shared / x.n AS share, y.u AS referenced_unique
FROM s JOIN f x ON x.c = d JOIN f y ON y.c = r WHERE shared / x.n >= 0.5"""


@query("inclusions", _inclusions_sql())
def q_inclusions(spark, sf):
    """All pairs of columns of seven tables of which one has at least half of its values in the other."""
    from kempt.operators.discover import inclusions
    return inclusions({n: t(spark, sf, n) for n in _REL_COLS}, 0.5)


@query("k_anonymous", """SELECT count(*) AS rows, CAST(sum(c_custkey) AS BIGINT) AS keys, true AS at_least_k, true AS inside_ranges, true AS ids_are_groups,
  count(DISTINCT c_mktsegment) AS segments FROM customer""")
def q_k_anonymous(spark, sf):
    """Customers released in groups of 25 or more alike in nation, segment and balance: what must hold of
    them (the groups themselves are tested against cuts made one at a time)."""
    from kempt.operators.anonymize import k_anonymous
    c = t(spark, sf, "customer")
    quasi = ["c_nationkey", "c_mktsegment", "c_acctbal"]
    got = materialize(k_anonymous(c, quasi, 25), "released")
    sizes = got.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"), F.min("group_rows").alias("lo"), F.max("group_rows").alias("hi"))
    groups = sizes.agg(F.min("n").alias("least"), F.bool_and((F.col("n") == F.col("lo")) & (F.col("n") == F.col("hi"))).alias("ids")).first()
    own = got.join(c.select(F.col("c_custkey"), *quasi).hint("merge"), "c_custkey")
    inside = F.lit(True)
    for q in quasi:
        inside = inside & F.when(F.col(q).isNull(), F.col(f"{q}_null")).otherwise(F.col(q).between(F.col(f"{q}_low"), F.col(f"{q}_high")))
    return own.agg(F.count(F.lit(1)).alias("rows"), F.sum("c_custkey").alias("keys"), F.lit(groups["least"] >= 25).alias("at_least_k"),
                   F.bool_and(inside).alias("inside_ranges"), F.lit(groups["ids"]).alias("ids_are_groups"), F.count_distinct("c_mktsegment").alias("segments"))


_QUANTILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_SHARES = [0.01, 0.25, 0.5, 0.75, 0.99]


@query("exact_quantiles", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", unnest(CAST({_SHARES} AS DOUBLE[])) AS share, unnest(list_transform(quantile_cont(CAST({c} AS DOUBLE), {_SHARES}),
  lambda v: {rnd('v', 4)})) AS value FROM lineitem""" for c in _QUANTILE_COLS))
def q_exact_quantiles(spark, sf):
    """Five exact quantiles of eight columns of the line items, all in one search."""
    from kempt.operators.quantiles import exact_quantiles
    got = exact_quantiles(t(spark, sf, "lineitem"), {c: _SHARES for c in _QUANTILE_COLS})
    rows = [(c, s, v) for c, vs in got.items() for s, v in zip(_SHARES, vs, strict=True)]
    return spark.createDataFrame(rows, "column string, share double, value double").withColumn("value", stable_round(F.col("value"), 4))


@query("equal_frequency", """WITH e AS (SELECT quantile_cont(CAST(o_totalprice AS DOUBLE), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS p,
  quantile_cont(CAST(o_custkey AS DOUBLE), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS c FROM orders)
SELECT o_orderkey, o_custkey, o_totalprice, CAST(len(list_filter(list_distinct(p), lambda x: x <= o_totalprice)) + 1 AS INTEGER) AS o_totalprice_bin,
  CAST(len(list_filter(list_distinct(c), lambda x: x <= o_custkey)) + 1 AS INTEGER) AS o_custkey_bin FROM orders, e""")
def q_equal_frequency(spark, sf):
    """Orders in tenths of their prices and customers."""
    from kempt.operators.quantiles import equal_frequency
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return equal_frequency(o, ["o_totalprice", "o_custkey"], 10)


# =========================================================================== PL1
PIPELINE_JSON = json.dumps([
    {"op": "dedupe"},
    {"op": "blank_to_null", "params": {"trim": True}},
    {"op": "trim_strings"},
    {"op": "map_values", "params": {"mapping": {"status": {"Fx": "F", "o": "O", "f": "F", "p": "P"}}}},
    {"op": "upper_strings", "params": {"cols": ["region_txt"]}},
    {"op": "strip_special", "params": {"cols": ["region_txt"]}},
    {"op": "impute", "params": {"spec": {"priority": "UNKNOWN"}}},
    {"op": "cast_cols", "params": {"types": {"year_txt": "int"}}},
    {"op": "hash_cols", "params": {"cols": ["custkey"]}},
    {"op": "round_cols", "params": {"cols": ["amount"], "scale": 0}},
    {"op": "sort_by", "params": {"keys": ["id"]}, "enabled": False},
])


@query("run_pipeline", W(f"""SELECT DISTINCT id, sha256(CAST(custkey AS VARCHAR)) AS custkey,
  {rnd_text('amount', 0)} AS amount,
  coalesce(trim(CASE WHEN trim(priority) = '' THEN NULL ELSE priority END), 'UNKNOWN') AS priority,
  CASE trim(status) WHEN 'Fx' THEN 'F' WHEN 'o' THEN 'O' WHEN 'f' THEN 'F' WHEN 'p' THEN 'P' ELSE trim(status) END
    AS status,
  TRY_CAST(trim(year_txt) AS INTEGER) AS year_txt,
  regexp_replace(upper(trim(region_txt)), '[^a-zA-Z0-9.\\t\\n\\x0B\\f\\r ]', '', 'g') AS region_txt
FROM dirty_orders"""))
def q_run_pipeline(spark, sf):
    return run_pipeline(dirty_orders(spark, sf), PIPELINE_JSON)


# =========================================================================== partial upserts, differences, quarantine, restart
_BATCH = "o_orderdate = (SELECT max(o_orderdate) FROM orders)"


def _last_day(spark, sf) -> DataFrame:
    """A batch as it arrives: the orders of the last day."""
    o = t(spark, sf, "orders")
    return o.join(o.agg(F.max("o_orderdate").alias("last")), F.col("o_orderdate") == F.col("last"), "left_semi")


@query("upsert_partitions", f"""WITH inc AS (SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice FROM orders WHERE {_BATCH}
  UNION ALL SELECT o_orderkey + 1000000000, 'N', o_totalprice FROM orders WHERE {_BATCH})
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM inc)
UNION ALL SELECT * FROM inc""")
def q_upsert_partitions(spark, sf):
    """The last day's orders change and arrive again under new keys, twice; only their partitions are rewritten."""
    from kempt.sources.partial import read_keyed, upsert_partitions
    path = scratch_dir(spark, "keyed")
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    upsert_partitions(spark, path, t(spark, sf, "orders").select(cols), ["o_orderkey"], parts=64)
    day = _last_day(spark, sf).select(cols)
    inc = day.withColumn("o_orderstatus", F.lit("X")).unionByName(
        day.withColumns({"o_orderkey": F.col("o_orderkey") + 1_000_000_000, "o_orderstatus": F.lit("N")}))
    for _ in range(2):
        upsert_partitions(spark, path, inc, ["o_orderkey"])
    return read_keyed(spark, path)


@query("diff_versions", f"""WITH d AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE {_BATCH}),
r AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice FROM d WHERE o_orderstatus <> 'F'
  UNION ALL SELECT o_orderkey + 1000000000, NULL, o_totalprice FROM d)
SELECT coalesce(d.o_orderkey, r.o_orderkey) AS o_orderkey,
  CASE WHEN d.o_orderkey IS NULL THEN 'right_only' WHEN r.o_orderkey IS NULL THEN 'left_only' ELSE 'changed' END AS status,
  CAST(count(d.o_orderkey) AS BIGINT) AS left_rows, CAST(count(r.o_orderkey) AS BIGINT) AS right_rows,
  min(d.o_orderstatus) AS o_orderstatus_left, min(r.o_orderstatus) AS o_orderstatus_right,
  min(d.o_totalprice) AS o_totalprice_left, min(r.o_totalprice) AS o_totalprice_right
FROM d FULL JOIN r ON d.o_orderkey = r.o_orderkey
WHERE d.o_orderkey IS NULL OR r.o_orderkey IS NULL OR d.o_totalprice <> r.o_totalprice GROUP BY d.o_orderkey, r.o_orderkey""")
def q_diff_versions(spark, sf):
    """All orders against a version in which the last day's were closed out, repriced and repeated under new keys."""
    from kempt.operators.versions import diff_versions
    o = t(spark, sf, "orders")
    day = _last_day(spark, sf)
    rest = o.join(day.select("o_orderkey"), "o_orderkey", "left_anti")
    price = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice"))
    later = rest.unionByName(day.filter("o_orderstatus <> 'F'").withColumn("o_totalprice", price)).unionByName(
        day.withColumns({"o_orderkey": F.col("o_orderkey") + 1_000_000_000, "o_orderstatus": F.lit(None).cast("string")}))
    return diff_versions(o, later, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


@query("read_quarantined", W("""c AS (SELECT id, CASE WHEN id % 7 = 0 THEN NULL ELSE custkey END AS custkey, year_txt FROM dirty_orders)
SELECT id, custkey, CAST(year_txt AS INTEGER) AS year, 'good' AS kind, CAST(NULL AS VARCHAR) AS record FROM c
WHERE custkey IS NOT NULL AND TRY_CAST(year_txt AS INTEGER) IS NOT NULL
UNION ALL SELECT NULL, NULL, NULL, CASE WHEN TRY_CAST(year_txt AS INTEGER) IS NULL THEN 'malformed' ELSE 'missing custkey' END,
  CASE WHEN TRY_CAST(year_txt AS INTEGER) IS NULL THEN concat(id, ',', coalesce(CAST(custkey AS VARCHAR), ''), ',', year_txt)
       ELSE concat('{"id":', id, ',"year":', year_txt, '}') END
FROM c WHERE custkey IS NULL OR TRY_CAST(year_txt AS INTEGER) IS NULL"""))
def q_read_quarantined(spark, sf):
    """dirty_orders written as CSV with years that are none and customers that are missing, read back in two parts."""
    from kempt.sources.quarantine import read_quarantined
    path = scratch_dir(spark, "csv")
    custkey = F.when(F.col("id") % 7 != 0, F.col("custkey"))
    files.write_table(dirty_orders(spark, sf).select("id", custkey.alias("custkey"), "year_txt"), path, "csv")
    good, bad = read_quarantined(spark, path, "id bigint, custkey bigint, year int", header=False, required=["custkey"])
    null = lambda ty: F.lit(None).cast(ty)
    return good.select("*", F.lit("good").alias("kind"), null("string").alias("record")).unionByName(
        bad.select(null("bigint").alias("id"), null("bigint").alias("custkey"), null("int").alias("year"), F.col("reason").alias("kind"), "record"))


@query("suggest_from", """WITH w AS (SELECT DISTINCT concat(p_brand, ' ', p_type) AS word FROM part),
v AS (SELECT DISTINCT regexp_replace(lower(word), '[aeiou]([a-z]*)$', '\\1') AS value FROM w UNION SELECT word FROM w),
c AS (SELECT value, word, levenshtein(upper(value), upper(word)) AS d FROM v, w),
b AS (SELECT *, row_number() OVER (PARTITION BY value ORDER BY d, word) AS rn FROM c WHERE d <= 2 AND value NOT IN (SELECT word FROM w))
SELECT v.value, b.word AS value_suggestion, CAST(b.d AS INTEGER) AS value_distance FROM v LEFT JOIN b ON v.value = b.value AND rn = 1""")
def q_suggest_from(spark, sf):
    """Product names without their last vowel, in lower case, against all names of the parts table."""
    words = t(spark, sf, "part").select(F.concat_ws(" ", "p_brand", "p_type").alias("word")).distinct()
    spelled = F.regexp_replace(F.lower("word"), "[aeiou]([a-z]*)$", "$1")
    values = words.select(spelled.alias("value")).unionByName(words.select(F.col("word").alias("value"))).distinct()
    return quality.suggest_from(values, "value", words, "word")


@query("sample_per_stratum", f"""SELECT event_id, event_type, value, 'plain' AS kind FROM (SELECT *, row_number() OVER (
  PARTITION BY event_type ORDER BY {_U.format(x="CAST(event_id AS VARCHAR)")}, event_id) AS nth FROM events) WHERE nth <= 100
UNION ALL SELECT event_id, event_type, value, 'weighted' FROM (SELECT *, row_number() OVER (
  PARTITION BY event_type ORDER BY -ln(1 - {_U.format(x="concat('w', CAST(event_id AS VARCHAR))")}) / value, event_id) AS nth FROM events WHERE value > 0) WHERE nth <= 100""")
def q_sample_per_stratum(spark, sf):
    """A hundred events of each type, and a hundred drawn by their values."""
    ev = t(spark, sf, "events")
    cols = ["event_id", "event_type", "value"]
    return relate.sample_per_stratum(ev, "event_type", 100, "event_id").select(*cols, F.lit("plain").alias("kind")).unionByName(
        relate.sample_per_stratum(ev, "event_type", 100, "event_id", "value", salt="w").select(*cols, F.lit("weighted").alias("kind")))


@query("transpose_blocks", """WITH p AS (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS nth FROM part),
u AS (SELECT nth // 256 AS block, nth, p_partkey, unnest(['p_brand', 'p_size']) AS "column", unnest([p_brand, CAST(p_size AS VARCHAR)]) AS v FROM p)
SELECT "column", CAST(block AS BIGINT) AS block, min(p_partkey) AS first_key, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY nth) AS keys,
  string_agg(v, ',' ORDER BY nth) AS "values" FROM u GROUP BY 1, 2""")
def q_transpose_blocks(spark, sf):
    """The whole parts table turned over, 256 rows to a block."""
    out = relate.transpose_blocks(t(spark, sf, "part").select("p_partkey", "p_brand", "p_size"), "p_partkey", 256)
    return out.withColumns({"keys": F.array_join("keys", ","), "values": F.array_join("values", ",")})


@query("pivot_map", """WITH c AS (SELECT c_nationkey, o_orderdate, sum(o_totalprice) AS v, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT c_nationkey, CAST(o_orderdate AS DATE) AS day, CAST(ROUND(CAST(v AS DECIMAL(38,6)), 2) AS DOUBLE) AS total FROM c""")
def q_pivot_map(spark, sf):
    """Order totals by nation and day, the days as cells: far more than a pivot's columns may be."""
    o = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    cells = relate.pivot_map(o, "c_nationkey", "o_orderdate", "o_totalprice", cells=500).select("c_nationkey", F.explode("cells").alias("c"))
    return cells.select("c_nationkey", F.col("c.column").cast("date").alias("day"), stable_round(F.col("c.value")).alias("total"))


_ODD = ("CASE WHEN o_orderkey % 5 = 0 THEN CAST('NaN' AS DOUBLE) WHEN o_orderkey % 101 = 0 THEN CAST('Infinity' AS DOUBLE) "
        "WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END")


@query("fits_of_odd_values", f"""WITH b AS (SELECT o_orderkey AS k, {_ODD} AS x FROM orders),
s AS (SELECT avg(x) AS m, stddev_samp(x) AS sd, min(x) AS lo, max(x) AS hi FROM b WHERE isfinite(x))
SELECT k, CASE WHEN isnan(x) THEN x ELSE {rnd("CASE WHEN x > m + 2 * sd THEN m + 2 * sd WHEN x < m - 2 * sd THEN m - 2 * sd ELSE x END")} END AS clamped,
  CASE WHEN isfinite(x) THEN CAST(ROUND(CAST((x - m) / sd AS DECIMAL(38,9)), 6) AS DOUBLE) ELSE x END AS z,
  CASE WHEN isfinite(x) THEN CAST(ROUND(CAST((x - lo) / (hi - lo) AS DECIMAL(38,9)), 6) AS DOUBLE) ELSE x END AS scaled,
  CASE WHEN isfinite(coalesce(x, m)) THEN {rnd("coalesce(x, m)")} ELSE x END AS filled
FROM (SELECT k, CASE WHEN x IS NULL THEN NULL ELSE x END AS x, m, sd, lo, hi FROM b, s)""")
def q_fits_of_odd_values(spark, sf):
    """Clamping, scaling and filling a column with NaN, infinities and nulls."""
    b = t(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.expr(_ODD).alias("x"))

    def rounded(c: str, scale: int, wide: str) -> Column:
        whole = ~F.isnan(c) & (F.abs(F.col(c)) < F.lit(float("inf")))
        return F.when(whole, F.round(F.when(whole, F.col(c)).cast(wide), scale).cast("double")).otherwise(F.col(c))

    x = b.withColumns({"clamped": F.col("x"), "z": F.col("x"), "scaled": F.col("x"), "filled": F.col("x")}).drop("x")
    x = stats.impute(stats.min_max(stats.standardize(stats.winsorize(x, ["clamped"], 2.0), ["z"]), ["scaled"], suffix=""), {"filled": "mean"})
    return x.select("k", rounded("clamped", 2, "decimal(38,6)").alias("clamped"), rounded("z", 6, "decimal(38,9)").alias("z"),
                    rounded("scaled", 6, "decimal(38,9)").alias("scaled"), rounded("filled", 2, "decimal(38,6)").alias("filled"))


@query("reconcile_odd_keys", f"""WITH l AS (SELECT CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderkey END AS k, max({_ODD}) AS x, count(*) AS n FROM orders GROUP BY 1),
r AS (SELECT k, CASE WHEN k % 3 = 0 THEN x + 1 ELSE x END AS x FROM l WHERE k IS NULL OR k % 11 <> 0)
SELECT l.k, CASE WHEN r.gone THEN 'left_only' WHEN l.x IS NOT DISTINCT FROM r.x THEN 'matched' ELSE 'changed' END AS status
FROM l LEFT JOIN (SELECT *, false AS there FROM r) r0 ON l.k IS NOT DISTINCT FROM r0.k
  , LATERAL (SELECT r0.there IS NULL AS gone, r0.x AS x) r""")
def q_reconcile_odd_keys(spark, sf):
    """A null key and values that are NaN, infinite or null, against a version with fewer and changed rows."""
    key = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderkey"))
    left = t(spark, sf, "orders").select(key.alias("k"), F.expr(_ODD).alias("x")).groupBy("k").agg(F.max("x").alias("x"))
    left = materialize(left, "left")  # both versions come from it: grouped once, in tasks that hold nothing else
    right = left.filter("k IS NULL OR k % 11 <> 0").withColumn("x", F.when(F.col("k") % 3 == 0, F.col("x") + 1).otherwise(F.col("x")))
    return relate.reconcile(left, right, ["k"], ["x"]).select("k", "status")


@query("run_stages", ORACLE["run_pipeline"])
def q_run_stages(spark, sf):
    """The same pipeline in three stages: a first run ends after one of them, a second one resumes there."""
    from kempt.plans.ledger import files_id, run_stages
    steps, ledger = json.loads(PIPELINE_JSON), scratch_dir(spark, "ledger")
    cut = len(steps) // 3
    stages = [("clean", steps[:cut]), ("shape", steps[cut:2 * cut]), ("finish", steps[2 * cut:])]
    source = files_id(spark, f"{sf}/orders.parquet")
    run_stages(dirty_orders(spark, sf), stages[:1], ledger, source)
    return run_stages(dirty_orders(spark, sf), stages, ledger, source)


# =========================================================================== PL1 from a configuration file
# A configuration in the loan-ETL JSON format, pointed at dirty_orders' columns.
DIRTY_CONFIG = {
    "cleansing_config": {
        "remove_duplicates": True, "handle_missing_values": True, "standardize_data": False,
        "correct_typos_and_inaccuracies": True, "handle_outliers": True, "handle_inconsistent_data": True,
        "handle_incomplete_records": True, "convert_data_types": True, "standardize_categorical_data": True,
        "validate_data": True, "handle_encoding_issues": True, "deal_with_inconsistent_units": True,
        "validate_references_and_foreign_keys": False, "handle_special_characters_and_symbols": True,
        "conform_to_data_privacy_regulations": True,
    },
    "massaging": {"data_formatting": True, "data_deduplication": True, "data_imputation": True},
    "transforming": {"data_filtering": True, "data_redundancy_removal": True, "data_duplication": True},
    "typing_error_inaccuracies": {"status": {"Fx": "F"}},
    "columns_to_winsorize": ["amount"], "threshold": 3,
    "inconsistant_column": ["amount"],
    "null_threshold": 6,
    "columns2convert_data": ["custkey"],
    "standardizing_column": {"region_txt": {"north": "N", "NORTH-EAST": "NE"}},
    "Text_encoding": "utf-8",
    "inconsistant_unit_column": ["amount"],
    "hashing_privacy": {"columns_to_hash": ["id"], "hash_length": 256},
    "to_imputation": {"priority": "NA"},
    "redundancy_columns": ["year_txt"],
}

_STR5 = ["id", "custkey", "priority", "status", "region_txt"]
_CONFIG_SQL = W(f"""d1 AS (SELECT DISTINCT * FROM dirty_orders),
d2 AS (SELECT id, custkey, amount, CASE WHEN priority = '' THEN NULL ELSE priority END AS priority,
         CASE WHEN status = '' THEN NULL WHEN status = 'Fx' THEN 'F' ELSE status END AS status,
         CASE WHEN year_txt = '' THEN NULL ELSE year_txt END AS year_txt,
         CASE WHEN region_txt = '' THEN NULL ELSE region_txt END AS region_txt FROM d1),
s AS (SELECT avg(amount) AS m, stddev_samp(amount) AS sd FROM d2),
d3 AS (SELECT id, custkey, CASE WHEN abs((amount - m) / sd) > 3 AND amount > m THEN m + 3 * sd
         WHEN abs((amount - m) / sd) > 3 THEN m - 3 * sd ELSE amount END AS amount,
         priority, status, year_txt, region_txt FROM d2, s),
d4 AS (SELECT id, custkey, {rnd_text('amount')} AS amount, priority, status, year_txt, region_txt FROM d3
       WHERE {_NONNULL} >= 6),
d5 AS (SELECT id, CAST(custkey AS VARCHAR) AS custkey,
         TRY_CAST({rnd_text('amount', 0)} AS INTEGER) AS amount, priority, status, year_txt,
         CASE region_txt WHEN 'north' THEN 'N' WHEN 'NORTH-EAST' THEN 'NE' ELSE region_txt END AS region_txt
       FROM d4),
d6 AS (SELECT upper(sha256(CAST(id AS VARCHAR))) AS id,
         upper(regexp_replace(custkey, '{_SPECIAL_RE2}', '', 'g')) AS custkey, amount,
         upper(regexp_replace(priority, '{_SPECIAL_RE2}', '', 'g')) AS priority,
         upper(regexp_replace(status, '{_SPECIAL_RE2}', '', 'g')) AS status,
         upper(regexp_replace(year_txt, '{_SPECIAL_RE2}', '', 'g')) AS year_txt,
         upper(regexp_replace(region_txt, '{_SPECIAL_RE2}', '', 'g')) AS region_txt FROM d5),
d7 AS (SELECT DISTINCT id, custkey, amount, coalesce(priority, 'NA') AS priority, status, year_txt, region_txt
       FROM d6),
sh AS (SELECT {", ".join(f"CAST(count(*) - count({c}) AS DOUBLE) * 100.0 / count(*) AS s_{c}"
                          for c in _DO_ALL)} FROM d7)
SELECT d7.id, custkey, amount, priority, status, region_txt FROM d7, sh
WHERE {" AND ".join(f"NOT ({c} IS NULL AND s_{c} > 0 AND s_{c} < 1)" for c in _DO_ALL)}""")


@query("config_pipeline", _CONFIG_SQL)
def q_config_pipeline(spark, sf):
    from kempt.plans.config import steps_from_config
    return run_pipeline(dirty_orders(spark, sf), steps_from_config(DIRTY_CONFIG))


def _config_reports_sql() -> str:
    parts, none = [], "max(CAST(NULL AS INTEGER))"
    for c, ty in _DO_TYPES.items():
        dom = "count(*) FILTER (WHERE region_txt NOT IN ('north', 'NORTH-EAST'))" if c == "region_txt" else none
        for measure, value in (("nulls", f"count(*) - count({c})"), ("invalid_format", none), ("invalid_domain", dom),
                               ("distinct", f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)")):
            parts.append(f"""SELECT 'validate' AS report, '{c}|{ty}' AS item, '{measure}' AS measure, CAST({value} AS DOUBLE) AS value
FROM dirty_orders""")
    for measure in ("rows", "distinct_rows", "duplicate_groups", "surplus_rows"):
        parts.append(f"SELECT 'transforming.data_duplication', '', '{measure}', CAST({measure} AS DOUBLE) FROM dup")
    dup = _DUP_SQL.format(src="dirty_orders", keys=", ".join(_DO_ALL))
    return f"dup AS ({dup})\n" + "\nUNION ALL\n".join(parts)


@query("config_reports", W(_config_reports_sql()))
def q_config_reports(spark, sf):
    """Every report of the same configuration, stacked."""
    from kempt.plans.config import reports_from_config, stack_reports
    return stack_reports(reports_from_config(dirty_orders(spark, sf), DIRTY_CONFIG))


# =========================================================================== PL1, the reference's own switches
# A table with the 34 columns that the shipped configuration names, one row per order. Each
# expression is SQL that both engines read alike; the rules only place dirt, they drop no row.
_K = "o_orderkey"
LOAN = {
    "ID": _K, "year": "CAST(2015 + o_orderkey % 4 AS INT)",
    "loan_limit": f"CASE WHEN {_K} % 211 = 0 THEN NULL WHEN {_K} % 3 = 0 THEN 'ncf' ELSE 'cf' END",
    "Gender": f"CASE WHEN {_K} % 4 = 0 THEN 'Male' WHEN {_K} % 4 = 1 THEN 'Female' WHEN {_K} % 4 = 2 THEN 'Joint' ELSE 'Sex Not Available' END",
    "approv_in_adv": f"CASE WHEN {_K} % 89 = 0 THEN '' WHEN {_K} % 5 = 0 THEN 'pre' ELSE 'nopre' END",
    "loan_type": f"CASE WHEN {_K} % 6 = 0 THEN 'type3' WHEN {_K} % 6 = 1 THEN 'type2' ELSE 'type1' END",
    "loan_purpose": "lower(substr(c_mktsegment, 1, 2))", "Credit_Worthiness": "'l1'",
    "open_credit": f"CASE WHEN {_K} % 50 = 0 THEN 'opc' ELSE 'nopc' END",
    "business_or_commercial": f"CASE WHEN {_K} % 7 = 0 THEN 'b/c' ELSE 'nob/c' END",
    "loan_amount": f"CASE WHEN {_K} % 97 = 0 THEN o_totalprice * 20 ELSE o_totalprice END",
    "rate_of_interest": f"CASE WHEN {_K} % 150 = 0 THEN NULL ELSE CAST(2.5 + ({_K} % 16) * 0.125 AS DOUBLE) END",
    "Interest_rate_spread": f"CAST({_K} % 1000 AS DOUBLE) / 999 - 0.25",
    "Upfront_charges": f"CASE WHEN {_K} % 4 = 0 THEN NULL ELSE o_totalprice * 0.0125 END",
    "term": f"CAST(CASE WHEN {_K} % 9 = 0 THEN 180 ELSE 360 END AS INT)", "Neg_ammortization": "'not_neg'",
    "interest_only": f"CASE WHEN {_K} % 20 = 0 THEN 'int_only' ELSE 'not_int' END", "lump_sum_payment": "'not_lpsm'",
    "property_value": "o_totalprice * 1.5 + c_custkey", "construction_type": f"CASE WHEN {_K} % 99 = 0 THEN 'mh' ELSE 'sb' END",
    "occupancy_type": "'pr'", "Secured_by": "'home'", "total_units": f"CASE WHEN {_K} % 33 = 0 THEN '2U' ELSE '1U' END",
    "income": f"CASE WHEN {_K} % 101 = 0 THEN c_acctbal * -30 ELSE c_acctbal END", "credit_type": "'EXP'",
    "Credit_Score": f"CAST(500 + {_K} % 400 AS INT)", "co-applicant_credit_type": "'CIB'",
    "age": f"CASE WHEN {_K} % 120 = 0 THEN NULL WHEN {_K} % 2 = 0 THEN '25-34' ELSE '>74' END",
    "submission_of_application": f"CASE WHEN {_K} % 170 = 0 THEN NULL ELSE 'to_inst' END",
    "LTV": "(o_totalprice + 1) * 100 / (o_totalprice * 1.5 + c_custkey)", "Region": "c_mktsegment || '-' || c_nationkey",
    "Security_Type": f"CASE WHEN {_K} % 600 = 0 THEN 'Indriect' ELSE 'direct' END", "Status": f"CAST({_K} % 2 AS INT)",
    "dtir1": f"CAST(20 + {_K} % 40 AS DOUBLE)",
}


def loans(spark, sf):
    j = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    copies = F.when(F.col("o_orderkey") % 40 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return j.select(*[F.expr(e).alias(n) for n, e in LOAN.items()], F.explode(copies).alias("__copy")).drop("__copy")


# The switches and parameters as the configuration ships them.
SHIPPED = {
    "columns_to_winsorize": ["LTV", "income", "loan_amount", "property_value", "Upfront_charges"], "threshold": 3,
    "inconsistant_column": ["LTV", "Interest_rate_spread"],
    "typing_error_inaccuracies": {"Security_Type": {"Indriect": "Indirect"}},
    "null_threshold": 6, "columns2convert_data": ["year", "Status"], "datetime_columns": ["year"],
    "Text_encoding": "utf-8", "inconsistant_unit_column": ["Upfront_charges"],
    "hashing_privacy": {"columns_to_hash": ["ID"], "hash_length": 256},
    "standardizing_column": {
        "Gender": {"Male": "M", "Female": "F", "Joint": "J", "Sex Not Available": "SNA"},
        "loan_limit": {"cf": "CF", "ncf": "NCF"}, "approv_in_adv": {"pre": "P", "nopre": "NP"},
        "loan_type": {"type1": "T1", "type2": "T2", "type3": "T3"}, "business_or_commercial": {"nob/c": "NBC", "b/c": "BC"}},
    "rounding_after_cleaning": ["loan_amount", "property_value", "income"],
    "to_imputation": {"age": "NA", "approv_in_adv": "NP"},
    "col_to_extract": ["Credit_Score", "loan_amount", "property_value", "rate_of_interest", "dtir1", "income", "LTV",
                       "Upfront_charges", "Status"],
    "col_to_sort": "loan_amount", "col_to_convert": ["loan_amount", "property_value"],
    "redundancy_columns": ["Secured_by", "construction_type", "Security_Type", "year", "ID"],
    "col_to_describe": ["loan_amount", "rate_of_interest", "Interest_rate_spread", "Upfront_charges", "term", "property_value",
                        "income", "Credit_Score", "LTV"],
    "dec_col_to_check": ["LTV", "Interest_rate_spread"], "data_to_check": ["DIRECT", "INDIRECT"],
    "std_col_to_check": ["Gender", "loan_limit", "approv_in_adv", "loan_type", "business_or_commercial"],
    "data_schema": dict.fromkeys(LOAN, True),
    "cleansing_config": dict.fromkeys([
        "remove_duplicates", "handle_missing_values", "correct_typos_and_inaccuracies", "handle_outliers",
        "handle_inconsistent_data", "handle_incomplete_records", "convert_data_types", "standardize_categorical_data",
        "handle_encoding_issues", "deal_with_inconsistent_units", "handle_special_characters_and_symbols",
        "conform_to_data_privacy_regulations"], True),
    "massaging": dict.fromkeys(["data_validation", "data_verification", "data_conversion", "data_formatting",
                                "data_deduplication", "data_imputation", "data_normalization"], True),
    "transforming": dict.fromkeys(["data_aggregation", "data_filtering", "data_sorting", "data_extraction",
                                   "data_duplication", "data_conversion", "data_redundancy_removal"], True),
    "validation_config": dict.fromkeys([
        "schema_validation", "datatypes_validation", "duplicates", "row_coulumn_count", "check_uppercase",
        "null_count_validation", "decimal_validation", "spelling_validation", "standardization_check", "special_char_check"], True),
    "hive_schema": {"fields": [{"name": n, "type": "string" if n in ("ID", "year", "Status") else "double"}
                               for n in ("ID", "year", "Status", "loan_amount", "LTV")]},
}
_LOAN_TEXT = ["loan_limit", "Gender", "approv_in_adv", "loan_type", "loan_purpose", "Credit_Worthiness", "open_credit",
              "business_or_commercial", "Neg_ammortization", "interest_only", "lump_sum_payment", "construction_type",
              "occupancy_type", "Secured_by", "total_units", "credit_type", "co-applicant_credit_type", "age",
              "submission_of_application", "Region", "Security_Type"]


def _loan_sql() -> str:
    """The shipped steps written out in SQL, one CTE for each group of steps."""
    def select(new: dict[str, str], source: str, distinct: bool = False) -> str:
        cols = ", ".join(f'{new[n]} AS "{n}"' if n in new else f'"{n}"' for n in LOAN)
        return f"SELECT {'DISTINCT ' * distinct}{cols} FROM {source}"

    wins = SHIPPED["columns_to_winsorize"]
    blank = {n: f"""CASE WHEN "{n}" = '' THEN NULL ELSE "{n}" END""" for n in _LOAN_TEXT}
    blank["Security_Type"] = """CASE "Security_Type" WHEN '' THEN NULL WHEN 'Indriect' THEN 'Indirect' ELSE "Security_Type" END"""
    clamp = {n: f"""CASE WHEN abs(("{n}" - m_{n}) / s_{n}) > 3 AND "{n}" > m_{n} THEN m_{n} + 3 * s_{n}
      WHEN abs(("{n}" - m_{n}) / s_{n}) > 3 THEN m_{n} - 3 * s_{n} ELSE "{n}" END""" for n in wins}
    clamp["LTV"] = rnd_text(clamp["LTV"])
    clamp["Interest_rate_spread"] = rnd_text('"Interest_rate_spread"')
    clamp["Upfront_charges"] = f"TRY_CAST({rnd_text(clamp['Upfront_charges'], 0)} AS INTEGER)"
    text = {n: f'"{n}"' for n in _LOAN_TEXT}
    for n, m in SHIPPED["standardizing_column"].items():
        text[n] = f'CASE "{n}" ' + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in m.items()) + f' ELSE "{n}" END'
    text |= {"year": 'CAST("year" AS VARCHAR)', "Status": 'CAST("Status" AS VARCHAR)'}
    text = {n: e if n == "age" else f"regexp_replace({e}, '{_SPECIAL_RE2}', '', 'g')" for n, e in text.items()}
    text = {n: f"upper({e})" for n, e in text.items()} | {"ID": 'upper(sha256(CAST("ID" AS VARCHAR)))'}
    last = {"age": "coalesce(\"age\", 'NA')", "approv_in_adv": "coalesce(\"approv_in_adv\", 'NP')"}
    last |= {n: f'TRY_CAST({rnd_text(chr(34) + n + chr(34), 0)} AS INTEGER)' for n in SHIPPED["rounding_after_cleaning"]}
    moments = ", ".join(f'avg("{n}") AS m_{n}, stddev_samp("{n}") AS s_{n}' for n in wins)
    shares = ", ".join(f'CAST(count(*) - count("{n}") AS DOUBLE) * 100.0 / count(*) AS "h_{n}"' for n in LOAN)
    filled = " + ".join(f'CASE WHEN "{n}" IS NULL THEN 0 ELSE 1 END' for n in LOAN)
    keep = " AND ".join(f'NOT ("{n}" IS NULL AND "h_{n}" > 0 AND "h_{n}" < 1)' for n in LOAN)
    out = ", ".join(f'"{n}"' for n in LOAN if n not in SHIPPED["redundancy_columns"])
    base = ", ".join(f'{e} AS "{n}"' for n, e in LOAN.items())
    return f"""WITH o AS (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 40 = 0),
loan AS (SELECT DISTINCT {base} FROM o JOIN customer ON o_custkey = c_custkey),
d2 AS ({select(blank, 'loan')}),
mo AS (SELECT {moments} FROM d2),
d3 AS (SELECT * FROM ({select(clamp, 'd2, mo')}) WHERE {filled} >= 6),
d4 AS ({select(text, 'd3', True)}),
d5 AS ({select(last, 'd4')}),
sh AS (SELECT {shares} FROM d5)
SELECT {out} FROM d5, sh WHERE {keep}"""


@query("config_shipped", _loan_sql())
def q_config_shipped(spark, sf):
    """The configuration's own switches over a table with its own 34 columns."""
    from kempt.plans.config import steps_from_config
    return run_pipeline(loans(spark, sf), steps_from_config(SHIPPED))


_LOAN_INT = ["year", "term", "Credit_Score", "Status"]
_LOAN_TYPES = {n: "string" if n in _LOAN_TEXT else "bigint" if n == "ID" else "int" if n in _LOAN_INT else "double" for n in LOAN}
_USD = [f"{n}_usd" for n in SHIPPED["col_to_convert"]]


def _shipped_stacked_sql() -> str:
    """Every report from the loan table; reports of whole rows as counts by column, figures of the
    numeric columns and, for the sorted one, the sum of place times value."""
    parts = []

    def row(report: str, item: str, source: str = "loan", **measures: str) -> None:
        values = ", ".join(f"CAST({v} AS DOUBLE)" for v in measures.values())
        names = ", ".join(f"'{m}'" for m in measures)
        parts.append(f"""SELECT report, item, unnest(m) AS measure, unnest(v) AS value
FROM (SELECT '{report}' AS report, '{item}' AS item, [{names}] AS m, [{values}] AS v FROM {source})""")

    def counts(n: str) -> dict[str, str]:
        return {"nulls": f'count(*) - count("{n}")',
                "distinct": f'count(DISTINCT "{n}") + max(CASE WHEN "{n}" IS NULL THEN 1 ELSE 0 END)'}

    def described(report: str, names: list[str], source: str = "loan") -> None:
        for n in names:
            row(report, n, source, count=f'count("{n}")', mean=rnd(f'avg("{n}")', 4), stddev=rnd(f'stddev_samp("{n}")', 4),
                min=f'min("{n}")', max=f'max("{n}")')

    def bad(test: str) -> dict[str, str]:
        violations = f"count(*) FILTER (WHERE {test})"
        return {"violations": violations, "total": "count(*)", "passed": f"{violations} = 0"}

    for n, ty in _LOAN_TYPES.items():
        domain = ", ".join(f"'{v}'" for v in SHIPPED["standardizing_column"].get(n, {}))
        row("validate", f"{n}|{ty}", **counts(n),
            invalid_format=f"""count(*) FILTER (WHERE NOT regexp_matches(CAST("{n}" AS VARCHAR), '^\\d{{4}}$'))""" if n in SHIPPED["datetime_columns"]
            else "max(NULL::INT)",
            invalid_domain=f'count(*) FILTER (WHERE "{n}" NOT IN ({domain}))' if domain else "max(NULL::INT)")
    wanted = {f["name"]: f["type"] for f in SHIPPED["hive_schema"]["fields"]}
    for report in ("massaging.data_verification", "validation_config.datatypes_validation"):
        for n, ty in _LOAN_TYPES.items():
            if n not in wanted:
                row(report, f"{n}|{ty}|extra", bad_values="max(NULL::INT)")
                continue
            sql = {"string": "VARCHAR", "double": "DOUBLE"}[wanted[n]]
            row(report, f"{n}|{wanted[n]}|{ty}|{'match' if ty == wanted[n] else 'type'}",
                bad_values=f'count(*) FILTER (WHERE "{n}" IS NOT NULL AND TRY_CAST("{n}" AS {sql}) IS NULL)')
    for n in LOAN:
        row("validation_config.schema_validation", f"{n}|match", "(SELECT 1)", rows="1")
    described("transforming.data_aggregation", SHIPPED["col_to_describe"])
    for m in ("rows", "distinct_rows", "duplicate_groups", "surplus_rows"):
        row("transforming.data_duplication", "", "dup", **{m: m})
    types = _LOAN_TYPES | dict.fromkeys(_USD, "double")
    for report, names in (("transforming.data_sorting", list(LOAN)), ("transforming.data_extraction", SHIPPED["col_to_extract"]),
                          ("transforming.data_conversion", list(types))):
        for n in names:
            row(report, f"{n}|{types[n]}", "usd", **counts(n))
        described(f"{report}.numbers", [n for n in names if types[n] != "string"], "usd")
    row("transforming.data_sorting.places", "", "placed", rows="count(*)", place_times_value="sum(place * value)")
    allowed = ", ".join(f"'{v}'" for v in SHIPPED["data_to_check"])
    words = ", ".join(f"('{v}')" for v in SHIPPED["data_to_check"])
    parts.append(f"""SELECT 'validation_config.spelling_validation', x || '|' || v, unnest(['Security_Type_distance', 'count']),
  unnest([CAST(dist AS DOUBLE), CAST(n AS DOUBLE)])
FROM (SELECT x, v, n, levenshtein(upper(x), v) AS dist, row_number() OVER (PARTITION BY x ORDER BY levenshtein(upper(x), v), v) AS rn
      FROM (SELECT "Security_Type" AS x, count(*) AS n FROM loan WHERE "Security_Type" NOT IN ({allowed}) GROUP BY 1),
           (VALUES {words}) w(v)) WHERE rn = 1""")
    report = "validation_config"
    row(report, "duplicates", "dup", violations="surplus_rows", total="rows", passed="surplus_rows = 0")
    row(report, "row_count", violations="CASE WHEN count(*) < 1 THEN 1 ELSE 0 END", total="count(*)", passed="count(*) >= 1")
    for n in LOAN:
        row(report, f"not_null|{n}", **bad(f'"{n}" IS NULL'))
    for n in _LOAN_TEXT:
        row(report, f"uppercase|{n}", **bad(f'"{n}" <> upper("{n}")'))
        row(report, f"special_chars|{n}", **bad(f"""regexp_matches("{n}", '{_SPECIAL_RE2}')"""))
    for n in SHIPPED["dec_col_to_check"]:
        quoted = f'"{n}"'
        row(report, f"decimal|{n}", **bad(f"{quoted} <> {rnd_text(quoted)}"))
    for n in SHIPPED["std_col_to_check"]:
        targets = ", ".join(f"'{v}'" for v in SHIPPED["standardizing_column"][n].values())
        row(report, f"allowed|{n}", **bad(f'"{n}" NOT IN ({targets})'))
    base = ", ".join(f'{e} AS "{n}"' for n, e in LOAN.items())
    usd = ", ".join(f"""{rnd_text(f'"{n}" * CAST(0.012 AS DOUBLE)')} AS {n}_usd""" for n in SHIPPED["col_to_convert"])
    by = SHIPPED["col_to_sort"]
    return f"""WITH o AS (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 40 = 0),
loan AS MATERIALIZED (SELECT {base} FROM o JOIN customer ON o_custkey = c_custkey),
usd AS MATERIALIZED (SELECT *, {usd} FROM loan),
placed AS (SELECT CAST({by} AS DECIMAL(18, 2)) AS value, row_number() OVER (ORDER BY {by} DESC NULLS LAST) AS place FROM loan),
dup AS MATERIALIZED ({_DUP_SQL.format(src="loan", keys=", ".join(f'"{n}"' for n in LOAN))})
""" + "\nUNION ALL\n".join(parts)


def _rounded(described: DataFrame) -> DataFrame:
    return described.withColumns({c: stable_round(F.col(c), 4) for c in ("mean", "stddev")})


def _summed(name: str, rows: DataFrame) -> dict[str, DataFrame]:
    """A report of whole rows as two: nulls and distinct values of each column, figures of the numeric ones."""
    return {name: quality.validate(rows).select("column", "type", "nulls", "distinct"),
            f"{name}.numbers": _rounded(stats.describe_cols(rows, cleanse.numeric_columns(rows)))}


def _places(rows: DataFrame, column: str) -> DataFrame:
    """Rows of a sorted frame and the sum of place (from 1) times value, for stored ``rows`` with
    ``__pid`` and the place ``__nth`` (from 0) inside it."""
    from pyspark.sql import Window
    sizes = rows.groupBy("__pid").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__pid", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__off"))
    place = F.col("__off") + F.col("__nth") + 1
    return rows.join(F.broadcast(offsets), "__pid").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(place * F.col(column).cast("decimal(18,2)")).alias("place_times_value"))


@query("config_shipped_stacked", _shipped_stacked_sql())
def q_config_shipped_stacked(spark, sf):
    """Every report of the shipped configuration, stacked; reports of whole rows are summed up."""
    from kempt.plans.config import reports_from_config, stack_reports
    # every report reads the table: written once, its join is not made again for each
    reports = reports_from_config(materialize(loans(spark, sf), "loans"), SHIPPED)
    name = "transforming.data_aggregation"
    reports[name] = _rounded(reports[name])
    for name in ("transforming.data_extraction", "transforming.data_conversion"):
        reports |= _summed(name, reports[name])
    name = "transforming.data_sorting"
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # its upper bits are the partition
    ranked = materialize(reports[name].withColumns({"__pid": F.spark_partition_id(), "__nth": place}), "sorted-report")
    reports |= _summed(name, ranked.drop("__pid", "__nth"))
    reports[f"{name}.places"] = _places(ranked, SHIPPED["col_to_sort"])
    return stack_reports(reports)
