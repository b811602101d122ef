"""Registered queries of the training-data operators, with DuckDB SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kempt.llm import exact_dedup, hyperplanes, language_id, mixing, packing, periodic_runs, pivot_search, separator_scan, simhash, simple8b, suffix_dedup, toxicity, turn_repair
from kempt.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_exact_dedup", r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)""")
def op1(spark, sf):
    return exact_dedup.exact_dedup(table(spark, sf, "documents"))


@query("op2_simhash")
def op2(spark, sf):
    return simhash.near_dedup(table(spark, sf, "documents")).select("doc_id", "fingerprint", "component_id")


@query("op3_mixing", r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS source,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens FROM documents),
t AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS total FROM d GROUP BY source),
m AS (SELECT max(total) AS high, min(total) AS low, count(*) AS n FROM t WHERE total > 0),
g AS (SELECT k, ln(sum(pow(total / high, k / 10000))) - k / 10000 * sum(pow(total / high, k / 10000) * ln(total / high))
             / sum(pow(total / high, k / 10000)) AS entropy
      FROM t, m, range(0, 10001) r(k) WHERE total > 0 GROUP BY k),
a AS (SELECT greatest((SELECT coalesce(max(k), 0) FROM g, m WHERE entropy >= 0.999 * ln(n) - 1e-9),
                      (SELECT min(k) FROM range(0, 10001) r(k), m WHERE pow(high / low, 1 - k / 10000) <= 1.5 + 1e-9)) / 10000 AS alpha),
q AS (SELECT source, total, CASE WHEN total > 0 THEN CAST(round(total * pow(high / total, 1 - alpha)) AS BIGINT) ELSE 0 END AS quota
      FROM t, m, a),
s AS (SELECT *, CASE WHEN total > 0 THEN quota // total ELSE 1 END AS epochs FROM q),
p AS (SELECT d.*, total, quota, epochs, quota - epochs * total AS rest,
             CAST('0x' || substr(md5(doc_id || ':' || epochs || ':0'), 1, 15) AS BIGINT) AS h
      FROM d JOIN s ON d.source = s.source),
c AS (SELECT *, epochs + CASE WHEN total > 0 AND sum(tokens) OVER (PARTITION BY source ORDER BY h RANGE UNBOUNDED PRECEDING) <= rest
                              THEN 1 ELSE 0 END AS copies FROM p),
e AS (SELECT doc_id, source, tokens, CASE WHEN total > 0 THEN quota / total ELSE 1 END AS passes,
             unnest(range(CAST(copies AS BIGINT))) AS epoch FROM c)
SELECT doc_id, source, tokens, CAST(epoch AS INTEGER) AS epoch, CAST(least(floor(least(
         (epoch + CAST(CAST('0x' || substr(md5(doc_id || ':' || epoch || ':0'), 1, 15) AS BIGINT) AS DOUBLE) / 1152921504606846976.0)
         / greatest(passes, 1.0), 1.0) * 1024), 1023) AS INTEGER) AS block
FROM e""")
def op3(spark, sf):
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "source", "tokens", "epoch", "block")


@query("op4_language_id")
def op4(spark, sf):
    return language_id.identify(table(spark, sf, "documents"))


@query("op5_toxicity")
def op5(spark, sf):
    return toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels")).select(
        "doc_id", "held_out", "score", "predicted")


@query("op6_separator_scan")
def op6(spark, sf):
    path = scratch_dir(spark, "flat-tokens")
    separator_scan.write_flat(table(spark, sf, "documents"), path)
    return separator_scan.with_ids(separator_scan.count_tokens(spark, path), path)


@query("op7_packing")
def op7(spark, sf):
    return packing.pack(table(spark, sf, "documents"))


@query("op8_simple8b")
def op8(spark, sf):
    path = scratch_dir(spark, "simple8b")
    simple8b.write_ids(table(spark, sf, "documents"), path)
    return simple8b.read_ids(spark, path, with_ids=False)


@query("op9_suffix_dedup")
def op9(spark, sf):
    found = suffix_dedup.remove_repeats(table(spark, sf, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_pivot_search", """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""")
def op10(spark, sf):
    return pivot_search.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op11_periodic_runs")
def op11(spark, sf):
    return periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.planted(table(spark, sf, "documents"))))


@query("op12_hyperplanes", """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN list_transform(embedding, lambda x: CAST(x AS DOUBLE)) END AS e FROM embeddings),
l AS (SELECT a.r AS u, b.r AS v FROM v a JOIN v b ON a.r <> b.r AND a.e IS NOT NULL AND b.e IS NOT NULL AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT r AS u, r AS v FROM v UNION SELECT reach.u, l.v FROM reach JOIN l ON reach.v = l.u),
c AS (SELECT reach.u AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON reach.v = v.r GROUP BY reach.u),
n AS (SELECT u AS r, count(*) AS n_links FROM l GROUP BY u)
SELECT v.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, v.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN c ON v.r = c.r LEFT JOIN n ON v.r = n.r""")
def op12(spark, sf):
    return hyperplanes.near_vectors(table(spark, sf, "embeddings"))


def _repair_sql() -> str:
    """A recursion from the last turn to the first. In each grammar state (s start, y after system,
    u after user, a after assistant) it carries the best repair of the rest as one string: cost in
    ten digits, audit, chr(1), repaired lines; the least string is the best repair."""
    def step(x, cost, initial, line=None):
        rest = f"substr({x}, strpos({x}, chr(1)) + 1)"
        lines = rest if line is None else f"{line} || CASE WHEN {rest} = '' THEN '' ELSE chr(10) || {rest} END"
        return (f"(lpad(CAST(CAST(substr({x}, 1, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || '{initial}' || "
                f"substr({x}, 11, strpos({x}, chr(1)) - 11) || chr(1) || {lines})")

    def base(q, following, role, keeps):
        stay = [f"CASE WHEN NOT gone AND initial = '{i}' THEN {step(x, 'extra', 'K', turn)} END" for i, x in keeps]
        other = f"CASE WHEN NOT gone THEN {step(following, '2 + extra', 'R', repr(role + ':') + ' || text')} END"
        return f"least({', '.join([step(q, 3, 'D'), *stay, other])}) AS b{q if q != 'y' else 'y_'}"

    turn = "role || ':' || text"
    bases = ", ".join([base("s", "u", "user", [("s", "y"), ("u", "u")]), base("y", "u", "user", [("u", "u")]),
                       base("u", "a", "assistant", [("a", "a")]), base("a", "u", "user", [("u", "u")])])
    user = f"least(bu, {step('ba', 2, 'I', repr('assistant:'))})"
    return f"""
WITH RECURSIVE bits AS (SELECT i, i AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS crc FROM bits WHERE k = 8),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: ord(x)::BIGINT)),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS code FROM conversations, tab),
d AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
        CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM (SELECT *, unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k)),
p AS (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t, left(role, 1) AS initial,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM d),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS seen FROM p),
f AS (SELECT *, t = '' OR seen > 1 AS gone, CASE WHEN right(t, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS extra,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM o),
e AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (t = '') AS blank,
        count(*) FILTER (t <> '' AND seen > 1) AS duplicate, count(*) FILTER (NOT gone AND extra = 1) AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n FROM f GROUP BY conv_id),
w AS (SELECT conv_id, n + 1 AS pos, '0000000000' || chr(1) AS s, '0000000004II' || chr(1) || 'user:' || chr(10) || 'assistant:' AS y,
        '0000000002I' || chr(1) || 'assistant:' AS u, '0000000000' || chr(1) AS a FROM e
  UNION ALL SELECT conv_id, pos, least(bs, {step(user, 2, 'I', repr('user:'))}), least(by_, {step(user, 2, 'I', repr('user:'))}),
        {user}, least(ba, {step('bu', 2, 'I', repr('user:'))})
      FROM (SELECT f.conv_id, f.pos, {bases} FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos - 1))
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(substr(s, 1, 10) AS BIGINT), 0) AS cost,
  coalesce(substr(s, 11, strpos(s, chr(1)) - 11), '') AS audit, sha256(coalesce(substr(s, strpos(s, chr(1)) + 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN e ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN w ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.pos = 1"""


@query("op13_turn_repair", _repair_sql())
def op13(spark, sf):
    return turn_repair.summary(table(spark, sf, "conversations"))
