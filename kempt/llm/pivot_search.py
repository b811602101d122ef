"""Exact top-k search by inner product with a pivot table.

Components become integers, so scores are exact. A few dozen vectors, chosen far from each
other among a bounded sample, are the pivots; the table holds every vector's distance to each
of them. By the triangle inequality |d(q, p) - d(x, p)| <= d(q, x), so the largest of these
over all pivots bounds the distance from below and, as 2 <q, x> = |q|^2 + |x|^2 - d(q, x)^2,
the score from above.

Vectors are dealt to the cell of their nearest pivot and packed into blocks, queries into
blocks of their own. A query first meets the blocks of its own cell, which gives it the
score to beat, and then those of every other cell whose range of pivot distances leaves
room for such a score. Within a block candidates are evaluated in the order of their bounds
until the next bound is below the k-th best score, so the result is exact. A block meets
only blocks of the same cell, by an equality join on the cell and a part of it: the blocks of
a crowded cell are dealt to parts, and its query blocks are copied to each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kempt.llm.common import n_parts, on_workers, stored

_BLOCK = "cell int, numbers binary, ids binary, vectors binary, distances binary"
_HITS = "query_row long, query_id long, vec_id long, score long"
_STEP = 128  # candidates evaluated at a time
_NOTHING = np.iinfo(np.int64).min  # a score to beat that every score beats


def integers(vec: Column) -> Column:
    return F.transform(vec, lambda x: F.floor(x.cast("double") * 256).cast("long"))


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: in doubles where sums stay below 2**53 (known for rows
    that are doubles already)."""
    if a.dtype == np.float64:
        return np.rint(a @ b.T).astype(np.int64)
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[-1])
    if top < 2**53:
        return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if top >= 2**63:
        raise ValueError("scores of these vectors do not fit into 64 bits")
    return a @ b.T


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None] - 2 * _dots(x, pivots)
    return np.sqrt(np.maximum(square, 0).astype(np.float64))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: each next pivot is the vector farthest from those already chosen."""
    chosen = [0]
    near = distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(n, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists of integers as rows, shorter ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dim), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, at] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def narrowest(top: int) -> str:
    """The smallest integer type for components of size up to ``top``."""
    return next(t for t in ("int16", "int32", "int64") if top <= np.iinfo(t).max)


def _cells(pivots: np.ndarray):
    def run(batches):
        for b in batches:
            x = _matrix(b["v"], pivots.shape[1])
            cell = distances(x, pivots).argmin(axis=1).astype(np.int32) if len(x) else np.zeros(0, np.int32)
            yield b.append_column("cell", pa.array(cell))
    return run


def _pack(pivots: np.ndarray, block_rows: int, kind: str):
    """Rows sorted by cell to blocks of at most ``block_rows`` vectors of one cell."""
    def block(cell, ids, x):
        own = np.concatenate(ids)  # row numbers and ids
        return (cell, own[:, 0].tobytes(), own[:, 1].tobytes(), (x := np.concatenate(x)).astype(kind).tobytes(), distances(x, pivots).tobytes())

    def run(batches):
        held_cell, ids, xs, n = None, [], [], 0
        for b in batches:
            cells, x = b["cell"].to_numpy(), _matrix(b["v"], pivots.shape[1])
            i = np.stack([b["row"].to_numpy(), b["vec_id"].to_numpy()], axis=1)
            out = []
            cuts = np.flatnonzero(np.diff(cells)) + 1
            for c, xi, ii in zip(np.split(cells, cuts), np.split(x, cuts), np.split(i, cuts), strict=True):
                if not len(c):
                    continue
                if held_cell is not None and (c[0] != held_cell or n >= block_rows):
                    out.append(block(held_cell, ids, xs))
                    ids, xs, n = [], [], 0
                for k in range(0, len(c), block_rows):
                    if n and n + len(c[k:k + block_rows]) > block_rows:
                        out.append(block(int(c[0]), ids, xs))
                        ids, xs, n = [], [], 0
                    ids.append(ii[k:k + block_rows])
                    xs.append(xi[k:k + block_rows])
                    n += len(ids[-1])
                held_cell = int(c[0])
            yield _blocks(out)
        if n:
            yield _blocks([block(held_cell, ids, xs)])
    return run


def _blocks(rows):
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.record_batch([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                           names=["cell", "numbers", "ids", "vectors", "distances"])


def best(own: int, q: np.ndarray, numbers: np.ndarray, ids: np.ndarray, x: np.ndarray, bound: np.ndarray, k: int,
         beat: int | None) -> list[tuple[int, int]]:
    """(vec_id, score) of the k best candidates, rows other than number ``own``; none below ``beat``."""
    order = np.flatnonzero((numbers != own) & ((bound >= beat) if beat is not None else True))
    order = order[np.argsort(-bound[order], kind="stable")]
    found: list[tuple[int, int]] = []
    kth = beat
    for i in range(0, len(order), _STEP):
        part = order[i:i + _STEP]
        if kth is not None and bound[part[0]] < kth:
            break
        scores = _dots(q[None], x[part])[0]
        found += [(-s, v) for s, v in zip(scores.tolist(), ids[part].tolist(), strict=True) if kth is None or s >= kth]
        found = sorted(found)[:k]
        if len(found) == k:
            kth = max(-found[-1][0], kth if kth is not None else -found[-1][0])
    return [(v, -s) for s, v in found]


def _meet(dim: int, m: int, k: int, kind: str):
    """Pairs of a query block and a candidate block of one cell to each query's best."""
    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                q_rows, q_ids, rows, ids = (np.frombuffer(r[n], np.int64) for n in ("q_numbers", "q_ids", "numbers", "ids"))
                q = np.frombuffer(r["q_vectors"], kind).reshape(-1, dim).astype(np.int64)
                x = np.frombuffer(r["vectors"], kind).reshape(-1, dim).astype(np.int64)
                dq = np.frombuffer(r["q_distances"], np.float64).reshape(-1, m)
                dx = np.frombuffer(r["distances"], np.float64).reshape(-1, m)
                beats = np.frombuffer(r["beat"], np.int64).tolist()
                qq, xx = (q * q).sum(axis=1), (x * x).sum(axis=1)
                columns = np.ascontiguousarray(dx.T)
                if float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, dim) < 2**53:
                    q, x = q.astype(np.float64), x.astype(np.float64)  # products are exact, converted once a block
                for i in range(len(q)):
                    low = np.zeros(len(x))
                    for p in range(m):
                        np.maximum(low, np.abs(columns[p] - dq[i, p]), out=low)
                    bound = upper(qq[i], xx, low)
                    beat = None if beats[i] == _NOTHING else beats[i]
                    own = int(q_rows[i])
                    out += [(own, int(q_ids[i]), v, s) for v, s in best(own, q[i], rows, ids, x, bound, k, beat)]
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=["query_row", "query_id", "vec_id", "score"])
    return run


def upper(qq, xx, low):
    """Bound of the score from above, with room for the rounding of distances."""
    low = np.maximum(0, low - 1e-6 * (1 + low))
    return (qq + xx - low * low) / 2 + 1e-6 * (1 + np.abs(qq) + np.abs(xx))


def _send(pivots: np.ndarray, nearest: np.ndarray, farthest: np.ndarray, norm: np.ndarray, home: bool):
    """Queries with the cells they have to meet: their own, or all others with room for a score
    of at least ``beat``."""
    def run(batches):
        for b in batches:
            q = _matrix(b["v"], pivots.shape[1])
            d = distances(q, pivots) if len(q) else np.zeros((0, len(pivots)))
            own = b["cell"].to_numpy()
            if home:
                rows, cells = np.arange(len(q)), own
            else:
                beat = b["beat"].to_numpy(zero_copy_only=False).astype(np.float64)  # null: not a number, nothing to beat
                low = np.zeros((len(q), len(norm)))
                for p in range(len(pivots)):
                    np.maximum(low, np.maximum(nearest[None, :, p] - d[:, p:p + 1], d[:, p:p + 1] - farthest[None, :, p]), out=low)
                room = ~(upper((q * q).sum(axis=1)[:, None], norm[None], low) < beat[:, None])
                room[np.arange(len(q)), own] = False
                room &= norm[None] >= 0  # cells that hold vectors
                rows, cells = np.nonzero(room)
            t = b.take(pa.array(rows))
            yield t.set_column(t.schema.get_field_index("cell"), "cell", pa.array(cells.astype(np.int32)))
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          pivots: int = 32, sample: int = 2048, block_rows: int = 4096, query_rows: int = 256, part_blocks: int = 16) -> DataFrame:
    """One row per query and rank: query_id, rank (int, from 1), vec_id, score (integer inner
    product of components floor(256 * x)); ties to the smaller vec_id.

    ``is_query``: condition on the columns of ``vectors``. Candidates are all rows but the query's own.
    Rows whose id or vector is null or whose vector holds a null or non-finite component take
    no part; a shorter vector counts as filled up with zeros. Rows that repeat an id are rows like any
    other: each is a candidate of its own, also of the others, and as a query has its own ranks. Fewer
    candidates than k: all of them. No queries: no rows. The pivots come from ``sample`` vectors
    with the smallest hash of the id; all vectors are in the table. A part of a cell has about
    ``part_blocks`` blocks."""
    spark = vectors.sparkSession
    on_workers(spark)
    vec = F.col(f"`{vec_col}`")
    usable = vec.isNotNull() & F.col(f"`{id_col}`").isNotNull() & F.forall(
        vec, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = vectors.filter(usable).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), integers(vec).alias("v"),
                                         F.coalesce(is_query, F.lit(False)).alias("is_query"))
    dim, total, top = rows.agg(F.max(F.size("v")), F.count(F.lit(1)), F.max(F.array_max(F.transform("v", F.abs)))).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not total:
        return empty
    dim = max(1, dim)
    head = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()
    table = choose_pivots(np.array([r["v"] + [0] * (dim - len(r["v"])) for r in head], np.int64), pivots)
    kind = narrowest(top or 0)
    # numbers are fixed by the write: rows of one id are told apart
    celled = stored(rows.mapInArrow(_cells(table), "vec_id long, v array<long>, is_query boolean, cell int")
                    .withColumn("row", F.monotonically_increasing_id()), "vectors")
    salts = -(-total // (len(table) * block_rows))
    blocks = stored(celled.select("row", "vec_id", "v", "cell").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
                    .repartition(n_parts(spark), "cell", "salt").sortWithinPartitions("cell", "salt")
                    .mapInArrow(_pack(table, block_rows, kind), _BLOCK), "vector-blocks")
    m = len(table)
    # range of each pivot distance and the largest norm by cell: pivots x pivots numbers
    stats = blocks.mapInArrow(_ranges(dim, m, kind), "cell int, p int, low double, high double, norm long").groupBy("cell", "p").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("norm").alias("norm")).collect()
    nearest, farthest, norm = np.full((m, m), np.inf), np.full((m, m), -np.inf), np.full(m, -1, np.int64)
    for r in stats:
        nearest[r["cell"], r["p"]], farthest[r["cell"], r["p"]], norm[r["cell"]] = r["low"], r["high"], r["norm"]
    sizes = {r["cell"]: r["count"] for r in blocks.groupBy("cell").count().collect()}  # at most one row a pivot
    parts = F.get(F.lit([-(-sizes.get(c, 1) // part_blocks) for c in range(m)]), F.col("cell"))
    dealt = blocks.withColumn("part", F.pmod(F.xxhash64("numbers"), parts))

    def ask(queries: DataFrame, home: bool) -> DataFrame:
        sent = queries.mapInArrow(_send(table, nearest, farthest, norm, home), "row long, vec_id long, v array<long>, cell int, beat long")
        packed = (sent.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(query_salts)))
                  .repartition(n_parts(spark), "cell", "salt").sortWithinPartitions("cell", "salt")
                  .mapInArrow(_pack_queries(table, query_rows, kind), _BLOCK + ", beat binary"))
        packed = stored(packed.withColumnsRenamed({c: f"q_{c}" for c in ("numbers", "ids", "vectors", "distances")}), "query-blocks")
        copied = packed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts.cast("bigint") - 1)))
        hits = copied.join(dealt.hint("merge"), ["cell", "part"]).mapInArrow(_meet(dim, m, k, kind), _HITS)
        nth = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
        return stored(hits.withColumn("rank", nth).filter(F.col("rank") <= k), "hits")

    queries = stored(celled.filter("is_query").select("row", "vec_id", "v", "cell"), "queries")
    query_salts = max(1, -(-queries.count() // (m * query_rows)))
    near = ask(queries.withColumn("beat", F.lit(None).cast("long")), True)
    beat = near.filter(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").alias("beat"))
    far = ask(queries.join(beat, "row", "left"), False)
    both = near.drop("rank").unionByName(far.drop("rank"))
    nth = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return both.withColumn("rank", nth).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _ranges(dim: int, m: int, kind: str):
    def run(batches):
        for b in batches:
            out = []
            for r in b.select(["cell", "vectors", "distances"]).to_pylist():
                x, d = np.frombuffer(r["vectors"], kind).reshape(-1, dim).astype(np.int64), np.frombuffer(r["distances"]).reshape(-1, m)
                top = int((x * x).sum(axis=1).max())
                out += [(r["cell"], p, lo, hi, top) for p, (lo, hi) in enumerate(zip(d.min(axis=0).tolist(), d.max(axis=0).tolist(), strict=True))]
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            types = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["cell", "p", "low", "high", "norm"])
    return run


def _pack_queries(pivots: np.ndarray, rows: int, kind: str):
    def run(batches):
        held: list[pa.RecordBatch] = []

        def flush():
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            x = _matrix(t["v"], pivots.shape[1])
            beat = t["beat"].fill_null(_NOTHING).to_numpy()
            out = []
            cells = t["cell"].to_numpy()
            cuts = np.flatnonzero(np.diff(cells)) + 1
            for k in np.split(np.arange(len(cells)), cuts):
                for i in range(0, len(k), rows):
                    part = k[i:i + rows]
                    out.append((int(cells[part[0]]), t["row"].to_numpy()[part].tobytes(), t["vec_id"].to_numpy()[part].tobytes(), x[part].astype(kind).tobytes(),
                                distances(x[part], pivots).tobytes(), beat[part].tobytes()))
            cols = list(zip(*out, strict=True))
            return pa.record_batch([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                                   names=["cell", "numbers", "ids", "vectors", "distances", "beat"])

        for b in batches:
            if b.num_rows:
                held.append(b)
            if sum(h.num_rows for h in held) >= 16 * rows:
                yield flush()
                held.clear()
        if held:
            yield flush()
    return run
