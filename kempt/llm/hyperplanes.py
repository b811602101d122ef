"""Near-duplicate vectors by random-hyperplane signs in several tables.

The signs of a vector's products with ``bits`` random directions are its bucket in one table. At
an angle a, two vectors agree in a sign with probability 1 - a / pi, so both bits and tables
follow from the number of vectors: buckets of about ``bucket`` vectors that are unrelated, and
as many tables as leave a pair at the threshold unmet with probability ``miss`` (closer pairs
are missed far more rarely).

Equal vectors are one node with a weight. Nodes of a bucket meet in blocks: products of doubles,
every pair verified exactly, a pair that several tables bring together counted in the first of
them only (each node carries all its buckets). A block gives the number of links of each node
and a spanning forest of the links, never the pairs. A bucket of more than ``block`` nodes is
dealt into chunks by a hash, and every two chunks meet in a block of their own, so no block holds
more than about twice that. Components come from large and small stars over the forests.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.llm.common import n_parts, on_workers, slices, stored
from kempt.llm.components import components

_SEED = 20_111
_ROWS = 512  # rows of a block whose products are formed at a time


def plan(n: int, threshold: float, bucket: int, miss: float) -> tuple[int, int]:
    """(bits, tables) for ``n`` vectors."""
    bits = min(30, max(4, math.ceil(math.log2(max(1, n) / bucket))))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - together)))


def directions(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng(_SEED).standard_normal((dim, tables * bits))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists as rows, shorter ones filled up with zeros, and which take part: not null, all
    components finite, one of them not zero."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten()
    holes = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
    null = column.is_null().to_numpy(zero_copy_only=False)
    sizes = np.where(null, 0, sizes)
    row = np.repeat(np.arange(len(column)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    x = np.zeros((len(column), dim))
    x[row, at] = values
    bad = np.zeros(len(column), bool)
    bad[row[holes | ~np.isfinite(values)]] = True
    x[bad] = 0.0
    return x + 0.0, ~null & (x != 0).any(axis=1)  # + 0.0: no negative zeros


def _digested(dim: int, kind: type, payload: bool):
    def run(batches):
        for big in batches:
            for b in slices(pa.Table.from_batches([big]).to_batches(), 4096):
                x, usable = _matrix(b["v"], dim)
                rows = [r.tobytes() for r in x.astype(kind)]
                key = [hashlib.blake2b(r, digest_size=16).digest() if u else None for r, u in zip(rows, usable, strict=True)]
                cols = [b["vec_id"], pa.array(key, pa.binary())]
                names = ["vec_id", "digest"]
                if payload:
                    cols.append(pa.array([r if u else None for r, u in zip(rows, usable, strict=True)], pa.binary()))
                    names.append("vec")
                yield pa.record_batch(cols, names=names)
    return run


def _signed(dim: int, kind: type, bits: int, tables: int):
    """Nodes to one row per table: its bucket there, and all its buckets."""
    def run(batches):
        planes = directions(dim, bits, tables)
        powers = 1 << np.arange(bits, dtype=np.int32)
        for big in batches:
            for b in slices([big], 1024):
                x = np.frombuffer(b"".join(b["vec"].to_pylist()), kind).reshape(-1, dim).astype(np.float64)
                signs = (unit(x) @ planes >= 0).reshape(len(x), tables, bits) if len(x) else np.zeros((0, tables, bits), bool)
                buckets = (signs * powers).sum(axis=2, dtype=np.int32)
                every = pa.array([r.tobytes() for r in buckets], pa.binary())
                for t in range(tables):
                    yield pa.record_batch([pa.array(np.full(len(x), t, np.int32)), pa.array(buckets[:, t].copy()), b["node"], b["n"], b["vec"], every],
                                          names=["t", "bucket", "node", "n", "vec", "buckets"])
    return run


def forest(linked: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges of a spanning forest of a symmetric matrix of links."""
    rest = linked.any(axis=1)
    us, vs = [], []
    for first in np.flatnonzero(rest).tolist():
        if not rest[first]:
            continue
        rest[first] = False
        queue = [first]
        while queue:
            i = queue.pop()
            near = np.flatnonzero(linked[i] & rest).tolist()
            rest[near] = False
            us += [i] * len(near)
            vs += near
            queue += near
    return us, vs


def meet(t: int, x: np.ndarray, buckets: np.ndarray, n: np.ndarray, side: np.ndarray | None, threshold: float):
    """(links, us, vs) of the nodes of one block: weights of the linked nodes counted here, and a
    spanning forest of the links. ``side``: 0 and 1 for the nodes of two chunks, which meet across
    only; None for one chunk, which meets itself."""
    x = unit(x)
    m = len(x)
    linked = np.zeros((m, m), bool)
    for i in range(0, m, _ROWS):
        linked[i:i + _ROWS] = x[i:i + _ROWS] @ x.T >= threshold
    linked = np.triu(linked, 1)
    if side is not None:
        linked &= side[:, None] != side[None]
    i, j = np.nonzero(linked)
    # of a pair that several tables bring together, the first counts
    for s in range(t):
        new = buckets[i, s] != buckets[j, s]
        i, j = i[new], j[new]
    linked[:] = False
    linked[i, j] = linked[j, i] = True
    links = np.zeros(m, np.int64)
    np.add.at(links, i, n[j])
    np.add.at(links, j, n[i])
    return links, *forest(linked)


def _meets(dim: int, kind: type, tables: int, threshold: float):
    """Rows sorted by block to (node, links, other): links of a node, or an edge of a forest."""
    keys = ["t", "bucket", "a", "b"]

    def block(part: pa.Table):
        t = part["t"][0].as_py()
        x = np.frombuffer(b"".join(part["vec"].to_pylist()), kind).reshape(-1, dim).astype(np.float64)
        buckets = np.frombuffer(b"".join(part["buckets"].to_pylist()), np.int32).reshape(-1, tables)
        node = part["node"].to_numpy()
        side = part["side"].to_numpy() if part["a"][0].as_py() != part["b"][0].as_py() else None
        return node, *meet(t, x, buckets, part["n"].to_numpy(), side, threshold)

    def out(table: pa.Table):
        k = np.stack([table[c].to_numpy() for c in keys])
        cuts = np.concatenate([[0], np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1, [k.shape[1]]])
        nodes, links, others = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if e - s < 2:
                continue
            node, count, us, vs = block(table.slice(s, e - s))
            hit = np.flatnonzero(count)
            nodes += [node[hit], node[us]] if us else [node[hit]]
            links += [count[hit], np.zeros(len(us), np.int64)] if us else [count[hit]]
            others += [np.full(len(hit), -1), node[vs]] if us else [np.full(len(hit), -1)]
        return pa.record_batch([pa.array(np.concatenate(c).astype(np.int64)) for c in (nodes, links, others)], names=["node", "links", "other"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            last = [b[c][b.num_rows - 1].as_py() for c in keys]
            if held and [held[0][c][0].as_py() for c in keys] == last:
                held.append(b)  # one block so far
                continue
            table = pa.Table.from_batches([*held, b])
            k = np.stack([table[c].to_numpy() for c in keys])
            done = int(np.flatnonzero((k != k[:, -1:]).any(axis=0))[-1]) + 1 if (k != k[:, -1:]).any() else 0
            if done:
                yield out(table.slice(0, done))
            held = table.slice(done).combine_chunks().to_batches()
        if held:
            yield out(pa.Table.from_batches(held))
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95,
                 bucket: int = 512, miss: float = 0.002, block: int = 2048) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links (other rows whose cosine with it is at least
    ``threshold``), component_id (the smallest vec_id that links reach), kept (vec_id is component_id).

    Cosines are taken in doubles; a shorter vector counts as filled up with zeros. Rows whose
    vector is null, zero or holds a null or non-finite component link with nothing. Rows of equal
    vectors link with each other, rows that share a vec_id too. A null id is larger than any other:
    a component without ids has a null component_id, and its rows are kept. An empty table gives no
    rows. A pair at the threshold is missed with probability ``miss``."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie above 0 and not above 1")
    spark = vectors.sparkSession
    on_workers(spark)
    vec = F.col(f"`{vec_col}`")
    kind = np.float32 if vectors.select(vec).schema[0].dataType.simpleString() == "array<float>" else np.float64
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vec.cast("array<double>" if kind is np.float64 else "array<float>").alias("v"))
    dim = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 0)
    nodes = stored(rows.mapInArrow(_digested(dim, kind, True), "vec_id long, digest binary, vec binary").filter("digest is not null")
                   .groupBy("digest").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("n"), F.first("vec").alias("vec"))
                   .withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    bits, tables = plan(nodes.count(), threshold, bucket, miss)

    signed = nodes.select("node", "n", "vec").mapInArrow(
        _signed(dim, kind, bits, tables), "t int, bucket int, node long, n long, vec binary, buckets binary")
    crowds = stored(signed.groupBy("t", "bucket").count().filter(F.col("count") > block)
                    .select("t", "bucket", F.ceil(F.col("count") / block).cast("int").alias("chunks")), "crowds")
    chunks = F.coalesce("chunks", F.lit(1))
    dealt = signed.join(crowds, ["t", "bucket"], "left").withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    # a chunk meets itself and every other one
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), chunks - 1))).select(
        "t", "bucket", F.least("chunk", "with").alias("a"), F.greatest("chunk", "with").alias("b"),
        (F.col("chunk") > F.col("with")).cast("int").alias("side"), "node", "n", "vec", "buckets")
    met = stored(dealt.repartition(n_parts(spark), "t", "bucket", "a", "b").sortWithinPartitions("t", "bucket", "a", "b")
                 .mapInArrow(_meets(dim, kind, tables, threshold), "node long, links long, other long"), "vector-links")
    links = met.filter("other < 0").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(met.filter("other >= 0").select(F.col("node").alias("u"), F.col("other").alias("v")))
    rooted = stored(nodes.select("node", "digest", "vec_id", "n").join(links, "node", "left").join(roots, "node", "left")
                    .select("digest", "vec_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                            F.coalesce("root", "node").alias("root")), "vector-roots")
    lead = rooted.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    found = stored(rooted.join(lead, "root").select(F.col("digest").alias("found"), "n_links", "component_id"), "vector-components")
    keyed = rows.mapInArrow(_digested(dim, kind, False), "vec_id long, digest binary")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return keyed.join(found, F.col("digest") == F.col("found"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))
