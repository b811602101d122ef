"""SimHash near-dedup by deletion-variant signatures.

A 64-bit fingerprint is cut into two halves. If two fingerprints differ in at most three
bits, one half differs in at most one, so both share a signature: that half with one bit
position wiped out. Each different fingerprint is indexed under its 64 signatures; those
that meet under a signature are verified by their bit distance.

Links are needed only to connect documents, so a group of fingerprints under one signature
gives a spanning forest of its links (fewer rows than members), never all pairs. Groups are
read as runs of sorted rows. A run beyond ``run_limit`` is not gathered: its rows go on to a
second index, on the other half cut into two quarters with one bit wiped out in the same
way. There 46 of the 64 bits are the same for all members, so a group has at most 2**18.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.llm.common import id_text, keep_rows, n_parts, on_workers, slices, stored
from kempt.llm.components import components

_SEED = 42
_CHUNK = 1 << 15
_SECOND = np.int64(1 << 41)  # marks signatures of the second index; 0 is no such signature


def fingerprint(text: str, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles, repeats included. Words are runs of anything but
    ASCII white space, A-Z in lower case; fewer words than a shingle make one shingle, none
    make the fingerprint zero. A bit is set if it is set in over half of the XXH64 hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), ends[min(shingle, len(words)) - 1:].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for i in range(0, n, _CHUNK):
        h = b"".join([digest(joined[a:b], _SEED) for a, b in zip(first[i:i + _CHUNK], last[i:i + _CHUNK], strict=True)])
        bits = np.unpackbits(np.frombuffer(h, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches):
        for b in slices(batches):
            fp = np.array([fingerprint(t, shingle) for t in b["text"].to_pylist()], np.uint64).view(np.int64)
            yield pa.record_batch([b["doc_id"], b["text_key"], pa.array(fp)], names=["doc_id", "text_key", "fp"])
    return run


# ------------------------------------------------------------------ signatures
def _variants(part: np.ndarray, tag: int, width: int) -> np.ndarray:
    """(n, width) signatures of a part of ``width`` bits: at p, bit p wiped out."""
    pos = np.arange(width, dtype=np.int64)
    return (np.int64(tag) << 40) | (pos << 34) | (part[:, None] & ~(np.int64(1) << pos))


def _index_halves(batches):
    for b in batches:
        fp = b["fp"].to_numpy()
        u = fp.view(np.uint64)
        halves = [(u & np.uint64(0xFFFFFFFF)).astype(np.int64), (u >> np.uint64(32)).astype(np.int64)]
        for tag, half in enumerate(halves):
            key = _variants(half, tag, 32)
            yield pa.record_batch([pa.array(key.ravel()), pa.array(np.zeros(key.size, np.int64)),
                                   pa.array(np.repeat(fp, 32))], names=["key", "key2", "fp"])


def _index_quarters(batches):
    for b in batches:
        key, fp = b["u"].to_numpy(), b["v"].to_numpy()
        u = fp.view(np.uint64)
        other = np.where(key >> 40 == 0, u >> np.uint64(32), u & np.uint64(0xFFFFFFFF)).astype(np.int64)
        for tag, quarter in enumerate((other & 0xFFFF, other >> 16)):
            key2 = _variants(quarter, tag, 16) | _SECOND
            yield pa.record_batch([pa.array(np.repeat(key, 16)), pa.array(key2.ravel()),
                                   pa.array(np.repeat(fp, 16))], names=["key", "key2", "fp"])


# ------------------------------------------------------------------ links within runs
def forest(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among different fingerprints."""
    rest, us, vs = fp.view(np.uint64), [], []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= distance
            if near.any():
                hit, rest = rest[near], rest[~near]
                us.append(np.full(len(hit), x))
                vs.append(hit)
                queue.extend(hit)
    if not us:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)


def _links(distance: int, run_limit: int | None):
    """Sorted (key, key2, fp) rows to (deferred, u, v): links, or rows of runs beyond the limit
    as (key, fp)."""
    def out(deferred, u, v):
        return pa.record_batch([pa.array(np.full(len(u), deferred)), pa.array(u), pa.array(v)],
                               names=["deferred", "u", "v"])

    def runs(key, key2, fp):
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (key2[1:] != key2[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(starts, append=len(key))
        # a wiped position at which all members agree gives nothing new, but for position 0
        sub = np.where(key2[starts] != 0, key2[starts], key[starts])
        tag, pos = (sub >> 40) & 1, (sub >> 34) & 63
        # quarters are numbered inside the half that the first key does not hold
        second, upper = key2[starts] != 0, key[starts] >> 40 == 0
        shift = pos + np.where(second, tag * 16 + np.where(upper, 32, 0), tag * 32)
        bit = (fp.view(np.uint64) >> np.repeat(shift, sizes).astype(np.uint64)) & np.uint64(1)
        ones = np.add.reduceat(bit.astype(np.int64), starts)
        go = (sizes > 1) & ((pos == 0) | ((ones > 0) & (ones < sizes)))
        us, vs = [], []
        two = starts[go & (sizes == 2)]
        near = two[np.bitwise_count(fp[two].view(np.uint64) ^ fp[two + 1].view(np.uint64)) <= distance]
        us.append(fp[near])
        vs.append(fp[near + 1])
        for s, n in zip(starts[go & (sizes > 2)], sizes[go & (sizes > 2)], strict=True):
            u, v = forest(fp[s:s + n], distance)
            us.append(u)
            vs.append(v)
        return out(False, np.concatenate(us), np.concatenate(vs))

    def run(batches):
        held: list[np.ndarray] = []  # the last run so far, perhaps not ended
        streaming = None  # the key whose rows are deferred
        for b in batches:
            new = np.stack([b[c].to_numpy() for c in ("key", "key2", "fp")])
            if streaming is not None:
                same = int(np.searchsorted(new[0] != streaming, True))
                yield out(True, new[0, :same], new[2, :same])
                new = new[:, same:]
            if not new.shape[1]:
                continue
            streaming = None
            held.append(new)
            if (held[0][:2, 0] != new[:2, -1]).any():
                rows = np.concatenate(held, axis=1)
                cut = int(np.flatnonzero((rows[0] != rows[0, -1]) | (rows[1] != rows[1, -1]))[-1]) + 1
                yield runs(*rows[:, :cut])
                held = [rows[:, cut:]]
            if run_limit and sum(h.shape[1] for h in held) > run_limit:
                rows = np.concatenate(held, axis=1)
                yield out(True, rows[0], rows[2])
                streaming, held = rows[0, 0], []
        if held:
            yield runs(*np.concatenate(held, axis=1))
    return run


def _meet(index: DataFrame, distance: int, run_limit: int | None) -> DataFrame:
    parts = n_parts(index.sparkSession)
    return (index.repartition(parts, "key", "key2").sortWithinPartitions("key", "key2", "fp")
            .mapInArrow(_links(distance, run_limit), "deferred boolean, u long, v long"))


def links(fps: DataFrame, distance: int = 3, run_limit: int = 1 << 14) -> DataFrame:
    """(u, v): edges that connect all fingerprints of the column ``fp`` (all different) that
    a chain of links of at most ``distance`` <= 3 bits connects."""
    if not 0 <= distance <= 3:
        raise ValueError("two halves find distances up to 3 only")
    schema = "key long, key2 long, fp long"
    first = stored(_meet(fps.select("fp").mapInArrow(_index_halves, schema), distance, run_limit), "simhash-links")
    second = _meet(first.filter("deferred").mapInArrow(_index_quarters, schema), distance, None)
    return first.filter("not deferred").unionByName(second).select("u", "v").distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
               distance: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (the
    smallest doc_id that links reach), kept (one row of each component: the smallest
    (doc_id, fingerprint)), text_key (XXH64 of the text as stored, to tell rows apart).

    Null text counts as empty, texts without words have fingerprint zero and link like any
    other; a null id is larger than any other and a component without ids has a null
    component_id; equal rows are in one component. An empty table gives no rows."""
    on_workers(docs.sparkSession)
    base = id_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    fps = stored(base.mapInArrow(_fingerprints(shingle), "doc_id long, text_key long, fp long"), "simhash")
    nodes = stored(fps.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
                                         .alias("first")), "simhash-nodes")
    roots = components(links(nodes, distance))
    rooted = stored(nodes.join(roots, nodes.fp == roots.node, "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    leads = stored(rooted.groupBy("root").agg(F.min(F.struct("first.none", "first.doc_id", "fp", "first.text_key"))
                                              .alias("lead")), "simhash-leads")
    owner = stored(rooted.join(leads, "root").select("fp", "lead"), "simhash-owners")
    row = fps.join(owner.withColumnRenamed("fp", "node"), F.col("fp") == F.col("node"))
    return row.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("lead.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("lead.doc_id")) & (F.col("fp") == F.col("lead.fp"))
         & (F.col("text_key") == F.col("lead.text_key"))).alias("kept"), "text_key")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                     distance: int = 3) -> DataFrame:
    """``docs`` with one document of each component; columns unchanged."""
    found = near_dedup(docs, id_col, text_col, shingle, distance)
    return keep_rows(docs, found.select(F.col("doc_id").alias("id"), "text_key", "kept"),
                     {"id": F.col(f"`{id_col}`").cast("long"),
                      "text_key": F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))})
