"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Each task reads its documents and turns a block of them into sorted fingerprints, one
   for each different text of the block, cut by value range among the owners. To each
   owner goes one message: the sorted fingerprints as Golomb-Rice coded gaps.
2. An owner merges the messages of all blocks for its range and answers each with a bitmap:
   bit i is set if another block sent the i-th fingerprint too.
3. Blocks read their bitmaps: texts whose bit is set, or that the block itself holds twice,
   are suspects. Suspects' texts are shuffled and compared, byte by byte: a Bloom filter of
   their digests, of fixed size, holds the other texts back where they are read.

A text that holds a third of all rows is one fingerprint in each block, so it is neither a
large message nor a large group. Blocks hold at most ``block_rows`` documents, owners about
``owner_rows`` fingerprints.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kempt.llm.common import FILTER_WORDS, keep_rows, may_be_in, membership, n_parts, on_workers, stored

FP_BITS = 48

_MESSAGE = ("block long, owner int, n int, rice int, code binary, sha binary, "
            "sizes array<int>, members array<long>")
_LOCAL = "sha string, block long, suspect boolean, n int, members array<long>"


def normalised(text: Column) -> Column:
    """Null as empty; every run of space, tab, line feed, vertical tab, form feed and
    carriage return as one space."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


# ------------------------------------------------------------------ Golomb-Rice coding
def rice_encode(values: np.ndarray, low: int, span: int) -> tuple[int, bytes]:
    """Sorted distinct unsigned values in [low, low + span) as (parameter, bytes): gaps
    cut into a unary quotient and ``parameter`` low bits; quotients first, then remainders."""
    n = len(values)
    if n == 0:
        return 0, b""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(low))
    k = max(0, (span // n).bit_length() - 1)
    q = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(q + 1)
    unary = np.zeros(ends[-1], np.uint8)
    unary[ends - 1] = 1
    rest = (gaps & np.uint64((1 << k) - 1)).astype(">u8").view(np.uint8).reshape(n, 8)
    low_bits = np.unpackbits(rest, axis=1)[:, 64 - k:]
    return k, np.packbits(unary).tobytes() + np.packbits(low_bits).tobytes()


def rice_decode(n: int, k: int, code: bytes, low: int) -> np.ndarray:
    if n == 0:
        return np.zeros(0, np.uint64)
    rest_len = (n * k + 7) // 8
    buf = np.frombuffer(code, np.uint8)
    ends = np.flatnonzero(np.unpackbits(buf[:len(buf) - rest_len]))[:n]
    q = np.diff(ends, prepend=-1) - 1
    bits = np.zeros((n, 64), np.uint8)
    if k:
        bits[:, 64 - k:] = np.unpackbits(buf[len(buf) - rest_len:])[:n * k].reshape(n, k)
    rest = np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)
    return np.cumsum((q.astype(np.uint64) << np.uint64(k)) + rest) + np.uint64(low)




# ------------------------------------------------------------------ the three steps
def _messages(block: int, ids: pa.Array, sha: np.ndarray, owners: int) -> pa.RecordBatch:
    """One message for each owner that has fingerprints in this block of documents."""
    raw = np.ascontiguousarray(sha).view("S32").ravel()
    idn = ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
    hashed = np.ascontiguousarray(sha[:, :8]).view(">u8").ravel().astype(np.uint64)
    order = np.lexsort((idn, ids.is_null().to_numpy(zero_copy_only=False), raw, hashed))
    sha, ids = sha[order], ids.take(pa.array(order))
    new = np.ones(len(sha), bool)
    new[1:] = (sha[1:] != sha[:-1]).any(axis=1)
    starts = np.flatnonzero(new)
    sizes = np.diff(starts, append=len(sha))
    groups = sha[starts]
    fp = hashed[order][starts] >> np.uint64(64 - FP_BITS)
    owner = ((fp >> np.uint64(FP_BITS - 24)) * np.uint64(owners)) >> np.uint64(24)
    # ranges are cut on the top 24 bits, so that the product stays inside 64 bits
    out = []
    for o in np.unique(owner).tolist():
        i, j = np.searchsorted(owner, o), np.searchsorted(owner, o, "right")
        a, b = starts[i], starts[j - 1] + sizes[j - 1]
        lo, hi = _cut(o, owners), _cut(o + 1, owners)
        # two texts of one block may share a fingerprint: send it once, keep both groups
        vals = np.unique(fp[i:j])
        k, code = rice_encode(vals, lo, hi - lo)
        out.append((block, o, len(vals), k, code, groups[i:j].tobytes(), sizes[i:j].tolist(),
                    ids.slice(a, b - a)))
    cols = list(zip(*out, strict=True))
    members = pa.ListArray.from_arrays(
        pa.array(np.cumsum([0, *map(len, cols[7])]), pa.int32()), pa.concat_arrays(list(cols[7])))
    return pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                            pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32()),
                            pa.array(cols[4], pa.binary()), pa.array(cols[5], pa.binary()),
                            pa.array(cols[6], pa.list_(pa.int32())), members],
                           names=["block", "owner", "n", "rice", "code", "sha", "sizes", "members"])


def _cut(owner: int, owners: int) -> int:
    """First fingerprint of an owner's range."""
    return -((-owner << 24) // owners) << (FP_BITS - 24)


def _encode(owners: int, block_rows: int):
    def run(batches):
        seq, part = 0, TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []
        rows = 0

        def flush():
            nonlocal seq, held, rows
            t = pa.Table.from_batches(held).combine_chunks()
            sha = np.frombuffer(b"".join(t["sha"].to_pylist()), np.uint8).reshape(-1, 32)
            ids = t["doc_id"].combine_chunks()
            ids = ids if isinstance(ids, pa.Array) else pa.concat_arrays(ids.chunks)
            msg = _messages((part << 24) + seq, ids, sha, owners)
            seq, held, rows = seq + 1, [], 0
            return msg

        for b in batches:
            for i in range(0, b.num_rows, block_rows):
                held.append(b.slice(i, block_rows))
                rows += held[-1].num_rows
                if rows >= block_rows:
                    yield flush()
        if rows:
            yield flush()
    return run


def _answer(owners: int):
    def run(t: pa.Table) -> pa.Table:
        owner = t["owner"][0].as_py()
        low = _cut(owner, owners)
        sets = [rice_decode(n, k, c, low) for n, k, c in
                zip(t["n"].to_pylist(), t["rice"].to_pylist(), t["code"].to_pylist(), strict=True)]
        both = np.concatenate(sets)
        both.sort()
        again = np.unique(both[1:][both[1:] == both[:-1]])
        bitmaps = [np.packbits(np.isin(s, again, assume_unique=True)).tobytes() for s in sets]
        return pa.table({"block": t["block"], "owner": t["owner"], "bits": pa.array(bitmaps, pa.binary())})
    return run


def _read_bitmaps(batches):
    """Rows of one different text of one block each: its members and whether it is a suspect."""
    for b in batches:
        sha_hex, block, suspect, size, members = [], [], [], [], []
        for r in b.to_pylist():
            sha = np.frombuffer(r["sha"], np.uint8).reshape(-1, 32)
            fp = np.ascontiguousarray(sha[:, :8]).view(">u8").ravel().astype(np.uint64) >> np.uint64(64 - FP_BITS)
            first = np.ones(len(fp), bool)
            first[1:] = fp[1:] != fp[:-1]
            nth = np.cumsum(first) - 1
            bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8))[:r["n"]].astype(bool)
            sizes = np.asarray(r["sizes"])
            shared = np.bincount(nth, minlength=r["n"])[nth] > 1
            suspect += (bits[nth] | (sizes > 1) | shared).tolist()
            at = 0
            for s, n in zip(sha, sizes.tolist(), strict=True):
                sha_hex.append(s.tobytes().hex())
                block.append(r["block"])
                size.append(n)
                members.append(r["members"][at:at + n])
                at += n
        yield pa.record_batch([pa.array(sha_hex, pa.string()), pa.array(block, pa.int64()),
                               pa.array(suspect, pa.bool_()), pa.array(size, pa.int32()),
                               pa.array(members, pa.list_(pa.int64()))],
                              names=["sha", "block", "suspect", "n", "members"])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_rows: int = 1 << 17, owner_rows: int = 1 << 21, filter_words: int = FILTER_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after ``normalised``; of equal texts the row of the
    smallest id stays. Null text counts as empty, empty texts are equal to each other, a
    null id is larger than any other. Of several rows with the smallest id one stays. An
    empty table gives no rows. Other columns are ignored. ``filter_words``: 64-bit words of the
    filter that holds back texts that are no suspects; with more suspects than about four for
    each word more and more of the others are shuffled too, which changes no result."""
    spark = docs.sparkSession
    on_workers(spark)
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       normalised(F.col(f"`{text_col}`")).alias("norm"))
    hashed = base.select("doc_id", F.sha2(F.col("norm").cast("binary"), 256).alias("sha"), "norm")
    owners = min(1 << 20, max(n_parts(spark), -(-docs.count() // owner_rows)))
    sent = stored(hashed.select("doc_id", F.unhex("sha").alias("sha"))
                  .mapInArrow(_encode(owners, block_rows), _MESSAGE), "dedup-messages")
    answers = (sent.select("block", "owner", "n", "rice", "code").groupBy("owner")
               .applyInArrow(_answer(owners), "block long, owner int, bits binary"))
    local = stored(sent.drop("rice", "code").join(answers, ["block", "owner"])
                   .select("block", "n", "sha", "sizes", "members", "bits")
                   .mapInArrow(_read_bitmaps, _LOCAL), "dedup-local")

    suspects = local.filter("suspect")
    first = F.struct(F.col("members")[0].isNull().alias("none"), F.col("members")[0].alias("id"),
                     F.col("block").alias("block"))
    wanted = stored(suspects.groupBy("sha").agg(F.min(first).alias("keep"), F.sum("n").cast("long").alias("size")),
                    "dedup-suspects")
    # byte verification: the rows of a suspect are grouped by the text itself, and copies
    # collapse before the shuffle. Texts that pass the filter by chance find no partner below
    digest = F.xxhash64("sha")
    texts = (may_be_in(hashed.select("sha", "norm"), digest, membership(wanted, digest, filter_words), filter_words)
             .groupBy("sha", "norm").agg(F.count(F.lit(1)).alias("n")))
    verified = stored(texts.groupBy("sha").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
                      .join(wanted, "sha")
                      .select("sha", "keep", "size",
                              F.assert_true((F.col("texts") == 1) & (F.col("n") == F.col("size")),
                                            F.lit("different texts share one SHA-256")).alias("_ok")),
                      "dedup-verified").select("sha", "keep", "size")

    alone = local.filter(~F.col("suspect")).select(
        F.col("members")[0].alias("doc_id"), F.col("members")[0].alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    copies = (suspects.join(verified, "sha")
              .select("sha", "keep", "size", "block", F.posexplode("members").alias("pos", "doc_id"))
              .select("doc_id", F.col("keep.id").alias("keep_id"), F.col("size").alias("group_size"),
                      ((F.col("block") == F.col("keep.block")) & (F.col("pos") == 0)).alias("kept"),
                      F.col("sha").alias("text_sha256")))
    return alone.unionByName(copies)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` does not keep; columns unchanged."""
    found = exact_dedup(docs, id_col, text_col)
    return keep_rows(docs, found.select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"), "kept"),
                     {"id": F.col(f"`{id_col}`").cast("long"),
                      "sha": F.sha2(normalised(F.col(f"`{text_col}`")).cast("binary"), 256)})
