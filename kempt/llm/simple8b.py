"""Token ids in Simple-8b words, as a folder of blocks.

A 64-bit word holds a 4-bit selector and as many ids as fit: the selector names how many
(1 to 60) and with how many bits each. 120 zeros in a row take one word; a value of over 60
bits takes an escape word and a word of its own. A frame of up to ``FRAME`` ids is coded by
itself, and a block lists where its frames begin, so frames can be read on their own and a
whole block can be decoded with a few array operations for each selector.

File format: Parquet files, one row for each block, in ascending document order: ``part``
and ``block`` (order), ``before`` (ids in earlier blocks of the part), ``doc_ids``, ``sizes`` (ids
of each document, with its end id), ``n_ids``, ``frames`` (index of each frame's first word) and
``words`` (little endian). Documents are not split between blocks.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kempt.llm.common import on_workers, prefix_sums, slices
from kempt.llm.tokens import in_order, vocabulary

# Ids in a word and bits of each, by selector; 0 is the escape, 1 a run of zeros.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

FRAME = 1 << 16
_WIDTH = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)
_BLOCK = ("part int, block int, before long, doc_ids array<long>, sizes array<int>, n_ids int, frames array<int>, "
          "words binary")


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs."""
    if len(ids) and ids.max() < len(_WIDTH):
        return _WIDTH[ids]
    out, rest = np.zeros(len(ids), np.uint8), ids.copy()
    while rest.any():
        out += rest > 0
        rest >>= np.uint64(1)
    return out


def encode(ids: np.ndarray) -> np.ndarray:
    """One frame: unsigned 64-bit ids to words."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64)
    width = _widths(ids)
    # the last word may be filled up with zeros, which the count of ids cuts off again
    padded = np.concatenate([width, np.zeros(COUNTS.max(), np.uint8)])
    best = np.zeros(n, np.uint8)  # selector by position; the escape if nothing fits
    widest, span = padded, 1
    for s in range(15, 0, -1):  # more ids a word come later and win
        while span < COUNTS[s]:
            step = min(span, COUNTS[s] - span)
            widest, span = np.maximum(widest[:len(widest) - step], widest[step:]), span + step
        fits = widest[:n] <= BITS[s]
        best[fits] = s
    step = COUNTS[best].tolist()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i += step[i]
    starts = np.array(starts)
    selector = best[starts]
    at = np.arange(len(starts)) + np.concatenate([[0], np.cumsum(selector == 0)[:-1]])  # an escape takes two words
    words = np.zeros(len(starts) + int((selector == 0).sum()), np.uint64)
    wide = np.concatenate([ids, np.zeros(COUNTS.max(), np.uint64)])
    for s in np.unique(selector):
        k = np.flatnonzero(selector == s)
        if s == 0:
            words[at[k] + 1] = ids[starts[k]]
            continue
        group = wide[starts[k][:, None] + np.arange(COUNTS[s])]
        shift = (np.arange(COUNTS[s]) * BITS[s]).astype(np.uint64)
        words[at[k]] = np.bitwise_or.reduce(group << shift, axis=1) if BITS[s] else 0
        words[at[k]] |= np.uint64(s) << np.uint64(60)
    return words


def decode(words: np.ndarray, frames: np.ndarray, n_ids: int) -> np.ndarray:
    """All ids of a block at once. ``frames``: first word of each frame; all frames but the
    last hold ``FRAME`` ids."""
    if not n_ids:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    maybe = np.flatnonzero(selector == 0)
    if len(maybe):  # a word after an escape is a value, which may look like an escape itself
        last = -2
        for i in maybe.tolist():
            if i - 1 != last:
                last = i
                if i + 1 < len(words):
                    raw[i + 1] = True
    counts = np.where(raw, 0, COUNTS[selector])
    ends = np.cumsum(counts)
    starts = ends - counts
    first = starts[frames]  # ids before each frame as counted with the fill of last words
    frame = np.searchsorted(frames, np.arange(len(words)), "right") - 1
    sizes = np.minimum(FRAME, n_ids - np.arange(len(frames)) * FRAME)
    starts = starts - first[frame] + frame * FRAME
    out = np.zeros(n_ids + COUNTS.max(), np.uint64)
    limit = (np.arange(len(frames)) * FRAME + sizes)[frame]
    for s in np.unique(selector[~raw]):
        k = np.flatnonzero((selector == s) & ~raw)
        if s == 0:
            out[starts[k]] = words[k + 1]
        elif s > 1:
            shift = (np.arange(COUNTS[s]) * BITS[s]).astype(np.uint64)
            values = (words[k][:, None] >> shift) & np.uint64((1 << int(BITS[s])) - 1)
            to = starts[k][:, None] + np.arange(COUNTS[s])
            keep = to < limit[k][:, None]
            out[to[keep]] = values[keep]
    return out[:n_ids]


# ------------------------------------------------------------------ files
def encode_block(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    parts = [encode(ids[i:i + FRAME]) for i in range(0, len(ids), FRAME)]
    frames = np.cumsum([0, *map(len, parts)])[:-1]
    return frames, np.concatenate(parts).astype("<u8").tobytes() if parts else b""


def _write(end_id: int, block_ids: int, dtype: str):
    def run(batches):
        part, block, before = TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], dtype).tobytes()
        doc_ids, sizes, held, n = [], [], [], 0

        def flush():
            nonlocal block, before, doc_ids, sizes, held, n
            ids = np.frombuffer(b"".join(held), dtype).astype(np.uint64)
            frames, words = encode_block(ids)
            row = pa.record_batch([pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()),
                                   pa.array([doc_ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())),
                                   pa.array([len(ids)], pa.int32()), pa.array([frames], pa.list_(pa.int32())),
                                   pa.array([words], pa.binary())], names=[c.split()[0] for c in _BLOCK.split(", ")])
            block, before, doc_ids, sizes, held, n = block + 1, before + len(ids), [], [], [], 0
            return row

        for b in slices(batches):
            for doc_id, raw in zip(b["doc_id"].to_pylist(), b["ids"].to_pylist(), strict=True):
                held += [raw, end]
                doc_ids.append(doc_id)
                sizes.append(len(raw) // np.dtype(dtype).itemsize + 1)
                n += sizes[-1]
                if n >= block_ids:
                    yield flush()
        if doc_ids:
            yield flush()
    return run


def write_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None,
              end_id: int = 2, dtype: str = "<u2", block_ids: int = 1 << 18) -> None:
    """Write the ids of all documents to ``path`` in ascending document id (null ids first;
    rows of one id in the order of a hash of their texts, then of their ids).

    ``vocab``: path of a tokenizers file; its special tokens count where their strings occur in a
    text, as the library has it. Null text counts as empty; every document ends with ``end_id``.
    An empty table gives an empty folder. Only ids are shuffled."""
    on_workers(docs.sparkSession)
    ordered = in_order(docs, vocab or vocabulary("word_bpe_49k.json"), dtype, False, id_col, text_col)
    (ordered.mapInArrow(_write(end_id, block_ids, dtype), _BLOCK)
     .write.mode("overwrite").option("compression", "none").parquet(path))


def _documents(batches):
    names = ["part", "doc_id", "start", "n_tokens", "ids_crc32", "ids"]
    for b in batches:
        for r in b.to_pylist():
            ids = decode(np.frombuffer(r["words"], "<u8"), np.array(r["frames"], np.int64), r["n_ids"]).astype("<u4").tobytes()
            ends = np.cumsum(r["sizes"]).tolist()
            docs = [ids[4 * a:4 * z] for a, z in zip([0, *ends[:-1]], ends, strict=True)]
            yield pa.record_batch(
                [pa.array([r["part"]] * len(docs), pa.int32()), pa.array(r["doc_ids"], pa.int64()),
                 pa.array([r["before"] + a for a in [0, *ends[:-1]]], pa.int64()), pa.array(r["sizes"], pa.int64()),
                 pa.array([zlib.crc32(d) for d in docs], pa.int64()), pa.array(docs, pa.binary())], names=names)


def _digests(batches):
    for b in _documents(batches):
        yield b.drop_columns(["ids"])


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document of a written folder: doc_id, start (ids before it in the whole
    folder), n_tokens, ids_crc32, and ids (little-endian unsigned 32-bit bytes) on request."""
    on_workers(spark)
    blocks = spark.read.schema(_BLOCK).parquet(path)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").cast("long").alias("n"))
    top = totals.agg(F.max("part")).first()[0]
    parts = spark.range((top if top is not None else -1) + 1).select(F.col("id").cast("int").alias("part"))
    totals = parts.join(totals, "part", "left").select("part", F.coalesce("n", F.lit(0)).alias("n"))
    base = prefix_sums(totals, "part", ["n"]).select("part", "n_before")
    schema = "part int, doc_id long, start long, n_tokens long, ids_crc32 long"
    docs = blocks.mapInArrow(_documents, schema + ", ids binary") if with_ids else blocks.mapInArrow(_digests, schema)
    out = docs.join(base, "part").withColumn("start", F.col("start") + F.col("n_before"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids)
