"""Packing documents into fixed windows of token ids by non-negative least squares.

1. Each document's ids and its end id are cut into full windows and one shorter rest.
2. Only the histogram of rest lengths (window - 1 numbers) comes to the driver. Shallow
   combinations of lengths that fill a window exactly are enumerated: all pairs, and triples
   of which two are among the most frequent lengths. Non-negative least squares finds how
   often to repeat each; the counts are rounded and held to what the histogram has.
3. What rounding leaves is packed greedily, largest length first, then the largest that
   still fits; combinations that fill a window exactly are repeated as often as the
   histogram allows. The few pieces that remain are laid end to end and cut at window
   borders, the last, partial window at powers of two, so nothing needs padding.
4. The plan says for each length which ranks go where. A piece's rank among those of its
   length is its place in its block plus the counts of the blocks before, so no task
   gathers the pieces of a length, however frequent it is.

The plan's size depends on the window alone.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kempt.llm.common import id_text, on_workers, slices, small_batches, stored
from kempt.llm.tokens import encoder, vocabulary

_PIECES = ("block long, row long, doc_id long, start long, length int, nth long, ids_crc32 long, "
           "doc_tokens long, ids binary")
#: Bytes of a row group of stored pieces.
_ROW_GROUP = 8 << 20


def crc(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


# ------------------------------------------------------------------ the plan
def combinations(hist: np.ndarray, window: int, frequent: int = 64) -> np.ndarray:
    """(n, 3) lengths that add up to ``window``, all of them in the histogram; 0 for none."""
    have = np.flatnonzero(hist[:window])
    have = have[have > 0]
    present = np.zeros(window + 1, bool)
    present[have] = True
    pairs = have[(have <= window - have) & present[window - have]]
    out = [np.stack([window - pairs, pairs, 0 * pairs], axis=1)]
    top = have[np.argsort(-hist[have], kind="stable")][:frequent]
    a, b = np.meshgrid(top, top, indexing="ij")
    a, b = a[np.triu_indices(len(top))], b[np.triu_indices(len(top))]
    c = window - a - b
    ok = (c > 0) & present[np.clip(c, 0, window)]
    out.append(np.sort(np.stack([a, b, c], axis=1)[ok], axis=1)[:, ::-1])
    return np.unique(np.concatenate(out), axis=0)


def nnls(combos: np.ndarray, hist: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - hist|, A the use of lengths by combination
    (accelerated projected gradient; each column of A has at most three entries)."""
    if not len(combos):
        return np.zeros(0)
    size = len(hist)
    used = (combos > 0).astype(float)
    target = hist.astype(float).copy()
    target[0] = 0

    def forward(x):
        return np.bincount(combos.ravel(), (x[:, None] * used).ravel(), minlength=size)

    def back(r):
        return (r[combos] * used).sum(axis=1)

    v = np.ones(len(combos))
    for _ in range(30):  # largest eigenvalue of A'A
        v = back(forward(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - back(forward(y) - target) / (1.02 * norm))
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        y = new + (before - 1) / t * (new - x)
        x = new
    return x


def plan(hist: np.ndarray, window: int) -> dict:
    """Where the pieces of each length go: rows (length, first rank, count, first sequence,
    offset), and the stream of pieces that are laid end to end."""
    left = hist.astype(np.int64).copy()
    left[0] = 0
    taken = np.zeros(window + 1, np.int64)
    rows: list[tuple[int, int, int, int, int]] = []
    sequence = 0

    def place(lengths: list[int], times: int) -> None:
        nonlocal sequence
        offset = 0
        for n in lengths:
            rows.append((n, int(taken[n]), times, sequence, offset))
            taken[n] += times
            left[n] -= times
            offset += n
        sequence += times

    def most(lengths: list[int]) -> int:
        return min(int(left[n]) // lengths.count(n) for n in set(lengths))

    if left[window]:
        place([window], int(left[window]))
    combos = combinations(left, window)
    x = nnls(combos, left)
    for i in np.argsort(-x, kind="stable"):
        lengths = [int(n) for n in combos[i] if n]
        if (times := min(int(x[i] + 0.5), most(lengths))) > 0:
            place(lengths, times)
    aside = np.zeros(window + 1, bool)
    while (big := np.flatnonzero((left > 0) & ~aside)).size:
        first = int(big[-1])
        lengths, gap, spare = [first], window - first, left.copy()
        spare[first] -= 1
        while gap:
            fit = np.flatnonzero(spare[:gap + 1] > 0)
            if not fit.size:
                break
            n = int(fit[-1])
            lengths.append(n)
            spare[n] -= 1
            gap -= n
        if gap:
            aside[first] = True
        else:
            place(lengths, most(lengths))
    # the stream: position of the first piece of each length
    lengths = np.flatnonzero(left > 0)[::-1]
    total = int((left[lengths] * lengths).sum())
    at = np.concatenate([[0], np.cumsum(left[lengths] * lengths)[:-1]]) if lengths.size else np.zeros(0, np.int64)
    tail, cuts, rest = total - total % window, [], total % window
    for b in range(window.bit_length() - 1, -1, -1):
        if rest >> b & 1:
            cuts.append(tail)
            tail += 1 << b
    table = sorted(rows) + [(int(n), int(taken[n]), -1, int(p), 0) for n, p in zip(lengths, at, strict=True)]
    return {"window": window, "rows": np.array(sorted(table), np.int64).reshape(-1, 5), "stream": sequence,
            "full": total - total % window, "cuts": np.array(cuts, np.int64)}


def place(p: dict, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
    """(piece, skip, length, sequence, offset) of the parts of pieces, in order; skip is the
    number of the piece's ids before the part."""
    rows, window = p["rows"], p["window"]
    i = np.searchsorted(rows[:, 0] << 40 | rows[:, 1], length.astype(np.int64) << 40 | rank, "right") - 1
    _, first, count, seq, offset = rows[i].T
    piece, skip = np.arange(len(length)), np.zeros(len(length), np.int64)
    streamed = count < 0
    seq, offset, part = np.where(streamed, 0, seq + rank - first), offset.copy(), length.astype(np.int64)
    out = [tuple(a[~streamed] for a in (piece, skip, part, seq, offset))]
    # the pieces laid end to end: cut at borders until nothing is left
    k = np.flatnonzero(streamed)
    pos, todo, done = rows[i][k, 3] + (rank[k] - first[k]) * length[k], part[k], skip[k]
    while k.size:
        whole = pos < p["full"]
        c = np.searchsorted(p["cuts"], pos, "right")
        begin = np.where(whole, pos // window * window, p["cuts"][np.maximum(c - 1, 0)] if p["cuts"].size else 0)
        ends = np.append(p["cuts"][1:], np.iinfo(np.int64).max)
        end = np.where(whole, begin + window, ends[np.maximum(c - 1, 0)])
        take = np.minimum(todo, end - pos)
        s = p["stream"] + np.where(whole, pos // window, p["full"] // window + c - 1)
        out.append((k, done, take, s, pos - begin))
        k, pos, done, todo = k[take < todo], (pos + take)[take < todo], (done + take)[take < todo], (todo - take)[take < todo]
    return tuple(np.concatenate(a) for a in zip(*out, strict=True))


# ------------------------------------------------------------------ Spark
def _cut(path: str, end_id: int, window: int, dtype: str):
    def run(batches):
        block, row, seen = TaskContext.get().partitionId(), 0, {}
        encode, end = encoder(path, dtype), np.array([end_id], dtype)
        for b in slices(batches):
            out = []
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                ids = np.concatenate([np.frombuffer(encode(text), dtype), end])
                for start in range(0, len(ids), window):
                    piece = ids[start:start + window]
                    nth = seen.get(len(piece), 0)
                    seen[len(piece)] = nth + 1
                    out.append((block, row, doc_id, start, len(piece), nth, crc(piece), len(ids), piece.tobytes()))
                    row += 1
            if out:
                cols = list(zip(*out, strict=True))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                         pa.int64(), pa.binary()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                      names=[c.split()[0] for c in _PIECES.split(", ")])
    return run


def _placed(p: dict):
    def run(batches):
        for b in batches:
            piece, skip, part, seq, offset = place(p, b["length"].to_numpy(), b["rank"].to_numpy())
            old = b.take(pa.array(piece))
            whole = part == old["length"].to_numpy()
            yield pa.record_batch(
                [old["block"], old["row"], old["doc_id"], pa.array(old["start"].to_numpy() + skip), pa.array(skip),
                 pa.array(part), pa.array(old["ids_crc32"].to_numpy(), mask=~whole), old["doc_tokens"], pa.array(seq),
                 pa.array(offset)],
                names=["block", "row", "doc_id", "start", "skip", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return run


def _part_crc(dtype: str):
    def run(batches):
        for b in batches:
            ids = [np.frombuffer(x, dtype)[s:s + n] for x, s, n in
                   zip(b["ids"].to_pylist(), b["skip"].to_pylist(), b["length"].to_pylist(), strict=True)]
            yield b.drop_columns(["ids"]).set_column(
                b.schema.get_field_index("ids_crc32"), "ids_crc32", pa.array([crc(x) for x in ids], pa.int64()))
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None, end_id: int = 1,
         window: int = 2048, dtype: str = "<u2", keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ids, ``dtype`` bytes, with ``keep_ids``).

    ``vocab``: path of a tokenizers file. Each row of ``docs`` is a document of its own,
    also if its id is null or repeated; null text counts as empty and gives the end id
    alone. Every id lies in exactly one piece, pieces of a sequence lie without gaps from
    offset 0, sequences are numbered from 0 without gaps. All sequences have ``window`` ids but
    a few at the end, whose lengths are different powers of two. No rows: no pieces."""
    spark = docs.sparkSession
    on_workers(spark)
    cut = id_text(docs, id_col, text_col).mapInArrow(
        _cut(vocab or vocabulary("byte_bpe_50k.json"), end_id, window, dtype), _PIECES)
    with small_batches(spark):  # a task holds a row group of ids until it is full
        pieces = stored(cut, "pieces", **{"parquet.block.size": str(_ROW_GROUP)})
    counts = stored(pieces.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    hist = np.zeros(window + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``window`` rows
        hist[r["length"]] = r["n"]
    before = counts.select("block", "length", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    # one row per block: pieces of each length in the blocks before it
    before = stored(before.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("length", "before"))).alias("before")), "piece-ranks")
    ranked = (pieces.drop("ids").join(before, "block")
              .select("block", "row", "doc_id", "start", "length", (F.col("before")[F.col("length")] + F.col("nth")).alias("rank"),
                      "ids_crc32", "doc_tokens"))
    placed = stored(ranked.mapInArrow(_placed(plan(hist, window)),
                                      "block long, row long, doc_id long, start long, skip long, length long, "
                                      "ids_crc32 long, doc_tokens long, sequence_id long, offset long"), "placed")
    # the cut pieces are written by themselves, so that Spark knows how few they are, and
    # rebalanced, so that a few rows do not take a file for each task
    parts = stored(placed.filter("ids_crc32 IS NULL").hint("rebalance"), "cut-pieces")
    ids = pieces.select("block", "row", "ids")
    cut = parts.join(ids, ["block", "row"])
    with small_batches(spark):
        cut = stored(cut.mapInArrow(_part_crc(dtype), cut.drop("ids").schema).hint("rebalance"), "cut-crc")
    out = placed.filter("ids_crc32 IS NOT NULL").unionByName(cut.select(*placed.columns))
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if keep_ids:
        width = np.dtype(dtype).itemsize
        out = out.join(ids, ["block", "row"]).withColumn(
            "ids", F.expr(f"substring(ids, cast(skip * {width} + 1 as int), cast(length * {width} as int))"))
        cols.append("ids")
    return out.select(*cols)


def sequences(pieces: DataFrame) -> DataFrame:
    """Packed sequences of pieces with ids: sequence_id, ids (bytes), doc_ids, lengths. A
    sequence has at most one window of ids, which bounds each group."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    return (pieces.groupBy("sequence_id").agg(rows.alias("p"))
            .select("sequence_id", F.expr("aggregate(p.ids, cast('' as binary), (a, x) -> concat(a, x))").alias("ids"),
                    F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths")))
