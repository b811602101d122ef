"""Repeated byte strings by suffix arrays, and their removal.

Every string of ``length`` bytes that starts at two places of the corpus is removed at all of
them. Sorting all suffixes of a large corpus in one array is out of reach, so the strings
are first dealt into groups that no repeat can leave:

1. The anchor of a string is the leftmost smallest hash among its ``gram``-byte pieces. Equal
   strings have equal anchors at the same place. The strings that share an anchor at a
   position of a text start in one interval; a text has about two anchors for each
   ``length - gram`` bytes. Anchors that occur once in the corpus end here.
2. For the others the bytes around the anchor, from the first string of its interval to the
   end of the last, are a context. Equal contexts are kept once, with a digest.
3. Contexts go to tasks by anchor. A task concatenates contexts up to ``chunk`` bytes, builds
   the suffix array by two-stage sorting, and compares each suffix with its neighbour.
4. Repeated starts go back to the texts, whose remaining bytes are digested.

Two-stage sorting: a suffix smaller than its successor is sorted directly; every other one
is larger than its successor, so its place follows from the successor's by a scan of the
buckets of first bytes in ascending order. Suffixes are compared over ``length`` bytes.

An anchor that occurs more than ``hot`` times is split: its strings are cut by their distance
from the anchor into cells of ``CELL`` starts, and what all strings of a cell have in common
(all but ``CELL`` - 1 of their bytes) deals them into finer groups. Should a group still have
more than ``crowd`` different contexts, its strings are grouped one by one, by their bytes.
Of equal whole texts only the first that a task meets sends contexts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.llm.common import id_text, n_parts, on_workers, stored

_STEP = 0xD6E8FEB86659FD93  # odd, so that powers never vanish
CELL = 16
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


# ------------------------------------------------------------------ anchors
def gram_hashes(raw: bytes, gram: int) -> np.ndarray:
    """64-bit hash of each ``gram``-byte piece: polynomials of pieces twice as long come from
    two shorter ones, by the binary digits of ``gram``."""
    one = np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)
    one *= _MIX[0]
    one ^= one >> np.uint64(29)
    width, h = 1, one
    for digit in f"{gram:b}"[1:]:
        h = h[:-width] * np.uint64(pow(_STEP, width, 1 << 64)) + h[width:]
        width *= 2
        if digit == "1":
            h = h[:-1] * np.uint64(_STEP) + one[width:width + len(h) - 1]
            width += 1
    h = (h ^ (h >> np.uint64(32))) * _MIX[1]
    return h ^ (h >> np.uint64(29))


def anchors(raw: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first start, last start) of the anchors of a text of at least ``length`` bytes, in
    order; the intervals of starts cover the text's strings exactly once."""
    h, width = gram_hashes(raw, gram), length - gram + 1
    low, span = h, 1
    while span < width:
        step = min(span, width - span)
        low, span = np.minimum(low[:len(low) - step], low[step:]), span + step
    # the smallest hash of a window: where it changes, or falls out of the window, another
    # position becomes the anchor
    first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    same = np.diff(first, append=len(low)) > 1
    if same.any():
        # within a stretch of one value, equal hashes may follow each other
        cuts = [first]
        for a, z in zip(first[same].tolist(), np.append(first, len(low))[1:][same].tolist(), strict=True):
            at = a + np.flatnonzero(h[a:z - 1 + width] == low[a])
            if len(at) > 1:
                cuts.append(at[:-1][at[:-1] + 1 < z] + 1)
        if len(cuts) > 1:
            first = np.unique(np.concatenate(cuts))
    return low[first].view(np.int64), first, np.append(first[1:] - 1, len(low) - 1)


def _anchor_rows(length: int, gram: int):
    def run(batches):
        for b in batches:
            hashes, counts, routes = [], [], []
            for route, text in zip(b["route"].to_pylist(), b["text"], strict=True):
                raw = text.as_buffer()
                if len(raw) >= length:
                    h, n = np.unique(anchors(raw, length, gram)[0], return_counts=True)
                    hashes.append(h)
                    counts.append(n)
                    routes.append(np.full(len(h), route, np.int64))
            if hashes:
                yield pa.record_batch([pa.array(np.concatenate(hashes)), pa.array(np.concatenate(routes)),
                                       pa.array(np.concatenate(counts))], names=["hash", "route", "n"])
    return run


def _compress(batches):
    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        packed = [z.compress(x.as_buffer()) for x in b["text"]]
        yield b.drop_columns(["text"]).append_column("packed", pa.array(packed, pa.binary()))


def cells(raw: bytes, first: int, last: int, length: int, gram: int) -> list[tuple[int, int, int]]:
    """(hash, first start, last start) of the cells of an anchor's strings. Cells are counted
    from the anchor, so equal strings are in cells of equal hash."""
    anchor = first + int(gram_hashes(raw[first:first + length], gram).argmin())
    out = []
    for c in range((anchor - last) // CELL, (anchor - first) // CELL + 1):
        common = raw[anchor - c * CELL:anchor - (c + 1) * CELL + 1 + length]
        out.append((xxhash.xxh64_intdigest(common, c + 1) - (1 << 63), max(first, anchor - (c + 1) * CELL + 1),
                    min(last, anchor - c * CELL)))
    return out


def _contexts(length: int, gram: int):
    """Texts with the anchors that repeat to their contexts; bytes only where this task has
    not sent them before (the set of sent digests is emptied when it grows large). A text
    that the task has met before repeats as a whole: a row without a hash."""
    def run(batches):
        unzip, sent, met = zstandard.ZstdDecompressor(), set(), set()
        for b in batches:
            out = []
            for key, packed, wanted, many in zip(b["key"].to_pylist(), b["packed"], b["hashes"], b["many"], strict=True):
                raw = unzip.decompress(packed.as_buffer())
                if len(raw) < length:
                    continue
                if key in met:
                    out.append((None, None, None, key, [0], len(raw) - length))
                    continue
                met.add(key)
                h, first, last = anchors(raw, length, gram)
                pieces = []
                split = np.isin(h, many.values.to_numpy())
                for i in np.flatnonzero(np.isin(h, wanted.values.to_numpy())).tolist():
                    if split[i]:
                        pieces += cells(raw, int(first[i]), int(last[i]), length, gram)
                    else:
                        pieces.append((int(h[i]), int(first[i]), int(last[i])))
                mine: dict[bytes, list] = {}
                for hash_, a, z in pieces:
                    context = raw[a:z + length]
                    cid = hashlib.md5(context, usedforsecurity=False).digest()
                    if cid in mine:
                        mine[cid][1].append(a)
                    else:
                        mine[cid] = [context, [a], hash_]
                for cid, (context, starts, hash_) in mine.items():
                    out.append((hash_, cid, None if cid in sent else context, key, starts, len(context) - length))
                    if len(sent) > 1 << 18:
                        sent.clear()
                    sent.add(cid)
            if out:
                cols = list(zip(*out, strict=True))
                types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.int32()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                      names=["hash", "cid", "context", "key", "starts", "last"])
    return run


# ------------------------------------------------------------------ two-stage suffix sorting
def two_stage(text: bytes, ends: np.ndarray, length: int) -> np.ndarray:
    """Sorted starts of all strings of ``length`` bytes inside the parts of ``text`` that end at
    ``ends``. Equal strings are neighbours."""
    s = np.frombuffer(text, np.uint8).astype(np.int16) + 1
    n = len(s)
    part_end = np.repeat(ends, np.diff(ends, prepend=0))
    valid = np.arange(n) + length <= part_end
    # a suffix is small if it is smaller than its successor; in a run of one byte the byte
    # after the run decides, and a part's end counts as smaller than any byte
    follow = np.append(s[1:], 0)
    follow[ends - 1] = 0
    differs = np.append(np.flatnonzero(follow != s), n - 1)
    decisive = differs[np.searchsorted(differs, np.arange(n))]
    small = follow[decisive] > s[decisive]
    # what has to be sorted: the strings, and what follows them until a small suffix
    need = valid.copy()
    next_small = np.flatnonzero(small)
    reach = np.searchsorted(next_small, np.flatnonzero(valid))
    stop = np.minimum(np.append(next_small, n)[reach], part_end[valid] - 1)
    last = np.zeros(n + 1, np.int64)
    np.add.at(last, np.flatnonzero(valid), 1)
    np.add.at(last, stop + 1, -1)
    need |= np.cumsum(last[:n]) > 0

    chars = text.decode("latin-1")
    direct = np.flatnonzero(need & small)
    stops = np.minimum(direct + length, part_end[direct]).tolist()
    keys = [chars[i:z] for i, z in zip(direct.tolist(), stops, strict=True)]
    direct = direct[sorted(range(len(keys)), key=keys.__getitem__)]
    by_byte = np.split(direct, np.searchsorted(s[direct], np.arange(2, 258)))

    waiting: dict[int, list[np.ndarray]] = {}
    # the last byte of a part is larger than the empty suffix after it
    tails = ends - 1
    for c in np.unique(s[tails[need[tails]]]).tolist():
        waiting[c] = [tails[need[tails] & (s[tails] == c)]]
    out = []
    for c in range(1, 257):
        run = waiting.pop(c, [])
        head = run[-1:] and np.concatenate(run)
        group = [head] if len(head) else []
        while len(head):  # predecessors with the same byte follow in the same order
            before = head - 1
            ok = (before >= 0) & need[before] & (s[before] == c) & (follow[before] == c) & ~small[before]
            head = before[ok]
            if len(head):
                group.append(head)
        group.append(by_byte[c - 1])
        bucket = np.concatenate(group) if group else np.zeros(0, np.int64)
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket - 1
        ok = (before >= 0) & need[before] & (follow[before] == c) & (s[before] > c)
        before = before[ok]
        if len(before):
            order = np.argsort(s[before], kind="stable")
            before = before[order]
            byte = s[before]
            cuts = np.flatnonzero(np.diff(byte)) + 1
            for chunk in np.split(before, cuts):
                waiting.setdefault(int(s[chunk[0]]), []).append(chunk)
    array = np.concatenate(out) if out else np.zeros(0, np.int64)
    return array[valid[array]]


def repeated(text: bytes, ends: np.ndarray, length: int) -> np.ndarray:
    """Starts, in order, of the strings that the parts of ``text`` hold more than once."""
    array = two_stage(text, ends, length).tolist()
    chars = text.decode("latin-1")
    common = np.array([chars[a:a + length] == chars[b:b + length] for a, b in zip(array, array[1:], strict=False)], bool)
    hit = np.zeros(len(array), bool)
    hit[:-1] |= common
    hit[1:] |= common
    return np.sort(np.array(array, np.int64)[hit])


def _sort_contexts(length: int, chunk: int):
    """Rows (hash, cid, context) sorted by hash to (cid, first, last): repeated starts."""
    def flush(cids, contexts):
        ends = np.cumsum([len(c) for c in contexts])
        starts = repeated(b"".join(contexts), ends, length)
        if not len(starts):
            return
        begin = np.flatnonzero(np.concatenate([[True], np.diff(starts) != 1]))
        part = np.searchsorted(ends, starts, "right")
        begin = np.union1d(begin, np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])))
        stop = np.append(begin[1:], len(starts)) - 1
        base = np.concatenate([[0], ends[:-1]])[part]
        yield pa.record_batch([pa.array([cids[p] for p in part[begin].tolist()], pa.binary()),
                               pa.array((starts - base)[begin].astype(np.int32)),
                               pa.array((starts - base)[stop].astype(np.int32))], names=["cid", "first", "last"])

    def run(batches):
        cids, contexts, size, seen, last = [], [], 0, set(), None
        for b in batches:
            for h, cid, context in zip(b["hash"].to_pylist(), b["cid"].to_pylist(), b["context"].to_pylist(), strict=True):
                if h != last:
                    if size >= chunk:
                        yield from flush(cids, contexts)
                        cids, contexts, size = [], [], 0
                    last, seen = h, set()
                if cid not in seen:
                    seen.add(cid)
                    cids.append(cid)
                    contexts.append(context)
                    size += len(context)
        if contexts:
            yield from flush(cids, contexts)
    return run


def _strings(length: int):
    """Every string of the contexts of crowded groups by itself."""
    def run(batches):
        for b in batches:
            for cid, context in zip(b["cid"].to_pylist(), b["context"].to_pylist(), strict=True):
                n = len(context) - length + 1
                yield pa.record_batch([pa.array([cid] * n, pa.binary()), pa.array(np.arange(n, dtype=np.int32)),
                                       pa.array([context[i:i + length] for i in range(n)], pa.binary())],
                                      names=["cid", "first", "string"])
    return run


# ------------------------------------------------------------------ removal
def _removed(length: int):
    def run(batches):
        unzip = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for packed, spans in zip(b["packed"], b["spans"].to_pylist(), strict=True):
                raw = unzip.decompress(packed.as_buffer())
                kept, at, removed, runs = [], 0, 0, 0
                until = -1
                for first, last in sorted((s["first"], s["last"]) for s in spans or []):
                    if first > until:
                        kept.append(raw[at:first])
                        runs += 1
                        removed += last + length - first
                    elif last + length > until:
                        removed += last + length - until
                    until = max(until, last + length)
                    at = until
                kept.append(raw[at:])
                out.append((len(raw), removed, runs, b"".join(kept)))
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.record_batch([b["doc_id"], *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.binary())],
                                  names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, gram: int = 64,
                   chunk: int = 1 << 20, hot: int = 2048, crowd: int = 1 << 15) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs)
    and kept (the remaining bytes of the UTF-8 text).

    Removed is each byte of a string of ``length`` bytes that also starts elsewhere, in the
    same or another row; overlapping strings count; strings are judged on the input. Null
    text counts as empty; a text of fewer bytes stays whole. Rows that repeat a whole text of
    at least ``length`` bytes lose all of it. An empty table gives no rows."""
    spark = docs.sparkSession
    on_workers(spark)
    base = (id_text(docs, id_col, text_col)
            .select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("route"),
                    F.unhex(F.md5(F.col("text").cast("binary"))).alias("key")))
    found = stored(base.select("route", "text").mapInArrow(_anchor_rows(length, gram), "hash long, route long, n long"),
                   "anchors")
    again = stored(found.groupBy("hash").agg(F.sum("n").alias("n")).filter("n > 1")
                   .select("hash", F.when(F.col("n") > hot, F.col("hash")).alias("many")), "anchors-again")
    # ``route`` only leads anchors back to texts: texts that share it by chance look for a few
    # anchors too many
    wanted = stored(found.select("hash", "route").join(again.hint("merge"), "hash").groupBy("route")
                    .agg(F.collect_set("hash").alias("hashes"), F.collect_set("many").alias("many")), "anchors-wanted")
    texts = base.mapInArrow(_compress, "doc_id long, route long, key binary, packed binary")
    made = stored(texts.join(wanted.hint("merge"), "route").select("key", "packed", "hashes", "many").mapInArrow(
        _contexts(length, gram), "hash long, cid binary, context binary, key binary, starts array<int>, last int"), "contexts")

    occ = made.filter("hash IS NOT NULL")
    # contexts met more than once repeat as a whole
    whole = (occ.groupBy("cid").agg(F.sum(F.size("starts")).alias("n"), F.max("last").alias("last")).filter("n > 1")
             .select("cid", F.lit(0).alias("first"), "last"))
    sent = occ.filter("context IS NOT NULL").select("hash", "cid", "context")
    counts = sent.groupBy("hash").agg(F.approx_count_distinct("cid").alias("n")).filter(F.col("n") > crowd).select("hash")
    heavy = stored(counts, "crowded")
    usual = (sent.join(heavy, "hash", "left_anti").repartition(n_parts(spark), "hash").sortWithinPartitions("hash")
             .mapInArrow(_sort_contexts(length, chunk), "cid binary, first int, last int"))
    repeats = whole.unionByName(usual)
    if not heavy.isEmpty():
        alone = (sent.join(heavy, "hash", "left_semi").dropDuplicates(["cid"])
                 .mapInArrow(_strings(length), "cid binary, first int, string binary"))
        strings = stored(alone, "crowded-strings")
        twice = stored(strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("string"), "crowded-repeats")
        hits = strings.join(twice, "string", "left_semi").select("cid", "first", F.col("first").alias("last"))
        repeats = repeats.unionByName(hits)
    repeats = stored(repeats, "repeats")
    spans = (occ.select("cid", "key", "starts").join(repeats, "cid").select("key", "starts", "first", "last")
             .unionByName(made.filter("hash IS NULL").select("key", "starts", F.lit(0).alias("first"), "last").distinct())
             .select("key", F.explode("starts").alias("at"), "first", "last").groupBy("key").agg(F.collect_set(F.struct((F.col("at") + F.col("first")).alias("first"),
                                                        (F.col("at") + F.col("last")).alias("last"))).alias("spans")))
    spans = stored(spans, "spans")
    return (texts.join(spans.hint("merge"), "key", "left").select("doc_id", "packed", "spans")
            .mapInArrow(_removed(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))
