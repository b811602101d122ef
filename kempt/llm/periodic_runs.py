"""Periodic runs of words by seeds that are extended along diagonals.

A run with period q and length L >= max(min_length, min_exponent * q) agrees with itself q
words further on over L - q words: a stretch of the diagonal of lag q. Lags are taken octave by
octave; k, the shortest such stretch of any lag of the octave, is the overlap that every run of
the octave is sure to have. All k-grams are indexed (named so that equal k-grams of the batch,
and only they, have equal names), and an occurrence is paired with the next one of the same
document. As k is at least as long as the lag, two occurrences inside a run are never closer
than its smallest period, so these pairs, one per occurrence at most, hold a seed of every run
and no lag that is a multiple of a smaller period. Seeds are extended to both sides; a table
with the furthest word covered on each lag passes over seeds that lie in an extension already
made.

Names are exact: those of 2**(j+1)-grams come from pairs of names of 2**j-grams. A gram that
occurs once in its document stays out of longer ones, so ordinary prose costs two rounds.
Documents are cut off from each other by a word of their own; nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.llm.common import id_text, on_workers

_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_BATCH_WORDS = 1 << 18  # a document's words are never divided, so a batch may hold more
_STEP = 256


def words_of(text: str) -> list[bytes]:
    """Runs of anything but ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split()


def _named(first: np.ndarray, second: np.ndarray, doc: np.ndarray, at: np.ndarray):
    """Names of the pairs (first, second) at the ascending places ``at``, and for each place
    the next one of the same pair in the same document (-1: none).

    Returns (at, names, next) without the places whose pair occurs once in its document."""
    if not len(at):
        return at, at, at
    order = np.lexsort((at, second, first))  # stable in places, so a pair's occurrences ascend
    f, s, p = first[order], second[order], at[order]
    same = (f[1:] == f[:-1]) & (s[1:] == s[:-1])
    name = np.concatenate([[0], np.cumsum(~same)])
    near = same & (doc[p[1:]] == doc[p[:-1]])
    nxt = np.full(len(p), -1, np.int64)
    nxt[:-1][near] = p[1:][near]
    live = np.zeros(len(p), bool)
    live[:-1] |= near
    live[1:] |= near
    p, name, nxt = p[live], name[live], nxt[live]
    back = np.argsort(p, kind="stable")
    return p[back], name[back], nxt[back]


def _joined(at: np.ndarray, name: np.ndarray, shift: int, doc: np.ndarray, n: int):
    """Grams longer by ``shift``: the gram at each place together with that ``shift`` further on."""
    table = np.full(n + 1, -1, np.int64)
    table[at] = name
    later = table[np.minimum(at + shift, n)]
    go = later >= 0
    return _named(name[go], later[go], doc, at[go])


def _extended(words: np.ndarray, place: int, lag: int, k: int) -> tuple[int, int]:
    """The whole stretch of the diagonal around the seed: places i with words[i] == words[i + lag]."""
    end, start, n = place + k, place, len(words) - lag
    while end < n:
        diff = np.flatnonzero(words[end:min(end + _STEP, n)] != words[end + lag:min(end + _STEP, n) + lag])
        if len(diff):
            end += int(diff[0])
            break
        end = min(end + _STEP, n)
    while start > 0:
        low = max(0, start - _STEP)
        diff = np.flatnonzero(words[low:start] != words[low + lag:start + lag])
        if len(diff):
            start = low + int(diff[-1]) + 1
            break
        start = low
    return start, end


def find_runs(words: np.ndarray, doc: np.ndarray, min_length: int = 6, min_exponent: int = 4) -> np.ndarray:
    """(m, 3) rows (start, length, period) of all runs, by start and period. ``words``: numbers
    of the words of documents laid end to end, each document closed by a number that occurs
    nowhere else; ``doc``: the document of each place, ascending."""
    if min_exponent < 3:
        raise ValueError("seeds of one octave need runs of three periods at least")
    n = len(words)
    found: list[tuple[int, int, int]] = []
    at = np.arange(n)
    levels = [_named(words, np.zeros(n, np.int64), doc, at) if n else (at, at, at)]  # grams of 1, 2, 4, ... words
    j = 0
    while len(levels[-1][0]) or min_exponent << j < min_length:
        lags = range(1 << j, 2 << j)
        turn = min(max(min_length // min_exponent, lags[0]), lags[-1])  # the overlap falls up to here, then grows
        k = min(max(min_length, min_exponent * q) - q for q in (lags[0], turn, min(turn + 1, lags[-1])))
        j += 1
        m = k.bit_length() - 1
        while len(levels) <= m:
            levels.append(_joined(levels[-1][0], levels[-1][1], 1 << len(levels) - 1, doc, n))
        a, name, nxt = levels[m]
        if k > 1 << m:
            a, name, nxt = _joined(a, name, k - (1 << m), doc, n)
        lag = nxt - a
        seed = (nxt >= 0) & (lag >= lags[0]) & (lag <= lags[-1])
        a, lag = a[seed], lag[seed]
        order = np.lexsort((a, lag))
        a, lag = a[order], lag[order]
        # a seed right behind another on its diagonal lies in that one's extension
        head = np.ones(len(a), bool)
        head[1:] = (lag[1:] != lag[:-1]) | (a[1:] != a[:-1] + 1)
        covered: dict[int, int] = {}
        for p, q in zip(a[head].tolist(), lag[head].tolist(), strict=True):
            if p < covered.get(q, -1):
                continue
            start, end = _extended(words, p, q, k)
            covered[q] = end
            if end - start + q >= max(min_length, min_exponent * q):
                found.append((start, end - start + q, q))
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _batch(texts: list[bytes | str], min_length: int, min_exponent: int):
    """(runs, collapsed text) of each text."""
    split = [words_of(t) for t in texts]
    numbers: dict[bytes, int] = {}
    ids: list[int] = []
    for i, words in enumerate(split):
        ids += [numbers.setdefault(w, len(numbers)) for w in words]
        ids.append(-1 - i)
    sizes = np.array([len(w) + 1 for w in split], np.int64)
    first = np.cumsum(sizes) - sizes
    arr = np.array(ids, np.int64)
    runs = find_runs(arr, np.repeat(np.arange(len(split)), sizes), min_length, min_exponent)
    drop = np.zeros(len(arr) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    gone = np.cumsum(drop)[:-1] > 0
    owner = np.searchsorted(first, runs[:, 0], side="right") - 1
    cuts = np.searchsorted(owner, np.arange(len(split) + 1))
    for i, words in enumerate(split):
        mine = runs[cuts[i]:cuts[i + 1]]
        if not len(mine):
            yield [], b" ".join(words)
            continue
        kept = np.flatnonzero(~gone[first[i]:first[i] + len(words)]).tolist()
        yield ([{"start": s - int(first[i]), "length": n, "period": q} for s, n, q in mine.tolist()],
               b" ".join([words[x] for x in kept]))


def _portions(batches):
    """Rows of Arrow batches in portions of about ``_BATCH_WORDS`` words, one row at least."""
    for b in batches:
        texts = b["text"]
        sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)) if pa.types.is_string(
            texts.type) else np.array([len(t.as_py()) for t in texts], np.int64)
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and (held + size > 6 * _BATCH_WORDS or i - start >= 4096):
                yield b.slice(start, i - start)
                start, held = i, 0
            held += size
        if b.num_rows > start:
            yield b.slice(start)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6,
                  min_exponent: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, runs (array of start, length, period; by start, then
    period), collapsed (the words outside runs and the first period of each, joined by spaces).

    A run is a stretch of words with smallest period q, at least ``min_length`` words and
    ``min_exponent`` (3 or more) times q long, that neither neighbour extends with that period.
    Words are numbered from 0. Null text counts as empty: no runs, empty text; repeated rows
    give repeated rows, a null id stays null, other columns are left behind, an empty table
    gives no rows. Texts are read whole; a worker holds one portion of a batch at a time."""
    if min_exponent < 3 or min_length < 2:
        raise ValueError("min_exponent must be 3 or more, min_length 2 or more")
    on_workers(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                        ("collapsed", pa.string())])

    def run(batches):
        for b in _portions(batches):
            got = list(_batch(b["text"].to_pylist(), min_length, min_exponent))
            text = pa.array([c for _, c in got], pa.binary()).cast(pa.string())
            yield pa.record_batch([b["doc_id"], pa.array([r for r, _ in got], schema.field("runs").type), text], schema=schema)

    return id_text(docs, id_col, text_col).mapInArrow(run, f"doc_id long, runs {_RUNS}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the periodic stretches of the registered query: with h = crc32 of the
    decimal doc_id and g = floor(h / 10), a text of n > 0 words whose h is divisible by 10 has
    from word a = g % n on its words a .. a+p-1 over and over, p = 1 + floor((n-a) / (3 + g%8)).
    A null id plants nothing."""
    base = id_text(docs)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    hit = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.when(hit, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    base = base.select("doc_id", "text", words.alias("words"), F.floor(h / 10).cast("long").alias("g"))
    n = F.size("words").cast("long")
    base = base.withColumn("a", F.when(n > 0, F.col("g") % n))
    base = base.withColumn("p", F.when(n > 0, 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("long")))
    text = F.array_join(F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))), " ")
    return base.select("doc_id", F.when(n > 0, text).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The digest columns of the registered query from the runs and collapsed texts."""
    best = F.get(F.array_sort(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"]))), 0)
    lines = F.concat(F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n"),
                     F.when(F.size("runs") > 0, "\n").otherwise(""))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.sha2(lines, 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"), best.alias("best"))
    length = -F.col("best.col1")
    return out.select("doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"),
                      F.col("best.period").alias("period"), F.floor(1000 * length / F.col("best.period")).cast("long").alias("exponent_milli"),
                      "runs_sha256", "collapsed_sha256")
