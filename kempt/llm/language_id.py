"""Language identification by a byte convolutional network.

The network reads windows of fixed length: filters of several widths slide over the bytes,
the strongest answer of each filter in the window is kept (max pooling), and a softmax
layer turns these into a probability for each language. A filter over one-hot bytes is a
table of 256 numbers for each place of the filter, so a convolution is a sum of table
look-ups over the whole batch of windows.

It is trained in numpy with Adam, on the driver, from at most ``per_lang`` documents of a
language with ``SLICES`` slices each; this bound is a parameter. Every document is then cut
whole into windows, and the mean log probability over its windows decides.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.llm.common import held_out, on_workers, slices

WINDOW = 256
WIDTHS = (4, 3, 2)  # widest first, so that the filters that reach a place come first
FILTERS = 8  # of each width
SLICES = 4
_LETTER = re.compile(r"[^\W\d_]")


class Network:
    """Tables (place, byte, filter), filter biases, and the softmax layer."""

    def __init__(self, langs: list[str], seed: int = 0):
        rng = np.random.default_rng(seed)
        n = FILTERS * len(WIDTHS)
        self.langs = langs
        self.reach = [FILTERS * sum(w > j for w in WIDTHS) for j in range(max(WIDTHS))]
        self.tables = [rng.normal(0, 0.3, (256, r)).astype(np.float32) for r in self.reach]
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.3, (n, len(langs))).astype(np.float32)
        self.out_bias = np.zeros(len(langs), np.float32)

    def _conv(self, x: np.ndarray) -> np.ndarray:
        """(windows, places, filters) from (windows, bytes)."""
        places = x.shape[1] - max(WIDTHS) + 1
        total = self.tables[0][x[:, :places]]
        for j in range(1, max(WIDTHS)):
            total[:, :, :self.reach[j]] += self.tables[j][x[:, j:j + places]]
        return total

    def log_probs(self, x: np.ndarray, at_once: int = 64) -> np.ndarray:
        pooled = np.empty((len(x), len(self.bias)), np.float32)
        for i in range(0, len(x), at_once):
            self._conv(x[i:i + at_once]).max(axis=1, out=pooled[i:i + at_once])
        return self._softmax(np.maximum(pooled + self.bias, 0))

    def _softmax(self, h: np.ndarray) -> np.ndarray:
        z = h @ self.out + self.out_bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        params = [*self.tables, self.bias, self.out, self.out_bias]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        filters, step = np.arange(len(self.bias)), 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                k = order[i:i + batch]
                conv = self._conv(x[k])
                where = conv.argmax(axis=1)  # (windows, filters)
                h = np.take_along_axis(conv, where[:, None], axis=1)[:, 0] + self.bias
                act = np.maximum(h, 0)
                d = np.exp(self._softmax(act))
                d[np.arange(len(k)), y[k]] -= 1
                d /= len(k)
                back = (d @ self.out.T) * (h > 0)
                grads = []
                for j, r in enumerate(self.reach):
                    g = np.zeros_like(self.tables[j])
                    bytes_at = np.take_along_axis(x[k], where[:, :r] + j, axis=1)
                    np.add.at(g, (bytes_at, np.broadcast_to(filters[:r], bytes_at.shape)), back[:, :r])
                    grads.append(g)
                grads += [back.sum(axis=0), act.T @ d, d.sum(axis=0)]
                step += 1
                for q, (p, g) in enumerate(zip(params, grads, strict=True)):
                    m[q] = 0.9 * m[q] + 0.1 * g
                    v[q] = 0.999 * v[q] + 0.001 * g * g
                    p -= rate * (m[q] / (1 - 0.9 ** step)) / (np.sqrt(v[q] / (1 - 0.999 ** step)) + 1e-8)


def windows(raw: bytes) -> np.ndarray:
    """All of a text's bytes in windows that overlap by the widest filter less one, the last
    one filled up with zeros."""
    step = WINDOW - max(WIDTHS) + 1
    n = max(1, -(-(len(raw) - max(WIDTHS) + 1) // step))
    flat = np.zeros((n - 1) * step + WINDOW, np.uint8)
    flat[:len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.as_strided(flat, (n, WINDOW), (step, 1))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = 512) -> Network | None:
    """Train on at most ``per_lang`` rows of each language, chosen by a hash of the id among
    the rows that are not held out and have an id, a language and a text; None without any."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & ~held_out(F.col("id"))).withColumn("h", F.xxhash64("id"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    # a hash range that holds about twice as many rows as needed spares sorting the others
    chance = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 2 * per_lang / n + 64 / n))])
    near = rows.filter(F.pmod("h", F.lit(1 << 20)) < chance[F.col("lang")] * (1 << 20))
    slices = F.array(*[F.substring("text", (F.pmod(F.xxhash64("id", F.lit(i)), F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1)
                                            + 1).cast("int"), WINDOW) for i in range(SLICES)])
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))
    sample = (near.select("id", "lang", "h", slices.alias("slices")).withColumn("nth", nth)
              .filter(F.col("nth") <= per_lang).select("lang", "nth", "slices").collect())
    langs = sorted(counts)
    x, y = [], []
    for r in sorted(sample, key=lambda r: (r["lang"], r["nth"])):
        for s in r["slices"]:
            if s and _LETTER.search(s):
                x.append(windows(s.encode())[0])
                y.append(langs.index(r["lang"]))
    if not x:
        return None
    net = Network(langs)
    net.train(np.stack(x), np.array(y))
    return net


def _predict(net: Network | None, at_once: int = 4096):
    """Predictions of Arrow batches; the network runs once for ``at_once`` windows, of whatever
    documents of a batch they are."""
    step, short = WINDOW - max(WIDTHS) + 1, max(WIDTHS) - 1

    def logs(raws: list[bytes]) -> np.ndarray:
        """Mean log-probabilities over the windows of each text, as :func:`windows` cuts it."""
        n = np.array([max(1, -(-(len(r) - short) // step)) for r in raws])
        firsts = np.cumsum(n) - n
        # every text filled up with zeros to the end of its last window, one after another
        flat = np.frombuffer(b"".join(r.ljust((k - 1) * step + WINDOW, b"\0") for r, k in zip(raws, n.tolist(), strict=True)), np.uint8)
        starts = np.arange(n.sum()) * step + np.repeat(np.arange(len(n)) * (WINDOW - step), n)
        views, total = np.lib.stride_tricks.sliding_window_view(flat, WINDOW), np.zeros((len(n), len(net.langs)))
        for k in range(0, len(starts), at_once):
            part = net.log_probs(views[starts[k:k + at_once]]).astype(np.float64)
            i, j = np.searchsorted(firsts, (k, k + len(part) - 1), "right") - 1  # first and last text of these windows
            total[i:j + 1] += np.add.reduceat(part, np.maximum(firsts[i:j + 1] - k, 0))
        return total / n[:, None]

    def run(batches):
        for b in slices(batches):
            texts = b["text"].to_pylist()
            pred, score = ["und"] * len(texts), [0.0] * len(texts)
            which = [i for i, t in enumerate(texts) if net and t and _LETTER.search(t)]
            if which:
                p = logs([texts[i].encode("utf-8", "surrogatepass") for i in which])
                p = np.exp(p - p.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                for i, best, s in zip(which, p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True):
                    pred[i], score[i] = net.langs[best], s
            yield pa.record_batch([b["doc_id"], b["held_out"], pa.array(pred), pa.array(score, pa.float64())],
                                  names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             per_lang: int = 512) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    lang_pred is ``und`` with score 0 for a null text or one without a letter, and if there is
    nothing to learn from. held_out: crc32 of the id as text is divisible by 5 (also for a null
    id); such rows are not learned from."""
    on_workers(docs.sparkSession)
    net = fit(docs, id_col, text_col, lang_col, per_lang)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       held_out(F.col(f"`{id_col}`").cast("long")).alias("held_out"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(_predict(net), "doc_id long, held_out boolean, lang_pred string, score double")
