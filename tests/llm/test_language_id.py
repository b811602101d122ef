"""Language identification: held-out accuracy, whole texts, odd rows."""

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kempt.llm import language_id as L

SF = "/root/testdata/sf0.01"


def test_windows_cover_every_filter_place():
    for n in [0, 1, 3, 4, 252, 253, 256, 257, 505, 506, 507, 5000]:
        raw = bytes(i % 251 + 1 for i in range(n))
        x = L.windows(raw)
        assert x.shape[1] == L.WINDOW
        grams = {bytes(w[i:i + 4]) for w in x for i in range(L.WINDOW - 3)}
        assert all(raw[i:i + 4] in grams for i in range(max(0, n - 3)))


def test_convolution_is_a_sum_of_filters():
    net = L.Network(["a", "b"])
    x = np.random.default_rng(1).integers(0, 256, (3, L.WINDOW)).astype(np.uint8)
    conv = net._conv(x)
    f = 10  # the third filter of the second width
    width = L.WIDTHS[f // L.FILTERS]
    want = sum(net.tables[j][x[1, 7 + j], f] for j in range(width))
    assert abs(conv[1, 7, f] - want) < 1e-5


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_held_out_accuracy(spark):
    from kempt.llm.queries import QUERIES
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op4_language_id"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_edge_rows(spark):
    rows = [(i, ("the cat and the dog sat " if i % 2 else "der hund und die katze ") * 9, "en" if i % 2 else "de", 0.5)
            for i in range(60)]
    rows += [(100, None, "en", None), (101, "", "en", None), (102, "12 34 !!", "de", None), (None, "the dog", "en", None),
             (103, "die katze", None, None), (5, rows[5][1], "en", 0.5), (104, "the dog and the cat " * 50000, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = L.identify(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (100, 101, 102))
    assert by[103].lang_pred == "de" and by[104].lang_pred == "en" and by[None].held_out
    assert L.identify(df.limit(0)).count() == 0
    none = L.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}


def _plain(net, raw):
    """Mean log-probabilities of a text's windows, one number at a time."""
    step, total = L.WINDOW - max(L.WIDTHS) + 1, [0.0] * len(net.langs)
    n = max(1, -(-(len(raw) - max(L.WIDTHS) + 1) // step))
    for w in range(n):
        window = raw[w * step:w * step + L.WINDOW].ljust(L.WINDOW, b"\0")
        h = []
        for f in range(len(net.bias)):
            width = L.WIDTHS[f // L.FILTERS]
            h.append(max(0.0, max(sum(float(net.tables[j][window[p + j], f]) for j in range(width))
                                  for p in range(L.WINDOW - max(L.WIDTHS) + 1)) + float(net.bias[f])))
        z = [sum(a * float(o) for a, o in zip(h, net.out[:, c], strict=True)) + float(net.out_bias[c]) for c in range(len(net.langs))]
        norm = max(z) + np.log(sum(np.exp(v - max(z)) for v in z))
        total = [t + v - norm for t, v in zip(total, z, strict=True)]
    return [t / n for t in total]


@pytest.mark.parametrize("at_once", [1, 2, 3, 4096])
def test_predictions_are_those_of_plain_loops(at_once):
    import pyarrow as pa
    rng = np.random.default_rng(3)
    net = L.Network(["a", "b", "c"], seed=5)
    net.bias += rng.normal(0, 0.5, len(net.bias)).astype(np.float32)
    net.out_bias += rng.normal(0, 0.5, 3).astype(np.float32)
    texts = ["x", "der hund", "Übergröße " * 60, "the cat " * 31 + "sat", "12 ..", None, "дом " * 100]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array([False] * len(texts)), pa.array(texts)], names=["doc_id", "held_out", "text"])
    got = [r for b in L._predict(net, at_once)([batch]) for r in b.to_pylist()]
    assert [r["doc_id"] for r in got] == list(range(len(texts)))
    for r, t in zip(got, texts, strict=True):
        if t is None or not any(c.isalpha() for c in t):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        logs = np.array(_plain(net, t.encode()))
        p = np.exp(logs - logs.max())
        assert r["lang_pred"] == net.langs[int(p.argmax())] and abs(r["score"] - (p / p.sum()).max()) < 1e-4


def test_training_steps_down_the_gradient():
    """The first step of Adam moves each weight by the rate against the sign of its gradient."""
    rng = np.random.default_rng(4)
    x, y = rng.integers(97, 103, (12, L.WINDOW)).astype(np.uint8), rng.integers(0, 3, 12)
    net, new = L.Network(["a", "b", "c"], seed=1), L.Network(["a", "b", "c"], seed=1)
    new.train(x, y, epochs=1, batch=12, rate=1e-3)

    def loss():
        return -float(net.log_probs(x)[np.arange(12), y].mean(dtype=np.float64))

    checked = 0
    for old, moved in zip([*net.tables, net.bias, net.out, net.out_bias], [*new.tables, new.bias, new.out, new.out_bias], strict=True):
        flat, step = old.reshape(-1), (moved - old).reshape(-1)
        for i in rng.permutation(np.flatnonzero(np.abs(step) > 5e-4))[:40]:
            keep, h = flat[i], np.float32(2e-3)
            flat[i] = keep + h
            up = loss()
            flat[i] = keep - h
            down = loss()
            flat[i] = keep
            slope = (up - down) / (2 * h)
            if abs(slope) > 2e-3:  # clear of rounding and of another place taking over the maximum
                assert np.sign(slope) == -np.sign(step[i])
                checked += 1
    assert checked > 60
