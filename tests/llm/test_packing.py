"""Packing: every id in exactly one piece, no gaps, little padding, same ids as the library."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kempt.llm import packing
from kempt.llm.tokens import vocabulary


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=200))
def test_plan_places_every_id_once(lengths):
    window = 32
    hist = np.bincount(lengths, minlength=window + 1)
    p = packing.plan(hist, window)
    length = np.array(sorted(lengths), np.int64)
    rank = np.arange(len(length)) - np.searchsorted(length, length)
    piece, skip, part, seq, offset = packing.place(p, length, rank)
    got = defaultdict(list)
    for a, s, n in zip(piece, skip, part, strict=True):
        got[a] += range(s, s + n)
    assert all(sorted(got[i]) == list(range(n)) for i, n in enumerate(length))
    by = defaultdict(list)
    for s, o, n in zip(seq, offset, part, strict=True):
        by[s].append((o, n))
    assert sorted(by) == list(range(len(by)))
    short = []
    for spans in by.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= window
        if at < window:
            short.append(at)
    assert all(x & (x - 1) == 0 for x in short) and len(set(short)) == len(short)


def test_nnls_meets_an_exact_histogram():
    hist = np.zeros(101, np.int64)
    hist[[60, 40, 50, 25]] = [30, 30, 10, 20]  # 30 x (60, 40) and 10 x (50, 25, 25)
    combos = packing.combinations(hist, 100)
    x = packing.nnls(combos, hist)
    use = np.zeros(101)
    for c, k in zip(combos, x, strict=True):
        for n in c[c > 0]:
            use[n] += k
    assert np.abs(use - hist).max() < 0.5


@pytest.fixture(scope="module")
def frame(spark):
    texts = [None, "", "a", "word " * 5000, "Hello, world!\n" * 40, "é" * 3000, "a <|endoftext|> b"] + [f"text number {i} " * (i % 37) for i in range(150)]
    rows = [(i if i != 2 else None, t, "x", 1) for i, t in enumerate(texts)] + [(3, texts[3], "y", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, length int").repartition(3)


def test_pack_round_trip(spark, frame):
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    pieces = packing.pack(frame, keep_ids=True).collect()
    want = sorted((r.doc_id is None, r.doc_id or 0, tk.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in frame.collect())
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u2")
        assert len(ids) == p.length and zlib.crc32(ids.astype("<u4").tobytes()) == p.ids_crc32
    docs = defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append(p)
    for doc_id, ps in docs.items():
        full = [w for none, i, w in want if (None if none else i) == doc_id]
        for p in ps:
            assert p.doc_tokens == len(full[0])
            assert np.frombuffer(p.ids, "<u2").tolist() == full[0][p.start:p.start + p.length]
        starts = sorted((p.start, p.length) for p in ps)
        assert sum(n for _, n in starts) == len(full) * len(full[0])
    seqs = packing.sequences(packing.pack(frame, keep_ids=True)).collect()
    assert sum(len(s.ids) // 2 for s in seqs) == sum(len(w) for *_, w in want)
    assert all(sum(s.lengths) * 2 == len(s.ids) for s in seqs)


def test_empty_table(spark, frame):
    assert packing.pack(frame.limit(0)).count() == 0


def test_texts_and_ids_are_read_in_small_batches(spark, frame, monkeypatch):
    keys, seen = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxBytesPerBatch"), {}
    stored = packing.stored

    def spy(df, name, **options):
        seen[name] = [int(spark.conf.get(k)) for k in keys]
        return stored(df, name, **options)

    packing.on_workers(spark)
    own = [spark.conf.get(k) for k in keys]
    monkeypatch.setattr(packing, "stored", spy)
    assert packing.pack(frame).count() > 0
    for name in ("pieces", "cut-crc"):
        assert seen[name][0] <= 256 and seen[name][1] <= 2 << 20
    assert [spark.conf.get(k) for k in keys] == own


def test_cut_pieces_take_few_files(spark, frame, monkeypatch):
    files, stored = {}, packing.stored

    def spy(df, name, **options):
        out = stored(df, name, **options)
        files[name] = len(out.inputFiles())
        return out

    monkeypatch.setattr(packing, "stored", spy)
    packing.pack(frame.repartition(12)).collect()
    assert files["pieces"] > 3 >= max(files["cut-pieces"], files["cut-crc"])


def test_query_is_whole(spark):
    import os

    from kempt.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    want = {r.doc_id: tk.encode(r.text, add_special_tokens=False).ids + [1]
            for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op7_packing"](spark, sf).collect()
    covered, seqs = defaultdict(list), defaultdict(list)
    for p in got:
        ids = np.array(want[p.doc_id][p.start:p.start + p.length], "<u4")
        assert p.ids_crc32 == zlib.crc32(ids.tobytes()) and p.doc_tokens == len(want[p.doc_id])
        covered[p.doc_id] += range(p.start, p.start + p.length)
        seqs[p.sequence_id].append((p.offset, p.length))
    assert {k: sorted(v) for k, v in covered.items()} == {k: list(range(len(v))) for k, v in want.items()}
    for spans in seqs.values():
        spans.sort()
        assert [o for o, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1].tolist()]
        assert sum(n for _, n in spans) <= 2048
