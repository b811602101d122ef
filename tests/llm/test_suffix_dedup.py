"""Two-stage sorting and repeat removal against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kempt.llm import suffix_dedup as S
from tests.llm.brute import repeats_removed


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=40), min_size=1, max_size=8), st.integers(1, 6))
def test_two_stage_sorts_all_strings(parts, length):
    text = "".join(parts).encode()
    ends = np.cumsum([len(p) for p in parts])
    begin = np.concatenate([[0], ends[:-1]])
    valid = sorted(i for a, z in zip(begin, ends, strict=True) for i in range(a, z - length + 1))
    got = S.two_stage(text, ends, length).tolist()
    assert sorted(got) == valid
    assert [text[i:i + length] for i in got] == sorted(text[i:i + length] for i in valid)
    seen = Counter(text[i:i + length] for i in valid)
    assert S.repeated(text, ends, length).tolist() == [i for i in valid if seen[text[i:i + length]] > 1]


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=12, max_size=120))
def test_anchors_cover_each_string_once_and_follow_content(text):
    raw, length, gram = text.encode(), 12, 5
    h, first, last = S.anchors(raw, length, gram)
    assert first[0] == 0 and last[-1] == len(raw) - length and (first[1:] == last[:-1] + 1).all()
    grams = S.gram_hashes(raw, gram)
    place = {}
    for a, z, x in zip(first, last, h.view(np.uint64), strict=True):
        for t in range(a, z + 1):
            window = grams[t:t + length - gram + 1]
            assert window.min() == x
            p = int(window.argmin())
            assert place.setdefault(raw[t:t + length], p) == p
        # one anchor for the whole interval
        assert len({t + int(grams[t:t + length - gram + 1].argmin()) for t in range(a, z + 1)}) == 1


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=40, max_size=120))
def test_cells_cover_each_string_once_and_follow_content(text):
    raw, length, gram = text.encode(), 40, 6
    place = {}
    for _, first, last in zip(*S.anchors(raw, length, gram), strict=True):
        got = sorted(S.cells(raw, int(first), int(last), length, gram), key=lambda c: c[1])
        assert [t for _, a, z in got for t in range(a, z + 1)] == list(range(first, last + 1))
        for h, a, z in got:
            for t in range(a, z + 1):
                assert place.setdefault(raw[t:t + length], h) == h


def frame(spark, texts):
    return spark.createDataFrame([(i if i != 1 else None, t, "x", "k", 1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, route string, key string, first int").repartition(3)


def corpus(rng):
    shared = "".join(rng.choice("abcdefgh ") for _ in range(300))
    texts = [None, "", "short", "x" * 19, "x" * 20, "y" * 50, "Ther " * 40, "Ther " * 60, shared, shared,
             "".join(rng.choice("klmnop") for _ in range(40_000)) + shared[5:60]]  # a long text
    for _ in range(40):
        t = "".join(rng.choice("abcdefgh éß\n\x00") for _ in range(rng.randint(0, 90)))
        if rng.random() < 0.6:
            a = rng.randrange(280)
            t += shared[a:a + rng.randint(5, 60)]
        t += "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 30)))
        texts.append(t)
    return texts


@pytest.mark.parametrize(("hot", "crowd"), [(1, 1), (1, 1 << 15), (2048, 1), (2048, 1 << 15)])
def test_removal(spark, monkeypatch, hot, crowd):
    monkeypatch.setattr(S, "CELL", 4)
    texts = corpus(random.Random(hot + crowd))
    got = S.remove_repeats(frame(spark, texts), length=20, gram=6, chunk=200, hot=hot, crowd=crowd).collect()
    want = repeats_removed(texts, 20)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == \
        sorted((i == 1, 0 if i == 1 else i, *w) for i, w in enumerate(want))


def test_empty_table(spark):
    assert S.remove_repeats(frame(spark, ["a"]).limit(0)).count() == 0


def test_query_matches_brute_force(spark):
    import os

    from kempt.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    want = [(d.doc_id, n, m, k, hashlib.sha256(b).hexdigest())
            for d, (n, m, k, b) in zip(docs, repeats_removed([d.text for d in docs], 200), strict=True)]
    got = QUERIES["op9_suffix_dedup"](spark, sf).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(tuple(r) for r in got) == want
    assert sum(w[2] for w in want) > 0
