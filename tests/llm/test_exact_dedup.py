"""Exact dedup: coding, edge rows, brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kempt.llm import exact_dedup as D


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**48 - 1), max_size=200), st.integers(1, 40))
def test_rice_round_trip(values, owners):
    v = np.unique(np.array(values, np.uint64))
    for o in range(owners):
        low, high = D._cut(o, owners), D._cut(o + 1, owners)
        mine = v[(v >= low) & (v < high)]
        k, code = D.rice_encode(mine, low, high - low)
        assert (D.rice_decode(len(mine), k, code, low) == mine).all()
    assert D._cut(0, owners) == 0 and D._cut(owners, owners) == 1 << D.FP_BITS


def test_rice_is_compact():
    rng = np.random.default_rng(0)
    v = np.unique(rng.integers(0, 2**48, 100_000).astype(np.uint64))
    _, code = D.rice_encode(v, 0, 1 << 48)
    assert len(code) * 8 < len(v) * (48 - 16.6 + 2.2)  # about log2 of the mean gap and two bits


def norm(t):
    return re.sub("[\x20\x09-\x0D]+", " ", t or "")


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, "doc_id long, text string, sha string, kept int, n string").repartition(parts)


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[norm(t)].append(i)
    out = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        first = True
        for i in sorted(ids, key=lambda x: (x is None, x or 0)):
            out.append((i, keep, len(ids), first, hashlib.sha256(t.encode()).hexdigest()))
            first = False
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", " ", "  \t", "a b", "a  b", "a\nb", "a\x0bb ", " a b", "ab", "x" * 200_000, "É É", "a b"]
    rows = [(i, t, "s", 1, None) for i, t in enumerate(texts)]
    rows += [(rng.randint(50, 200), rng.choice(["hot text", f"text {rng.randint(0, 30)}"]), None, None, "n") for _ in range(300)]
    rows += [(None, "hot text", "s", 1, "n"), (None, "only null ids", "s", 1, "n"), (None, "only null ids", "s", 1, "n"),
             (7, "a\rb", "s", 1, "n"), (7, "a\rb", "s", 1, "n")]
    return rows


@pytest.mark.parametrize(("block_rows", "owner_rows", "words"), [(7, 20, 1), (1 << 17, 1 << 21, 1 << 20)])
def test_against_brute_force(spark, block_rows, owner_rows, words):  # a filter of one word is full
    rows = corpus(block_rows)
    got = D.exact_dedup(frame(spark, rows), block_rows=block_rows, owner_rows=owner_rows, filter_words=words).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_drop_copies_keeps_rows_whole(spark):
    rows = corpus(1)
    df = frame(spark, rows)
    out = D.drop_copies(df)
    assert out.schema == df.schema
    got = out.collect()
    kept = [(i, h) for i, _, _, k, h in brute(rows) if k]
    assert sorted(((r.doc_id, hashlib.sha256(norm(r.text).encode()).hexdigest()) for r in got), key=repr) == sorted(kept, key=repr)
    assert {tuple(r) for r in got} <= set(rows)


def test_empty_table(spark):
    assert D.exact_dedup(frame(spark, corpus(2)).limit(0)).count() == 0
    assert D.drop_copies(frame(spark, corpus(2)).limit(0)).count() == 0
