"""Temperature mixing against a plain computation."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest

from kempt.llm import mixing


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, tokens string, epochs int").repartition(3)


def place(doc_id, epoch, seed=0):
    text = f"{'null' if doc_id is None else doc_id}:{epoch}:{seed}"
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def brute(rows, entropy, repeats, budget=None):
    """Counter of (doc_id, source, epoch)."""
    rows = [(i, s or "", len((t or "").split())) for i, t, s, *_ in rows]
    total = Counter()
    for _, s, n in rows:
        total[s] += n
    filled = {s: n for s, n in total.items() if n}

    def mixture(a):
        w = [(n / max(filled.values())) ** a for n in filled.values()]
        return [x / sum(w) for x in w]

    k = 10_000
    if filled:
        fit = [k for k in range(10_001)
               if -sum(p * math.log(p) for p in mixture(k / 10_000)) >= entropy * math.log(len(filled)) - 1e-9]
        k = max(fit, default=0)
        while (max(filled.values()) / min(filled.values())) ** (1 - k / 10_000) > repeats + 1e-9:
            k += 1
    quota = {s: n * (max(filled.values()) / n) ** (1 - k / 10_000) for s, n in filled.items()}
    scale = budget / sum(quota.values()) if budget else 1
    out, by = Counter(), defaultdict(list)
    for i, s, n in rows:
        by[s].append((i, n))
    for s, docs in by.items():
        q = round(quota[s] * scale) if s in filled else 0
        epochs = q // filled[s] if s in filled else 1
        for i, _ in docs:
            for e in range(epochs):
                out[i, s, e] += 1
        if s in filled:
            rest = q - epochs * filled[s]
            for i, _ in docs:
                if sum(n for j, n in docs if place(j, epochs) <= place(i, epochs)) <= rest:
                    out[i, s, epochs] += 1
    return out


def sources(rng, n=160):
    rows = [(i, "w " * rng.randint(0, 30), rng.choices(["a", "b", "c", None, ""], [12, 4, 2, 1, 1])[0], "x", 1) for i in range(n)]
    return rows + [(None, "some words here", "a", "x", 1), (3, rows[3][1], rows[3][2], None, None), (900, None, "empty", "x", 1),
                   (901, "w " * 3000, "long", "x", 1)]


@pytest.mark.parametrize(("entropy", "repeats", "budget"), [(0.999, 1.5, None), (0.95, 100, None), (1.0, 100, None), (0.0, 1, None),
                                                              (0.9, 4, 700), (0.999, 2, 20000)])
def test_mixture(spark, entropy, repeats, budget):
    rows = sources(random.Random(4))
    got = mixing.mix(frame(spark, rows), entropy=entropy, repeats=repeats, budget=budget).collect()
    assert Counter((r.doc_id, r.source, r.epoch) for r in got) == brute(rows, entropy, repeats, budget)
    assert all(0 <= r.block < 1024 and 0 <= r.position <= 1 for r in got)
    if budget is None:  # every document at least once
        assert {r.doc_id for r in got} == {r[0] for r in rows}


def test_blocks_follow_the_weights(spark):
    rows = [(i, "w " * 10, "big" if i % 4 else "small", "x", 1) for i in range(4000)]
    got = mixing.mix(frame(spark, rows), entropy=1.0, repeats=10, blocks=4).collect()
    for b in range(4):
        shares = Counter(r.source for r in got if r.block == b)
        assert abs(shares["big"] / sum(shares.values()) - 0.5) < 0.05


def test_documents_and_empty(spark):
    rows = sources(random.Random(5), 60)
    df = frame(spark, rows)
    got = mixing.mixed_documents(df)
    assert got.columns == df.columns
    want = Counter(r.doc_id for r in mixing.mix(df).collect())
    assert Counter(r.doc_id for r in got.collect()) == want
    assert mixing.mix(df.limit(0)).count() == 0 == mixing.mixed_documents(df.limit(0)).count()
