"""Periodic runs against a plain search of all lags, and the registered digests against plain Python."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from kempt.llm import periodic_runs as R


def brute(words, min_length=6, min_exponent=4):
    """Every maximal stretch of every lag whose smallest period is that lag."""
    n, out = len(words), []
    for q in range(1, n):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            e = i
            while e < n - q and words[e] == words[e + q]:
                e += 1
            s, length = i, e - i + q
            part = words[s:s + length]
            if length >= max(min_length, min_exponent * q) and not any(
                    all(part[x] == part[x + d] for x in range(length - d)) for d in range(1, q)):
                out.append((s, length, q))
            i = e
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def found(texts, **kw):
    args = (kw.get("min_length", 6), kw.get("min_exponent", 4))
    return [([(r["start"], r["length"], r["period"]) for r in runs], text.decode()) for runs, text in R._batch(texts, *args)]


def texts(seed):
    rng = np.random.default_rng(seed)
    out = ["", " \t\n", "a", "a a a a a", "a a a a a a", "a\x0ba\x0ca\ra\na\ta a b", "x " * 500, "ab ab ab ab b b b b b b"]
    for alphabet in (1, 2, 3, 9):
        out += [" ".join(f"w{x}" for x in rng.integers(0, alphabet, rng.integers(1, 150))) for _ in range(12)]
    for _ in range(25):  # random words around a period repeated a fractional number of times
        q = int(rng.integers(1, 30))
        unit = rng.integers(0, max(2, int(rng.integers(1, 12))), q)
        body = np.tile(unit, 8)[:int(q * rng.uniform(2.5, 7))]
        around = [rng.integers(0, 12, rng.integers(0, 30)) for _ in range(2)]
        out.append(" ".join(f"w{x}" for x in np.concatenate([around[0], body, around[1]])))
    nested = ("a a a a a a b " * 5 + "c ") * 4  # runs inside the period of a run
    return [*out, nested, nested.upper(), "É é É é É é É é ﬁ ﬁ ﬁ ﬁ ﬁ ﬁ"]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize(("min_length", "min_exponent"), [(6, 4), (2, 3), (9, 3), (40, 5)])
def test_all_runs_and_no_others(seed, min_length, min_exponent):
    ts = texts(seed)
    for t, (runs, text) in zip(ts, found(ts, min_length=min_length, min_exponent=min_exponent), strict=True):
        words = re.findall("[^\x20\x09-\x0D]+", t)
        assert runs == brute(words, min_length, min_exponent), t
        assert text == collapsed(words, runs)


def test_matches_do_not_cross_documents():
    assert found(["a a a", "a a a", "b c", "b c b c b c"]) == [([], "a a a"), ([], "a a a"), ([], "b c"), ([], "b c b c b c")]


def test_long_text():
    words = [f"w{i}" for i in range(70_000)]
    got = found([" ".join(words * 4 + ["end"])])[0]
    assert got == ([(0, 280_000, 70_000)], " ".join([*words, "end"]))
    assert found(["a " * 300_000])[0] == ([(0, 300_000, 1)], "a")


def expected(doc_id, text):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))


def test_query_against_plain(spark):
    rows = list(enumerate([*texts(9), None, *["one two three four five six seven eight " * k for k in range(1, 40)]]))
    rows += [(None, "a a a a a a a"), (3, "z z z z z z"), (3, "z z z z z z")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, runs int, words string").repartition(3)
    got = R.digests(R.periodic_runs(R.planted(df)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [expected(i, t) for i, t in rows]
    assert any(r[1] for r in want)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_general_interface(spark):
    df = spark.createDataFrame([(1, "u v u v u v u v u end")], "key int, Body string")
    r = R.periodic_runs(df, "key", "body").first()
    assert (r.doc_id, [tuple(x) for x in r.runs], r.collapsed) == (1, [(0, 9, 2)], "u v end")
    assert R.periodic_runs(df.limit(0), "key", "body").count() == 0
    with pytest.raises(ValueError):
        R.periodic_runs(df, "key", "body", min_exponent=2)
