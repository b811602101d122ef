"""SimHash near-dedup against all pairs compared one by one."""

import os
import random

import numpy as np
import pytest

from kempt.llm import simhash
from tests.llm.brute import components_of, simhash_fp

SF = "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, text_key string, fp int, kept int")


def test_fingerprint_matches_plain_version():
    rng = random.Random(5)
    texts = ["", " \t\n", "one", "One TWO", "a b c", "Ä Ö ü É", "x y z w", "a\x0bb\x0cc\rd", "k " * 70000]
    texts += [" ".join(rng.choice("ab cd EF g".split()) for _ in range(rng.randint(1, 40))) for _ in range(50)]
    for t in texts:
        assert simhash.fingerprint(t) == simhash_fp(t)


def test_edge_rows(spark):
    rows = [(1, "a b c d", "x", "k", 1, 1), (2, "A  b c D", None, None, None, None), (2, "a b c d", "x", "k", 1, 1),
            (3, None, "x", "k", 1, 1), (4, "", "x", "k", 1, 1), (None, "a b c d", "x", "k", 1, 1),
            (7, "zz yy xx ww vv", "x", "k", 1, 1), (7, "zz yy xx ww vv", "x", "k", 1, 1)]
    got = simhash.near_dedup(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (None, 1), (3, 3), (4, 3), (7, 7)}
    kept = simhash.drop_near_copies(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "text_key", "fp", "kept"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 7]


def test_empty_table(spark):
    assert simhash.near_dedup(frame(spark, [])).count() == 0
    assert simhash.drop_near_copies(frame(spark, [])).count() == 0


@pytest.mark.parametrize("run_limit", [4, 1 << 14])
def test_components_of_clustered_fingerprints(spark, run_limit):
    """Random walks of few bits make chains and dense clusters; a low run limit sends most
    groups through the second index."""
    rng = random.Random(run_limit)
    fps = {0}
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(25):
            fps.add(x)
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    edges = {(r.u & (2**64 - 1), r.v & (2**64 - 1)) for r in simhash.links(df, 3, run_limit).collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in edges)
    at = {f: i for i, f in enumerate(fps)}
    got = {(at[a], at[b]) for a, b in edges}
    want = components_of(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    assert components_of(len(fps), lambda i, j: (i, j) in got or (j, i) in got) == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_query_matches_brute_force(spark):
    from kempt.llm.queries import QUERIES
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    fps = [simhash_fp(d.text) for d in docs]
    root = components_of(len(docs), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    want = {(d.doc_id, f"{f:016x}", docs[r].doc_id) for d, f, r in zip(docs, fps, root, strict=True)}
    assert {tuple(r) for r in QUERIES["op2_simhash"](spark, SF).collect()} == want
