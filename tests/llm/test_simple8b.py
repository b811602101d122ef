"""Simple-8b: exact round trips of words, blocks and files."""

import os
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kempt.llm import simple8b
from kempt.llm.tokens import vocabulary
from kempt.session import scratch_dir


def round_trip(ids):
    ids = np.array(ids, np.uint64)
    frames, words = simple8b.encode_block(ids)
    words = np.frombuffer(words, "<u8")
    assert (simple8b.decode(words, frames, len(ids)) == ids).all()
    return words


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70000), st.integers(0, 2**64 - 1)), max_size=300))
def test_any_ids(ids):
    round_trip(ids)


@pytest.mark.parametrize("n", [0, 1, 119, 120, 121, simple8b.FRAME - 1, simple8b.FRAME, simple8b.FRAME + 1, 3 * simple8b.FRAME + 7])
def test_lengths(n):
    rng = random.Random(n)
    round_trip([0] * n)
    round_trip([rng.randrange(50000) for _ in range(n)])
    round_trip([rng.choice([0, 1, 2**60, 2**64 - 1, 2**60 - 1]) for _ in range(n)])


def test_words_are_packed():
    assert len(round_trip([0] * 120)) == 1
    assert len(round_trip([1] * 60)) == 1
    assert len(round_trip([2**60 - 1])) == 1
    assert len(round_trip([2**60])) == 2


def test_files(spark):
    rows = [(5, "five five", "x", 1), (None, "none", "x", 1), (3, None, "x", 1), (4, "", None, None), (5, "five five", "x", 1),
            (1, "long text " * 20000, "x", 1), (-2, "minus <|endoftext|> <|STARTOFTEXT|>x", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, part int")
    path = scratch_dir(spark, "ids")
    simple8b.write_ids(df, path, block_ids=64)
    got = sorted(simple8b.read_ids(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, -2, 1, 3, 4, 5, 5]
    at = 0
    for r in got:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens and zlib.crc32(r.ids) == r.ids_crc32
        assert np.frombuffer(r.ids, "<u4")[-1] == 2
        at += r.n_tokens
    assert [r.n_tokens for r in got][3:5] == [1, 1]
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))  # as it is: special tokens count
    text = {i: t for i, t, *_ in rows}
    assert all(np.frombuffer(r.ids, "<u4").tolist() == [*tk.encode(text[r.doc_id] or "", add_special_tokens=False).ids, 2] for r in got)
    assert 49407 in np.frombuffer(got[1].ids, "<u4")
    simple8b.write_ids(df.limit(0), path)
    assert simple8b.read_ids(spark, path).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="driver test data not present")
def test_query_matches_library(spark):
    from tokenizers import Tokenizer

    from kempt.llm.queries import QUERIES
    tk = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    docs = sorted(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect())
    at, want = 0, []
    for d in docs:
        ids = tk.encode(d.text, add_special_tokens=False).ids + [2]
        want.append((d.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in QUERIES["op8_simple8b"](spark, "/root/testdata/sf0.01").collect()) == want


def test_one_id_over_many_ranges(spark):
    """An id that most rows share: its rows are spread, the order stays."""
    rows = [(7, f"text {i % 90}") for i in range(300)] + [(i, f"other {i}") for i in range(40)] + [(None, f"none {i}") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    from kempt.llm.tokens import in_order
    coded = in_order(df, vocabulary("word_bpe_49k.json")).selectExpr("doc_id", "spark_partition_id() AS p").collect()
    assert len({r.p for r in coded if r.doc_id == 7}) > 1 and len(coded) == len(rows)
    path = scratch_dir(spark, "ids")
    simple8b.write_ids(df, path, block_ids=64)
    got = sorted(simple8b.read_ids(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
