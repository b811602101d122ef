"""Separator scan against counts made document by document."""

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from kempt.llm import separator_scan
from kempt.llm.tokens import vocabulary
from kempt.session import scratch_dir


def counts(spark, path, **kw):
    return sorted(tuple(r) for r in separator_scan.count_tokens(spark, path, **kw).select("ordinal", "start", "n_tokens").collect())


@pytest.mark.parametrize("block_ids", [1, 3, 7, 64, 1 << 19])
def test_flat_files(spark, tmp, block_ids):
    """Documents over many blocks, ends at borders, empty documents, a file without an end."""
    files = [[5, 6, 9, 9, 1, 2, 3, 4, 5, 6, 7, 8, 1, 1, 9, 4, 9], [9], [1, 2, 3, 4, 5, 6, 7, 8], [], [9, 9, 7, 7, 7, 9, 1, 2]]
    folder = tmp.replace("file:", "")
    os.makedirs(folder, exist_ok=True)
    want, start, ordinal = [], 0, 0
    for i, ids in enumerate(files):
        np.array(ids, "<u2").tofile(f"{folder}/{i}.bin")
        ends = [k + 1 for k, x in enumerate(ids) if x == 9]
        ends += [len(ids)] * (len(ids) > (ends[-1] if ends else 0))
        for a, z in zip([0, *ends], ends, strict=False):
            want.append((ordinal, start + a, z - a))
            ordinal += 1
        start += len(ids)
    assert counts(spark, tmp, end_id=9, block_ids=block_ids) == want


def test_write_flat(spark):
    texts = ["Hello World", None, "", "same", "same", "<|endoftext|>", "long words " * 3000, "é ñ\n\nß"]
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], "doc_id long, text string, ids string, piece int").coalesce(1)
    path = scratch_dir(spark, "flat")
    separator_scan.write_flat(df, path, file_bytes=1000)
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    tk.encode_special_tokens = True
    lists = [tk.encode(t or "", add_special_tokens=False).ids + [49407] for t in texts]
    names = glob.glob(f"{path.replace('file:', '')}/kind=tokens/piece=*/part-*")
    assert len(names) > 1
    flat = np.concatenate([np.fromfile(n, "<u2") for n in names])
    assert len(flat) == sum(map(len, lists)) and (flat == 49407).sum() == len(texts)
    got = counts(spark, path)
    assert sorted(n for *_, n in got) == sorted(map(len, lists))
    assert [o for o, *_ in got] == list(range(len(texts)))
    separator_scan.write_flat(df.limit(0), path)
    assert counts(spark, path) == []


def test_counts_lead_back_to_documents(spark):
    texts = {i * 7919 % 3001 - 50: " ".join(["word"] * (i % 40)) for i in range(400)}
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").repartition(5)
    path = scratch_dir(spark, "flat")
    separator_scan.write_flat(df, path, file_bytes=200)
    got = separator_scan.with_ids(separator_scan.count_tokens(spark, path), path).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(t.split()) + 1 for i, t in texts.items()}
    got = sorted(got, key=lambda r: r.ordinal)
    assert [r.doc_id for r in got] == sorted(texts) and [r.ordinal for r in got] == list(range(len(texts)))
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()


def test_repeated_and_null_ids(spark):
    rows = [(5, "a a"), (None, "b"), (5, "c c c"), (-1, None), (5, "a a"), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    path = scratch_dir(spark, "flat")
    separator_scan.write_flat(df, path)
    got = sorted(separator_scan.with_ids(separator_scan.count_tokens(spark, path), path).collect(), key=lambda r: r.ordinal)
    assert [r.doc_id for r in got] == [None, None, -1, 5, 5, 5]
    assert sorted(r.n_tokens for r in got[:2]) == [1, 2] and got[2].n_tokens == 1 and sorted(r.n_tokens for r in got[3:]) == [3, 3, 4]
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()


def test_numbers_of_many_files(spark):
    """More files in one partition than a range shuffle reads whole to find its borders."""
    paths = spark.range(0, 20000, 1, 1).select(F.md5(F.col("id").cast("string")).alias("path"), F.col("id").alias("n"), (F.col("id") + 1).alias("docs"))
    got = [(r.path, r.file) for r in separator_scan._numbered(paths).collect()]
    assert sorted(f for _, f in got) == list(range(20000))
    assert [p for p, _ in sorted(got, key=lambda g: g[1])] == sorted(p for p, _ in got)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="driver test data not present")
def test_query_counts_every_document(spark):
    from tokenizers import Tokenizer

    from kempt.llm.queries import QUERIES
    tk = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    tk.encode_special_tokens = True
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    got = sorted(tuple(r) for r in QUERIES["op6_separator_scan"](spark, "/root/testdata/sf0.01").select("ordinal", "start", "n_tokens").collect())
    assert sorted(n for *_, n in got) == sorted(len(tk.encode(d.text, add_special_tokens=False).ids) + 1 for d in docs)
    assert [o for o, *_ in got] == list(range(len(docs)))
    assert [s for _, s, _ in got] == np.concatenate([[0], np.cumsum([n for *_, n in got])[:-1]]).tolist()
