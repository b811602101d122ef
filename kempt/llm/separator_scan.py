"""Token counts of documents in flat, unindexed token files.

A file is nothing but ids of fixed width, each document followed by an end-of-document id. To
count, files are cut into blocks; each block finds its separators with one vectorised
search. Documents that lie in one block are counted there. A block also reports how many
ids lie before its first and after its last separator, and a prefix scan over the blocks
of a file stitches the documents that run across borders. The files' own totals, again
by a prefix scan, give each document its place in the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kempt.llm.common import id_text, n_parts, on_workers, prefix_sums, slices, stored
from kempt.llm.tokens import encoder, vocabulary


# Numbers of files: of one width, so that their order is that of their paths.
_FIRST, _PIECES = 10**15, 10**7


# ------------------------------------------------------------------ writing
def _encode(path: str, dtype: str, file_bytes: int):
    """Texts to the lines of two kinds of file: ids of documents, and the number and doc_id of each."""
    def run(batches):
        encode, piece, size, nth = encoder(path, dtype, plain=True), _FIRST + TaskContext.get().partitionId() * _PIECES, 0, 0
        for b in slices(batches):
            pieces, places, lines, index = [], [], [], []
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                ids = encode(text)
                if size and size + len(ids) > file_bytes:
                    piece, size, nth = piece + 1, 0, 0
                pieces.append(piece)
                places.append(nth)
                lines.append(ids)
                index.append(f"{nth}:{'' if doc_id is None else doc_id}".encode())
                size, nth = size + len(ids), nth + 1
            for kind, values in (("tokens", lines), ("index", index)):
                yield pa.record_batch([pa.array([kind] * len(pieces)), pa.array(pieces, pa.int64()), pa.array(places, pa.int64()), pa.array(values, pa.binary())],
                                      names=["kind", "piece", "nth", "value"])
    return run


def write_flat(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None,
               end_id: int = 49407, dtype: str = "<u2", file_bytes: int = 1 << 26) -> None:
    """Write flat token files: the ids of each document and ``end_id``, nothing else, in
    files of at most about ``file_bytes`` (more only if one document has more; a file has to stay
    below 2 GB to be read). Null text counts as empty; strings of special tokens in a text are
    ordinary text, so the end id ends documents only.

    Texts are encoded where they are read and nothing is shuffled: files hold documents as they
    come. The same job writes, under ``kind=index`` beside ``kind=tokens``, a line with the place
    and the id of each document of a file. Spark's text writer commits both on any file system; the
    end id is its line separator."""
    on_workers(docs.sparkSession)
    separator = np.array([end_id], dtype).tobytes().decode("latin-1")
    rows = id_text(docs, id_col, text_col).mapInArrow(
        _encode(vocab or vocabulary("word_bpe_49k.json"), dtype, file_bytes), "kind string, piece long, nth long, value binary")
    (rows.sortWithinPartitions("kind", "piece", "nth").select("kind", "piece", F.col("value").cast("string").alias("value"))
     .write.mode("overwrite").partitionBy("kind", "piece").option("lineSep", separator).option("encoding", "ISO-8859-1").text(path))


# ------------------------------------------------------------------ counting
def _scan(end_id: int, dtype: str):
    def run(batches):
        for b in batches:
            found = [np.frombuffer(raw.as_buffer(), dtype) == end_id for raw in b["raw"]]
            ends = [np.flatnonzero(f) for f in found]
            yield pa.record_batch([b["path"], b["block"], pa.array([len(f) for f in found], pa.int64()),
                                   pa.array(ends, pa.list_(pa.int64()))], names=["path", "block", "n_tokens", "ends"])
    return run


def count_tokens(spark: SparkSession, path: str, end_id: int = 49407, dtype: str = "<u2",
                 block_ids: int = 1 << 18) -> DataFrame:
    """One row per document of the files below ``path``: ordinal (documents before it, files
    in the order of their paths), start (ids before it), n_tokens (with the end id), path and
    place (documents before it in its file). An index that ``write_flat`` left is passed over.

    Ids after a file's last separator are a document without an end. Empty files have no
    documents; a folder without files gives no rows."""
    on_workers(spark)
    block = block_ids * np.dtype(dtype).itemsize
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).filter("length > 0")
    files = files.filter(~F.col("path").contains("/kind=index/"))
    cut = (files.select("path", "content", F.explode(F.expr(f"sequence(0L, (length - 1) div {block})")).alias("block"))
           .select("path", "block", F.expr(f"substring(content, cast(block * {block} + 1 as int), {block})").alias("raw")))
    blocks = stored(cut.mapInArrow(_scan(end_id, dtype), "path string, block long, n_tokens long, ends array<long>"),
                    "token-blocks").withColumn("n_ends", F.size("ends"))
    # stitch the blocks of a file: ids and ends before a block, and where its first document began
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    b = (blocks.withColumn("at", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
         .withColumn("nth", F.coalesce(F.sum("n_ends").over(before), F.lit(0)))
         .withColumn("begun", F.max(F.when(F.col("n_ends") > 0, F.col("at") + F.try_element_at("ends", F.lit(-1)) + 1)).over(before))
         .withColumn("is_last", F.lead("block").over(Window.partitionBy("path").orderBy("block")).isNull()))
    tail = F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(-1)) < F.col("n_tokens") - 1
    b = b.withColumn("ends", F.when(F.col("is_last") & tail, F.array_append("ends", F.col("n_tokens") - 1)).otherwise(F.col("ends")))
    docs = b.select("path", "nth", "at", F.coalesce("begun", F.lit(0)).alias("begun"), F.explode(F.transform(
        "ends", lambda e, i: F.struct(i.alias("i"), e.alias("end"), F.get("ends", i - 1).alias("previous")))).alias("d"))
    docs = docs.withColumn("start", F.coalesce(F.col("at") + F.col("d.previous") + 1, "begun"))
    # places of the files in the corpus
    per_file = b.groupBy("path").agg(F.sum("n_tokens").alias("n"), F.sum(F.size("ends")).cast("long").alias("docs"))
    placed = prefix_sums(stored(_numbered(per_file), "token-files"), "file", ["n", "docs"])
    return docs.join(placed.select("path", "n_before", "docs_before"), "path").select(
        (F.col("docs_before") + F.col("nth") + F.col("d.i")).alias("ordinal"),
        (F.col("n_before") + F.col("start")).alias("start"),
        (F.col("at") + F.col("d.end") + 1 - F.col("start")).alias("n_tokens"), "path", (F.col("nth") + F.col("d.i")).alias("place"))


def with_ids(counts: DataFrame, path: str, end_id: int = 49407, dtype: str = "<u2") -> DataFrame:
    """``counts`` of the files that ``write_flat`` wrote to ``path``, by document: doc_id, ordinal,
    start, n_tokens, the documents now in ascending order of doc_id (null first; rows of one id in
    the order of their files and places). Only this table of ids and counts is sorted."""
    separator = np.array([end_id], dtype).tobytes().decode("latin-1")
    lines = counts.sparkSession.read.schema("value string").option("lineSep", separator).option("encoding", "ISO-8859-1").option(
        "recursiveFileLookup", "true").text(f"{path}/kind=index")
    piece = F.regexp_extract(F.input_file_name(), r"piece=(\d+)", 1).cast("long")
    ids = lines.select(piece.alias("piece"), F.split_part("value", F.lit(":"), F.lit(1)).cast("long").alias("place"),
                       F.nullif(F.split_part("value", F.lit(":"), F.lit(2)), F.lit("")).cast("long").alias("doc_id"))
    placed = counts.select(F.regexp_extract("path", r"piece=(\d+)", 1).cast("long").alias("piece"), "place", "n_tokens")
    rows = _numbered(ids.join(placed, ["piece", "place"]), ["doc_id", "piece", "place"], "ordinal")
    return prefix_sums(stored(rows, "token-ids"), "ordinal", ["n_tokens"]).select(
        "doc_id", "ordinal", F.col("n_tokens_before").alias("start"), "n_tokens")


def _numbered(rows: DataFrame, order: list[str] = ["path"], out: str = "file") -> DataFrame:  # noqa: B006
    """``rows`` with a dense number ``out`` from 0 in the order of ``order``: each range is numbered
    by itself, then moved on by the sizes of the ranges before it. The ranges are written once:
    each range shuffle samples borders of its own, so sizes and numbers of two would not agree."""
    n = n_parts(rows.sparkSession)
    ranged = stored(rows.repartitionByRange(n, *order).withColumn("range", F.spark_partition_id()), "token-ranges")
    sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("size"))
    ids = rows.sparkSession.range(n).select(F.col("id").cast("int").alias("range"))
    base = prefix_sums(ids.join(sizes, "range", "left").select("range", F.coalesce("size", F.lit(0)).alias("size")),
                       "range", ["size"]).select("range", "size_before")
    w = Window.partitionBy("range").orderBy(*order)
    return (ranged.withColumn("nth", F.row_number().over(w) - 1).join(base, "range")
            .select((F.col("nth") + F.col("size_before")).alias(out), *rows.columns))
