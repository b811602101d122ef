"""The corpus pipeline: ``documents`` pass through the stages below in this order.

Each stage works on all rows that its predecessor kept; all but the last return them with
the columns of ``documents``. Toxic documents and all but one of each group of exact or near
copies go; mixing repeats documents of small sources; packing lays what is left into
sequences and returns its pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kempt.llm import exact_dedup, mixing, packing, simhash, toxicity
from kempt.llm.common import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity grammar rejects."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints link: 3-word shingles, at most 3 bits."""
    return simhash.drop_near_copies(docs, shingle=3, distance=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture of its source asks, at least once."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("SimHash near-dedup", drop_near_copies),
          ("mixing sources to target weights", mix_sources), ("packing", pack)]

#: Learned scores, SimHash components and tokenizers are beyond SQL; tests/llm/test_pipeline.py
#: holds the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` through all stages, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
