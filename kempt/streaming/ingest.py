"""ST1: process each newly arrived file once, with Structured Streaming.

The file source's checkpoint remembers which files were processed, so a
restarted query picks up exactly the files that arrived while it was down,
and never a file twice.  Each micro-batch is cleansed by the given row-wise
steps and written to ``<sink>/stream=<query id>/batch=<id>`` with overwrite: if a
batch is retried after a failure it replaces its own output instead of appending a
second copy, and a query that starts over with a new checkpoint has a new id, so its
batch 0 does not replace an older one.  The per-batch profile is made from the
written batch and stored the same way.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kempt.operators.quality import profile
from kempt.plans.pipeline import run_pipeline
from kempt.session import materialize
from kempt.sources.quarantine import parser_options, split_rows, with_record
from kempt.streaming.running import store_summary


def stream_steps(df: DataFrame, steps: Sequence[Mapping] | None) -> DataFrame:
    """Apply row-wise steps; works the same on a batch or a streaming frame."""
    return run_pipeline(df, steps or [])


def ingest_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                  schema: T.StructType | str, fmt: str = "parquet", steps: Sequence[Mapping] | None = None,
                  profile_dir: str | None = None, max_files_per_trigger: int | None = None,
                  options: Mapping[str, str] | None = None, available_now: bool = True,
                  quarantine_dir: str | None = None, required: Sequence[str] = (), running_dir: str | None = None):
    """Start (and with ``available_now`` run to completion) the ingest query.

    Reads new files of ``source_dir`` (not recursive; the schema is required
    for streaming file sources), applies ``steps``, writes cleansed rows to
    ``sink_dir`` and, if given, one profile row per column per batch to
    ``profile_dir``.  Returns the StreamingQuery (already stopped when
    ``available_now``).

    ``quarantine_dir`` (CSV and JSON): records that do not fit the schema, or lack a value in a
    column of ``required``, go there (reason, record, file), batch by batch in the same way, and
    the steps see the others only: a file of bad records does not stop the query.  Each batch is
    parsed once and written once before it is split.  A file that cannot be read at all (a
    broken archive) still stops it, as its rows would be lost without a word.

    ``running_dir``: a summary of each batch's cleansed rows is stored there; ``running_profile``
    merges them into the profile of everything that arrived."""
    if quarantine_dir:
        full, record = with_record(schema)
        given = {k: v for k, v in (options or {}).items() if k not in ("header", "sep")}
        header = str((options or {}).get("header", "false")).lower() == "true"
        r = spark.readStream.format(fmt).schema(full).options(
            **parser_options(fmt, record, header, None, (options or {}).get("sep", ","), given))
    else:
        r = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    src = r.load(source_dir)
    if quarantine_dir:
        stream_steps(src.drop(record), steps)  # raises for steps that a stream cannot take
        cleansed = src.select("*", F.col("_metadata.file_path").alias("file"))
    else:
        cleansed = stream_steps(src, steps)

    started, query_id = threading.Event(), []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        folder = f"stream={query_id[0]}/batch={batch_id}"
        if quarantine_dir:
            good, bad = split_rows(materialize(batch, "stream-parsed"), record, required)
            bad.write.mode("overwrite").parquet(f"{quarantine_dir}/{folder}")
            batch = stream_steps(good, steps)
        batch.write.mode("overwrite").parquet(f"{sink_dir}/{folder}")
        done = batch.sparkSession.read.schema(batch.schema).parquet(f"{sink_dir}/{folder}")
        if profile_dir:
            profile(done).write.mode("overwrite").parquet(f"{profile_dir}/{folder}")
        if running_dir:
            store_summary(done, f"{running_dir}/stream={query_id[0]}", batch_id)

    w = cleansed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    query = w.start()
    query_id.append(query.id)
    started.set()
    if available_now:
        query.awaitTermination()
    return query


def dedupe_stream(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """C1 on a stream: drop repeated keys within the watermark delay (bounded state)."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
