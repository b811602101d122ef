"""Pipelines in stages that can be taken up where they stopped (PL1).

A run is a list of stages, each a list of pipeline steps. A stage's fingerprint is a digest of the
input's identity and of all steps up to its end; its output is stored under that fingerprint. A run
starts behind the last stage whose output is complete, so a run broken in stage k resumes there, and
a changed parameter changes the fingerprints of its own stage and the later ones only.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kempt.plans.pipeline import PipelineError, check_steps, run_pipeline
from kempt.session import path_exists


def files_id(spark: SparkSession, path: str) -> str:
    """An identity of the files below ``path``: their names, sizes and times, summed up where they
    are listed; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    one = F.md5(F.concat_ws("|", "path", "length", F.unix_micros("modificationTime")))
    halves = [F.conv(F.substring(one, i, 12), 16, 10).cast("decimal(20,0)") for i in (1, 13)]
    r = files.agg(F.count(F.lit(1)), *[F.sum(h) for h in halves]).first()
    return "-".join(str(x or 0) for x in r)


def fingerprints(stages: Sequence[tuple[str, Sequence[Mapping]]], input_id: str, registry: Mapping[str, Callable] | None = None) -> list[str]:
    """One digest per stage: of the input, and of the enabled steps and parameters up to its end.
    A stage's name and steps that are switched off do not count."""
    out, so_far = [], hashlib.sha256(input_id.encode()).hexdigest()
    for name, steps in stages:
        try:
            what = json.dumps([[op, params] for op, _, params in check_steps(steps, registry)], sort_keys=True)
        except TypeError as e:
            raise PipelineError(f"stage {name!r}: parameters must be plain values, so that a run can be told from another ({e})") from None
        so_far = hashlib.sha256(f"{so_far}|{what}".encode()).hexdigest()
        out.append(so_far)
    return out


def run_stages(df: DataFrame, stages: Sequence[tuple[str, Sequence[Mapping]]], ledger: str, input_id: str,
               registry: Mapping[str, Callable] | None = None) -> DataFrame:
    """Fold the stages over ``df``, storing the output of each below ``ledger`` (a folder that
    driver and executors share and that outlives the session), and return the last one.

    ``input_id`` tells inputs apart (:func:`files_id` for files): with another one everything is
    computed anew.  All stages are checked before the first is run.  An output counts once Spark
    has committed it, so a lost executor or driver never leaves half of one behind; a stage that was
    cut off is written again.  Nothing is deleted: going back to earlier parameters finds their
    outputs.  No stages: ``df`` itself.  Two runs of one ledger at a time are not supported."""
    spark = df.sparkSession
    marks = fingerprints(stages, input_id, registry)
    paths = [f"{ledger.rstrip('/')}/{m[:32]}" for m in marks]
    done = next((k for k in range(len(stages), 0, -1) if path_exists(spark, f"{paths[k - 1]}/_SUCCESS")), 0)
    out = spark.read.parquet(paths[done - 1]) if done else df
    for k in range(done, len(stages)):
        run_pipeline(out, list(stages[k][1]), registry).write.mode("overwrite").parquet(paths[k])
        out = spark.read.parquet(paths[k])
    return out


def stages_done(spark: SparkSession, stages: Sequence[tuple[str, Sequence[Mapping]]], ledger: str, input_id: str,
                registry: Mapping[str, Callable] | None = None) -> list[tuple[str, bool]]:
    """(stage, whether its output is stored) for each stage of a run."""
    marks = fingerprints(stages, input_id, registry)
    return [(name, path_exists(spark, f"{ledger.rstrip('/')}/{m[:32]}/_SUCCESS")) for (name, _), m in zip(stages, marks, strict=True)]
