"""Session construction and the shared scratch location.

Scratch data (lineage cuts, staged tables, query outputs) always goes under the
folder the cluster names in ``spark.checkpoint.dir``.  Only when that setting is
absent (local tests) do we create one of our own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "kempt", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every operator here assumes."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001  (no SparkContext on Spark Connect)
        pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder: the SparkContext's checkpoint dir, else ``spark.checkpoint.dir``.

    With neither, a session whose master is ``local`` gets a temp folder (driver and
    executors are one machine there); any other master raises, because executors of a
    cluster would each write to a folder of their own and later reads would miss rows."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (e.g. a Spark Connect session has no SparkContext)
        sc = None
    root = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    master = sc.master if sc is not None else ""
    if not is_local(master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master!r})")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="kempt-ckpt-"))
    return sc.getCheckpointDir()


def is_local(master: str) -> bool:
    """True for ``local`` and ``local[...]``, where one process does everything."""
    return master == "local" or master.startswith("local[")


def _app_scratch(spark: SparkSession) -> str:
    root = checkpoint_root(spark).rstrip("/")
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001  (Spark Connect)
        app = "connect"
    return f"{root}/kempt/{app}"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name below the checkpoint root (never reused between calls);
    whoever writes there creates it."""
    return f"{_app_scratch(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> bool:
    """Delete everything this application wrote below the checkpoint root, through the file
    system's own API. Call it when no DataFrame that reads it is needed any more."""
    return path_delete(spark, _app_scratch(spark))


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system the path names."""
    p, fs = _path(spark, path)
    return fs.exists(p)


def path_delete(spark: SparkSession, path: str) -> bool:
    """Delete a file, or a folder with all below it."""
    p, fs = _path(spark, path)
    return fs.delete(p, True)


def materialize(df, name: str = "stage", observe: list | None = None):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Used where a plan would otherwise be computed twice (a statistic is fitted on
    it, then the rows are transformed with it).  Cuts the lineage too: a lost
    executor later re-reads the files instead of recomputing the shuffles
    before them.  A fresh folder per call, never overwritten.

    ``observe``: aggregate Columns computed during the same write
    (``DataFrame.observe``); then returns ``(frame, metrics dict)``.  Metrics
    are accumulated once per successful task, so retried tasks do not count twice."""
    from pyspark.sql import Observation
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    obs = None
    if observe:
        obs = Observation(f"{name}-metrics")
        df = df.observe(obs, *observe)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    return (out, dict(obs.get)) if obs is not None else out
