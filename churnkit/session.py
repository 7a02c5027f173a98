"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the engine relies on.
#  * UTC session time: dates are derived from epoch milliseconds.
#  * AQE with skew-join splitting and partition coalescing: one user may
#    own a large share of all events.
#  * No Python call-site capture: with it, every PySpark function call
#    makes several extra driver round trips to record where it was called
#    (used only to annotate error messages).
#  * Checkpoint files are deleted once their RDD is garbage-collected, so
#    the shared checkpoint folder does not fill up with finished jobs.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "churnkit", extra: dict | None = None) -> SparkSession:
    """Local/test session builder. On a cluster, pass the cluster's own
    settings through ``extra`` (or use an existing session) instead."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local-mode session (local runs and tests)
    without one gets a private folder; on a cluster a machine-local folder
    would be unreadable from other executors, so the setting is required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder on shared storage "
                           "(e.g. HDFS or an object store) that every executor can read")
    local = tempfile.mkdtemp(prefix="churnkit-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def reliable_checkpoint(df):
    """Eager, reliable ``DataFrame.checkpoint`` into the shared checkpoint
    folder: cuts the lineage, and a lost executor re-reads the files
    instead of recomputing from the source."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/churnkit-{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
