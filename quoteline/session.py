"""Session settings and shared scratch locations.

The library never creates a session on its own inside an operator; these helpers exist for
tests, the bench and command-line use.  On a cluster the caller's session is used as is.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session used with this library should carry.  Times are epoch milliseconds
# computed without the session zone, but UTC keeps displayed timestamps unambiguous.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Suggested settings for a large cluster over ~100 TB of Parquet (applied by the caller, e.g. as
# ``--conf`` options; the library never changes a cluster session's settings):
#  * 512 MB input splits keep the scan at about 200k tasks;
#  * a high initial shuffle width that AQE coalesces to ~256 MB partitions, so the widest shuffle
#    (a join of the two largest tables, or the depth output) never spills per task;
#  * AQE skew-join splitting for hot join keys; the default broadcast threshold, never raised.
CLUSTER_SETTINGS = {
    **SESSION_DEFAULTS,
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.autoBroadcastJoinThreshold": "10m",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quoteline") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("QUOTELINE_DRIVER_MEMORY", "8g"))
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is read, never changed; where it
    is unset there, that is an error, because executors do not share the driver's disk.  Only a local
    session without it (tests) gets a fresh folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no context: read the setting only
        sc = None
    if sc is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            return current.rstrip("/")
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="quoteline-ckpt-")
    sc.setCheckpointDir(local)
    return (sc.getCheckpointDir() or local).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique sub-folder of the shared checkpoint folder (never reused)."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df, eager: bool = True):
    """Materialise ``df`` in the shared checkpoint folder and return it with its lineage cut.

    Uses ``DataFrame.checkpoint`` (reliable: files in ``spark.checkpoint.dir``, which survive
    the loss of any executor), never a local checkpoint.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)
