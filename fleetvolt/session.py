"""Session helpers: defaults sized for a cluster, overridable by whatever the cluster sets."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied only where the session does not already carry a value.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast a join side only when its measured/estimated size is below this; else sort-merge.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "fleetvolt") -> SparkSession:
    """A local session for tests and the benchmark (UI off, no ports beyond Spark's own)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
    )
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    log_dir = os.environ.get("FLEETVOLT_EVENT_LOG")
    if log_dir:   # stage/task timings without the UI: Spark's event log in a scratch folder
        os.makedirs(log_dir, exist_ok=True)
        b = (b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Fill in the defaults on an existing (cluster) session without overriding its settings."""
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (None when unset)."""
    sc = spark.sparkContext
    return spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session, which is left as it is set.

    Only a session on a local master, where the driver and the tasks are one process, may leave it
    unset and gets a scratch folder; elsewhere every executor would write to a disk of its own, so
    an unset folder raises.
    """
    d = checkpoint_dir(spark)
    if d:
        return d
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    d = tempfile.mkdtemp(prefix="fleetvolt-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(d)
    return d


def materialize(df, name: str = "intermediate"):
    """Cut the lineage of a small intermediate result that a plan uses more than once (such
    as a snapshot: one row per device), so the expensive part above it runs exactly once.

    The result is written as a parquet table into the shared folder named by
    ``spark.checkpoint.dir`` and read back: it survives the loss of executors (unlike a cache
    or a local checkpoint), is computed once (a reliable RDD checkpoint would compute it a
    second time to write it), and later scans of it still get column pruning and pushdown."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fleetvolt-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
