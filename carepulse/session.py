"""SparkSession helpers: sane defaults for local runs, checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for every job in this library.  AQE re-plans joins at
# runtime (broadcast when a shuffled side turns out small, skew-join splitting
# for hot keys) and coalesces tiny shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when that adds a shuffle downstream
    # (only happens when skew is detected at runtime)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Starting point for a large cluster (1000 executors, ~100 TB of input).
# Input splits of 512 MB keep the scan task count in the hundreds of
# thousands rather than millions; shuffles start wide and AQE coalesces them
# to ~256 MB partitions, so one setting serves the small lookups and the
# fact-sized joins.  ``parallelismFirst=false`` makes AQE honour the advisory
# size instead of maximising task count on a busy cluster.
CLUSTER_CONF = {
    **{k: v for k, v in DEFAULT_CONF.items() if k != "spark.ui.enabled"},
    "spark.sql.files.maxPartitionBytes": "512MB",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1GB",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.parquet.filterPushdown": "true",
}


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set runtime SQL options on an existing session (cluster jobs)."""
    for k, v in conf.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


# Single-machine runs only: shuffles of a few MB would otherwise be coalesced
# into 1-3 partitions and leave most cores idle.  Irrelevant at cluster scale,
# where partitions are far above this size and CLUSTER_CONF applies.
LOCAL_CONF = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "carepulse") -> SparkSession:
    """Build (or reuse) a local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**DEFAULT_CONF, **LOCAL_CONF}.items():
        builder = builder.config(k, v)
    parts = shuffle_partitions or (8 if cores == "*" else max(2, int(cores)))
    builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    builder = builder.config("spark.driver.memory", os.environ.get("CAREPULSE_DRIVER_MEM", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only when unset.

    On a cluster the folder must be shared storage named by the deployment in
    ``spark.checkpoint.dir``; we never invent a machine-local folder there.
    Only a local-mode session (tests, single-node bench) gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="carepulse-ckpt-"))
    return sc.getCheckpointDir()
