"""Session helpers: local sessions for tests/bench and the shared work folder.

Jobs that write intermediate tables (layouts, bucketed tables, daily
snapshots) put them under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (local tests)
do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", app: str = "cumulo", extra: dict | None = None) -> SparkSession:
    """A local session with the settings the tests and bench use."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.driver.memory", os.environ.get("CUMULO_DRIVER_MEMORY", "16g"))
    for k, v in {**_LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Reads ``spark.checkpoint.dir`` (conf) or the SparkContext checkpoint
    dir.  If neither is set, a local session gets a fresh folder, registered
    so that later calls agree on it; on a cluster, where executors do not see
    the driver's folders, that is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root and not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="cumulo-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        # DataFrame.checkpoint() needs the context's folder too
        sc.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder for a job's own tables."""
    root = checkpoint_root(spark).rstrip("/")
    leaf = "/".join(parts) if parts else "work"
    if unique:
        leaf = f"{leaf}-{uuid.uuid4().hex[:12]}"
    return f"{root}/cumulo/{leaf}"


def sizing_conf(input_bytes: int, target_partition_bytes: int = 256 * 1024 * 1024,
                executor_cores: int = 4, executors: int = 1000) -> dict:
    """Settings that keep shuffle and scan partitions near a target size.

    For a job reading ``input_bytes``: enough initial shuffle partitions
    that each holds about ``target_partition_bytes`` (AQE then coalesces
    small ones and splits skewed ones), never fewer than one wave of tasks
    over the cluster, and scan splits of the same size.  Returns a dict to
    pass to ``SparkSession.builder.config`` or ``session_conf``.
    """
    slots = executor_cores * executors
    parts = max(slots, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        # start-up setting: delete reliable checkpoints (SCD2's chunked rows)
        # once their DataFrame is garbage-collected on the driver
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
