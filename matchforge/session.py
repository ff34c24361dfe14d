"""Session helpers.

Library code never builds its own session: callers pass one in. These helpers
exist for tests and the bench, and for finding the shared folder that jobs use
for interchange files, landing zones and lineage cuts.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "matchforge", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("MATCHFORGE_DRIVER_MEMORY", "16g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None on a session without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # Connect sessions have no SparkContext
        return None


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session. Unset, a local master (tests) gets a folder of its
    own; on a cluster that is an error, since executors would not share it.
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else ""
        if not re.match(r"local(\[[^-]*)?$", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="matchforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def parallelism(spark: SparkSession) -> int:
    """Cores available to jobs (shuffle partitions when that is unknown)."""
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/matchforge/{name}-{uuid.uuid4().hex}"


def scale_settings(input_bytes: int, total_cores: int,
                   target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized for a run over ``input_bytes`` of parquet on
    ``total_cores`` executor cores (for example 100 TB on 1000 executors).

    Scan splits and shuffle partitions aim at ``target_partition_bytes`` so a
    task's working set fits executor memory and spills rarely; AQE coalesces
    small shuffle partitions and splits skewed ones at run time; broadcasts the
    planner chooses on its own stay small.
    """
    shuffle_parts = max(total_cores * 2, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(int(shuffle_parts)),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    }


def apply_settings(spark: SparkSession, settings: dict[str, str]) -> None:
    """Apply runtime SQL settings to an existing session."""
    for key, value in settings.items():
        spark.conf.set(key, value)
