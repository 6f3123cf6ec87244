"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (all elapsed-day features are
# computed in UTC), ANSI semantics (failed casts must be explicit try_cast),
# adaptive execution for runtime coalescing and skew-join splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Starting point for a large cluster (~1000 executors, ~100 TB input).  AQE
# coalesces the initial shuffle partitions down to the advisory size and
# splits skewed join partitions; scans read ~512 MB splits.  The checkpoint
# folder must be shared storage (it also holds the engine's scratch tables).
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.shuffle.service.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.storage.decommission.rddBlocks.enabled": "true",
}


def cluster_conf(checkpoint_dir: str) -> dict[str, str]:
    """Settings for a large cluster; ``checkpoint_dir`` on shared storage."""
    return {**BASE_CONF, **CLUSTER_CONF, "spark.checkpoint.dir": checkpoint_dir}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "featurelake", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass the cluster master and a
    ``spark.sql.shuffle.partitions`` sized to ~128-256 MB per partition."""
    # Python workers of a local session find this package from any folder
    root = str(Path(__file__).resolve().parent.parent)
    known = os.environ.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (root, known) if p)
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    This is the folder named by ``spark.checkpoint.dir``, which must be shared
    storage.  Where it is unset there is none: a temporary folder would be a
    different one on each machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the scratch root (never reused, never cleared)."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in this block delete their shuffle files when they are done; else
    the files of all writes stay until the driver happens to collect its
    garbage.  A write plans its query anew, so nothing reads them again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)
