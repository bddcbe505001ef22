"""Spark session and checkpoint-directory helpers.

The library never creates its own session on a cluster; callers pass one in.
``get_spark`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on: UTC event time, adaptive execution with
# skew-join splitting, Arrow for the few pandas steps.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tripstream", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("TRIPSTREAM_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf["spark.driver.memory"] = os.environ.get("TRIPSTREAM_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must point at shared storage and is only read.
    Only a local-mode session without the setting gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative jobs need a shared checkpoint folder")
    path = tempfile.mkdtemp(prefix="tripstream-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict:
    """Suggested shuffle/scan settings for a cluster run over ``input_bytes``.

    Shuffle partitions start at about one per ``target_partition_bytes`` of input
    (at least 2 waves of the cores) and adaptive execution coalesces small ones
    at runtime and splits skewed join partitions, so each reduce task stays well
    inside executor memory instead of spilling heavily.
    """
    parts = max(2 * total_cores, int(input_bytes // target_partition_bytes) + 1)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
