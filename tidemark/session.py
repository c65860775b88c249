"""Session helpers for tests, the bench and local runs.

Library code never builds its own session; callers pass one in.  The helpers
here only exist so tests and ``bench.py`` start Spark the same way.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every local run uses.  On a cluster these come from spark-submit.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidemark", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for key, value in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    ``spark.checkpoint.dir`` (or the context's own) is used as is.  Without one
    only a ``local`` session, whose executors are this process, gets a fresh
    temp folder; a cluster session raises.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    target = spark.conf.get("spark.checkpoint.dir", None)
    if not target:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        target = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    spark.sparkContext.setCheckpointDir(target)
    return spark.sparkContext.getCheckpointDir() or target


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written intermediate tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int = 4,
                 target_partition_bytes: int = 256 * 1024 ** 2,
                 shuffle_share: float = 0.05) -> dict[str, str]:
    """Spark settings sized for a job reading ``input_bytes`` on a cluster.

    * scan splits of ``target_partition_bytes`` (many small per-ticker CSVs
      are packed into splits by the open-cost setting);
    * a shuffle width from what is shuffled, not from what is read: every large
      reduction is combined before its shuffle, so about ``shuffle_share`` of
      the input moves.  At least 2 tasks per core, which AQE coalesces;
    * AQE skew handling for the joins (a partition 5x the median and over
      the advisory size is split);
    * RocksDB state store for the stream questions' window state.
    Pass the result to ``SparkSession.builder.config(map=...)``/spark-submit.
    """
    cores = max(1, executors * cores_per_executor)
    moved = int(input_bytes * shuffle_share)
    shuffle = max(2 * cores, -(-moved // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.files.openCostInBytes": str(8 * 1024 ** 2),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
