"""Session helpers for tests and the bench, and the shared scratch folder.

Library operators never build a session; they take DataFrames. The scratch
folder is the one the cluster names in ``spark.checkpoint.dir``: it is shared
by all executors, so written tables there survive the loss of an executor.
A private temporary folder is set only when the session names none (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces shuffle
# partitions from runtime sizes, splits skewed join partitions, and the
# broadcast threshold is the size check behind every automatic broadcast.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state off the JVM heap, checkpointed incrementally.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def cluster_settings(input_bytes: int, total_cores: int,
                     target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a cluster run: scans split at 256 MB, shuffles
    start with enough partitions that each holds about 256 MB (at least two
    per core) and AQE coalesces what turns out smaller at run time; skewed
    partitions beyond 4x the median are split. For 100 TB over 1000
    executors of 8 cores this gives about 400k initial shuffle partitions."""
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(target_partition_bytes // 8),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "hazeline", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_dir(spark)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for written tables and stream checkpoints.

    Read from ``spark.checkpoint.dir``, scheme and all. A private folder is made
    only for a ``local`` master that names none (tests); a cluster without one
    is an error, as its executors would each write to a disk of their own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - connect sessions have no context
            d = None
    if not d:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="hazeline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    return os.path.join(scratch_dir(spark), "hazeline", *parts)


def written(df: DataFrame, label: str) -> DataFrame:
    """The table written to the shared folder and read back: lineage is cut, and
    what isn't determined by the input (a deal of rows) is fixed."""
    path = scratch_path(df.sparkSession, "tables", f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
