"""Spark session defaults for local runs and tests.

On a cluster the session comes from the launcher; these helpers only fill in
settings that are unset, never override them.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime re-planning: AQE measures real shuffle sizes, coalesces small
# partitions, splits skewed join partitions and turns a join into a broadcast
# only when the measured side is below the adaptive threshold. The static
# threshold is off: it trusts compressed file sizes, which are not a bound on
# the in-memory size of a side; explicit broadcasts go through
# ``registrum.operators.joins.fits_broadcast``.
DEFAULTS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, partitions: int = 8, app: str = "registrum") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("REGISTRUM_DRIVER_MEMORY", "8g"))
    )
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return spark.checkpoint.dir, the folder that driver and executors share. Unset, a local
    session (tests) gets a scratch one; any other session must name it."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="registrum-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run sized from the input volume.

    The initial shuffle partition count is chosen so that each partition of
    the largest shuffle (about the input size for the merge and the master
    join) is near ``target_partition_bytes``; AQE then coalesces small
    partitions and splits skewed ones at run time, so a wrong guess costs
    little. Scan splits match the same size. The launcher applies these; the
    jobs never override a value the cluster already set.
    """
    partitions = max(200, min(200_000, input_bytes // target_partition_bytes + 1))
    return {
        **{k: v for k, v in DEFAULTS.items() if k != "spark.ui.enabled"},
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
    }
