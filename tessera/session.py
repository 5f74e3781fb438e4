"""Session construction and cluster-shared scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session should carry. AQE re-plans joins from real shuffle
# sizes (broadcast switch, partition coalescing, skew-join splitting), which is
# what keeps a hot key from pinning one task at scale.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from compile-time guesses (compressed file size times a
    # column ratio says little about the in-memory size). AQE broadcasts a
    # join side only after its shuffle stage has run and its measured size is
    # under this threshold; explicit hints are kept for sides whose size is
    # bounded by construction (fixed dimensions, top-n, lexicons).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_MB = 1 << 20


def cluster_settings(total_cores: int, input_bytes: int) -> dict[str, str]:
    """Partition sizing for a cluster run, from the total executor cores and
    the bytes the job scans.

    * scan splits of 128 MB, 256 MB once the input passes 10 TB (fewer,
      still memory-safe tasks);
    * an initial shuffle width of about one partition per 512 MB of input
      (at least 3 per core), which AQE coalesces toward 256 MB partitions, so
      a 100 TB scan starts near 200k shuffle partitions rather than 200;
    * a skewed partition is one over 1 GB and 5x the median; AQE splits it.
    """
    split = 256 * _MB if input_bytes > 10 * (1 << 40) else 128 * _MB
    width = max(3 * total_cores, input_bytes // (512 * _MB))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * _MB),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * _MB),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set (a shared file system path). Only
    when it is unset -- local tests -- do we create one under ``fallback`` or
    a fresh temporary folder; with any other master and no
    ``fallback`` an unset folder is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not fallback and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = fallback or tempfile.mkdtemp(prefix="tessera-ckpt-")
    os.makedirs(path, exist_ok=True)
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
