"""Session construction and the shared checkpoint folder.

On a cluster the deployment names a shared folder in
``spark.checkpoint.dir``; jobs read it from the session and only set their
own value when it is unset (tests, local runs).
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpointed copies are deleted once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.cleaner.periodicGC.interval": "5min",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "tessera",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named in ``spark.checkpoint.dir``. Only a
    local session, whose executors share the driver's disk, gets a folder of
    its own when the setting is missing; on a cluster that is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for job-owned tables
    (stream checkpoints, copies written to cut lineage)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), "tessera", *parts])


def size_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int = 4 * 1024 * 1024) -> None:
    """Let adaptive execution begin with a shuffle partition per
    ``partition_bytes`` of compressed input, where the session has fewer: it
    joins small partitions, but splits large ones of skewed joins only, so a
    fixed number of partitions grows them with the input."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-input_bytes // partition_bytes)
    if wanted > now:
        spark.conf.set(key, str(wanted))


def size_listings(spark: SparkSession, per_core: int = 4) -> None:
    """Let a listing of many paths take a few tasks per core, where the session
    has Spark's default of a task per path up to 10,000: starting a task takes
    longer than looking up some hundred files."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if int(spark.conf.get(key)) == 10_000:
        spark.conf.set(key, str(per_core * spark.sparkContext.defaultParallelism))


def sizing_conf(input_bytes: int, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of compressed input: shuffle
    partitions so that one partition is about ``partition_bytes`` (AQE
    coalesces small ones and splits skewed ones at run time), scan splits
    of the same size, and the skew-join thresholds tied to it."""
    partitions = max(200, -(-input_bytes * 3 // partition_bytes))  # ~3x expansion once decoded
    size = str(partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }
