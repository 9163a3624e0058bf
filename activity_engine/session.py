"""SparkSession helpers.

The library never hard-codes a master or a scratch folder: on a cluster the
session and its ``spark.checkpoint.dir`` come from the deployment. Only tests
and the local bench fill in a checkpoint folder, and only when it is unset.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ui.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "activity-engine",
                  checkpoint_dir: str | None = None) -> SparkSession:
    """Local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "16g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def ensure_session_conf(spark: SparkSession) -> None:
    """Pin settings the operators rely on (UTC clock for date keys).

    A cached frame has as many partitions as its size asks for: with one for each shuffle
    partition, however small, the next shuffle writes the square of their number of files.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder, setting ``fallback`` only if unset."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get()
    if fallback is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is unset; point it at a shared folder")
        import tempfile
        fallback = tempfile.mkdtemp(prefix="ae-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the session's shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), *parts])


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int = 4,
               target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run sized from the input volume.

    Scan splits and post-shuffle partitions target ``target_partition_bytes``
    (256 MiB: a task's working set stays well inside a 4-core executor's
    memory), the initial shuffle width covers the whole input at that size
    (at least 3 tasks per core), and AQE coalesces small partitions and splits
    skewed ones at runtime. 100 TB on 1000 executors gives ~400k initial
    shuffle partitions, which AQE coalesces after the partial aggregates.
    """
    cores = max(1, executors * cores_per_executor)
    parts = max(3 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        # Broadcast only what AQE measured small at runtime.
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)
