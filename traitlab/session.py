"""Session helpers: a local session for tests/bench and checkpoint-dir handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "traitlab") -> SparkSession:
    """Session for tests and the local bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TRAITLAB_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune_for_scale(spark: SparkSession, advisory_mb: int = 128, max_partition_mb: int = 128, broadcast_mb: int = 64) -> None:
    """Settings for large inputs: AQE coalesces/splits shuffle partitions to
    ``advisory_mb`` and splits skewed join partitions; scans cut files into
    ``max_partition_mb`` splits; automatic broadcast stays below a fixed size
    (explicit broadcasts in this library are bounded by construction)."""
    conf = spark.conf
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{advisory_mb}m")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "4")
    conf.set("spark.sql.files.maxPartitionBytes", f"{max_partition_mb}m")
    conf.set("spark.sql.autoBroadcastJoinThreshold", f"{broadcast_mb}m")
    conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", f"{broadcast_mb}m")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name a shared folder; it is read, never
    invented.  Only a local-mode session without the setting (tests) gets a
    fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder for iterative jobs")
    path = tempfile.mkdtemp(prefix="traitlab-ckpt-")
    sc.setCheckpointDir(path)
    return path


def reliable_checkpoint(df):
    """Write ``df`` to ``spark.checkpoint.dir`` and return the DataFrame read
    back from there (lineage cut, survives executor loss).

    The rows are persisted first so the checkpoint write reads them instead of
    recomputing the plan a second time; the cache is released afterwards."""
    from pyspark import StorageLevel

    checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def scratch_table(df, name: str):
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Unlike a checkpointed RDD, later plans over the written table get column
    pruning and filter pushdown at the scan; the files live in the shared
    folder, so a lost executor costs nothing."""
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
