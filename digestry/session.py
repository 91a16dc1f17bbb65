"""Session settings and staging of shared intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
STAGING_CONF = "digestry.staging.dir"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings every job relies on. Partition counts and memory belong to the cluster and are not set here.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key may hold a third of all rows, so a partition counts as skewed early.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Best-per-key selections prune each input partition whatever their limit.
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the job settings to an existing session."""
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("digestry")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder for staged tables and stream checkpoints, as named by the cluster.

    `spark.checkpoint.dir` decides. Where it is unset, STAGING_CONF may name a
    folder; only a local session then falls back to a temporary one, because on
    a cluster that folder would exist on one machine only.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.conf.get(STAGING_CONF, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="spark-")
    spark.conf.set(STAGING_CONF, folder)
    return folder


def application_dir(spark: SparkSession) -> str:
    """Folder of everything this application has staged."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{application_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, compression: str = "snappy", tidy: bool = False) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Used where several branches of one plan read the same result of a large
    scan. A written table survives lost executors and carries its size, so the
    planner can choose broadcast joins from real numbers. With `tidy` the shuffle
    files of this write go as soon as it is done, not when the driver happens to
    collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF)
    try:
        spark.conf.set(SHUFFLE_CLEANUP_CONF, str(tidy or before == "true").lower())
        df.write.mode("errorifexists").option("compression", compression).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP_CONF, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application has staged; to be called when its results are written."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(application_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
