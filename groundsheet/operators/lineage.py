"""Cutting lineage and checking sizes before a plan choice."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Shuffle files of a query are removed when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_OWN_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``; only a session without that
    setting (local tests) gets a temporary folder of its own.
    """
    named = spark.conf.get(SETTING, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder all executors share")
    if context.applicationId not in _OWN_FOLDERS:
        _OWN_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="groundsheet-")
    return _OWN_FOLDERS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write once to the shared folder and read back.

    Used where one result feeds several jobs: the work is done once, and a lost
    executor costs a re-read instead of a re-run of everything before it.  What the write
    shuffled goes from the disks as it ends, not when the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when the frame has at most ``max_rows`` rows; reads at most one row more."""
    return df.limit(max_rows + 1).count() <= max_rows


def spread(scan: DataFrame) -> DataFrame:
    """Deal a scan of few files over all cores before work that is heavy per row.

    Small layers often sit in one file with one row group, which Spark reads as one task.
    A scan that already has a task per core passes unchanged, so large data is never
    shuffled for this.  Only for plain scans: asking a frame with shuffles for its
    partitions would run them.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
