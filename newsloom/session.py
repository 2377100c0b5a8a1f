"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A shuffle starts with many parts, which are joined up to this size: a task's share, and so its
    # memory, stays the same as the tables grow, and sorts and counts need not spill.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2048",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # The same for scans: stored postings and blocks meet the queries in the task that reads them, and by
    # default what one task reads grows with the table, up to 128 MB.
    "spark.sql.files.maxPartitionBytes": "8m",
    # The keyword candidate cap is 2000 rows per query. Above this threshold Spark would
    # skip the map-side limit of a ranked window and shuffle every scored pair.
    "spark.sql.optimizer.windowGroupLimitThreshold": "5000",
    # A finished job's shuffle files go at once, not when the driver next collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Lists up to this length reach the Parquet reader word by word; see keyword.SHORT_WORD_LIST.
    "spark.sql.parquet.pushdown.inFilterThreshold": "200",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on; all are runtime SQL settings."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    A temporary folder stands in only for a local master, where driver and executors are
    one process; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="newsloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpoint(df):
    """Cut the lineage of df with a reliable checkpoint in the shared folder."""
    folder = shared_dir(df.sparkSession)
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
