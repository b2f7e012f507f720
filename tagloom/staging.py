"""Intermediate tables in the cluster's shared folder.

A table that several later steps read is written once to the folder named by
``spark.checkpoint.dir`` and read back. Unlike a cache it survives the loss of
executors, and unlike a checkpoint it stays columnar, so later scans still prune.
"""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a new local one only in local mode."""
    configured = (spark.conf.get(CHECKPOINT_SETTING, None)
                  or spark.sparkContext.getCheckpointDir())
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tagloom-")


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{scratch_dir(spark)}/tagloom/{label}-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame, label: str, partition_by: str | None = None):
    """Write the rows to a new table and yield a scan of it; removed when the block ends."""
    spark = df.sparkSession
    path = new_path(spark, label)
    try:
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, wherever it is stored."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)

