"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; the warehouse folder where that is unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def drop(spark: SparkSession, *paths: str) -> None:
    """Remove intermediate tables written by :func:`stored`."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


#: Shuffle files go as soon as the execution they belong to has ended, not when the driver
#: happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and go on from there, so that a lost executor never has
    to work it out again.  What was shuffled for it is removed from the executors' disks."""
    spark = df.sparkSession
    writer = df.write.mode("overwrite")
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
