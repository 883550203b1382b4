"""Session settings and durable intermediate results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library is written for.  Partition counts are left to the
# cluster: AQE coalesces small shuffles and splits skewed ones at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(
    cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g", folder: str | None = None
) -> SparkSession:
    """A single-machine session for tests and the benchmark, with its tables in ``folder``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("storelens")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    if folder:
        builder = builder.config("spark.sql.warehouse.dir", f"{folder}/warehouse")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, or the warehouse
    folder where that is not set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


_written: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder, until :func:`drop_scratch`."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application.  Results that were made of
    them and not yet written or collected cannot be read any more."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    For results whose values depend on where a row was computed (partition
    numbers), which a lost executor must not recompute differently, and for
    results read more than once.  The size of what was written is known to the
    planner.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "durable")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
