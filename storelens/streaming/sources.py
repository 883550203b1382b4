"""Streaming reads and runs over growing folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from storelens.sources.tables import table


def stream_table(spark: SparkSession, sf_dir: str, name: str, bytes_per_trigger: int = 8 << 30) -> DataFrame:
    """A table as a stream of its files.  The star also matches a table that is
    one file, which the file source would not take as a folder."""
    schema = table(spark, sf_dir, name).schema
    return (
        spark.readStream.schema(schema)
        .option("maxBytesPerTrigger", bytes_per_trigger)
        .parquet(f"{sf_dir.rstrip('/')}/{name}.parquet*")
    )


def closable(stream: DataFrame, folder: str) -> DataFrame:
    """``stream`` and whatever :func:`close` puts into ``folder``.

    The last windows and steps of a stream stay open until something later comes.  For a
    log that is complete, run what there is, then ``close`` the folder and run once more
    from the same checkpoint: the closing row lets the watermark pass all that is open.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).write.mode("append").parquet(folder)
    return stream.unionByName(spark.readStream.schema(stream.schema).parquet(folder))


def close(stream: DataFrame, folder: str, time: str = "ts", at: str = "2200-01-01 00:00:00") -> None:
    """Put a row of nulls with a late time into ``folder``.  What comes after it is late;
    the row itself has a window and a key of its own, which stay open."""
    row = [F.lit(at if f.name == time else None).cast(f.dataType).alias(f.name) for f in stream.schema.fields]
    stream.sparkSession.range(1).coalesce(1).select(*row).write.mode("append").parquet(folder)


def run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything that is there, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
