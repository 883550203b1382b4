"""A folder of delimited files, loaded file by file and never twice."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from storelens.sources.csvload import Loaded, mark_rejected, parse_options, read_loaded, with_bad_column
from storelens.streaming.sources import run_available


def load_new_files(
    spark: SparkSession, directory: str, schema: str, target: str, checkpoint: str, multi_line: bool = False
) -> Loaded:
    """Load the files that arrived since the last call.

    The checkpoint remembers the files that were read and the sink's log the
    files that were written, so a call repeated after a failure adds no row
    twice.
    """
    fields = with_bad_column(T.StructType.fromDDL(schema))
    arriving = spark.readStream.schema(fields).options(**parse_options(header=True, multi_line=multi_line)).csv(directory)
    writer = mark_rejected(arriving).writeStream.format("parquet").partitionBy("rejected").option("path", target)
    run_available(writer, checkpoint)
    return read_loaded(spark, target, schema)
