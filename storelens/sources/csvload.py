"""Loading delimited files into typed tables, with bad rows kept apart.

A load is one pass: good and bad rows are written next to each other, split by
the partition column ``rejected``, and the load replaces what was there, so
loading twice equals loading once.

Files are split between tasks at line ends.  A table whose fields hold line breaks
needs ``multi_line``: its records are found by :mod:`storelens.sources.csvsplit`, which
reads a file by many tasks as well.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.sources import csvsplit
from storelens.sources.retail_schemas import TableFile
from storelens.sources.warehouse import replace_folder

BAD = "_bad_line"
FILE = "_file"
REPORT_SCHEMA = "table_name string, file string, rows_loaded long, errors_seen long, failure string"


@dataclass(frozen=True)
class Loaded:
    """One loaded table: rows, quarantined lines, and the report per file."""

    rows: DataFrame
    quarantine: DataFrame
    report: DataFrame


def parse_options(header: bool, multi_line: bool = False) -> dict[str, str]:
    return {
        "multiLine": str(multi_line).lower(),
        "header": str(header).lower(),
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": BAD,
    }


def with_bad_column(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])


def mark_rejected(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "*", F.col("_metadata.file_path").alias(FILE), F.col(BAD).isNotNull().alias("rejected")
    )


def load_csv(
    spark: SparkSession, path: str, schema: str, target: str, pattern: str | None = None, header: bool = True,
    multi_line: bool = False, recursive: bool = False,
) -> Loaded:
    """Load the files under ``path`` (those matching ``pattern``; with ``recursive``, also in
    folders below it) into ``target``."""
    fields = T.StructType.fromDDL(schema)
    if multi_line:
        options = parse_options(header, multi_line)
        found = csvsplit.parsed(
            csvsplit.records(spark, path, pattern, recursive), with_bad_column(fields).toDDL(), options, header
        )
        marked = found.withColumnRenamed("file", FILE).withColumn("rejected", F.col(BAD).isNotNull())
        replace_folder(spark, target, lambda folder: marked.write.partitionBy("rejected").parquet(folder))
        return read_loaded(spark, target, schema)
    reader = spark.read.schema(with_bad_column(fields)).options(**parse_options(header, multi_line))
    reader = reader.option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    replace_folder(
        spark, target, lambda folder: mark_rejected(reader.csv(path)).write.partitionBy("rejected").parquet(folder)
    )
    return read_loaded(spark, target, schema)


def read_loaded(spark: SparkSession, target: str, schema: str) -> Loaded:
    fields = T.StructType.fromDDL(schema)
    stored = T.StructType(
        [*with_bad_column(fields).fields, T.StructField(FILE, T.StringType()), T.StructField("rejected", T.BooleanType())]
    )
    everything = spark.read.schema(stored).parquet(target)
    report = everything.groupBy(F.col(FILE).alias("file")).agg(
        F.count_if(~F.col("rejected")).alias("rows_loaded"), F.count_if(F.col("rejected")).alias("errors_seen")
    )
    return Loaded(
        rows=everything.filter(~F.col("rejected")).select(*fields.names),
        quarantine=everything.filter("rejected").select(F.col(FILE).alias("file"), F.col(BAD).alias("line")),
        report=report,
    )


def load_all(
    spark: SparkSession, directory: str, target: str, files: Iterable[TableFile], header: bool = True,
    recursive: bool = False,
) -> DataFrame:
    """Load each table from the files of one directory and report per file (by its whole
    path); a table that fails is reported with the reason and does not stop the others."""
    report = spark.createDataFrame([], REPORT_SCHEMA)
    for item in files:
        try:
            loaded = load_csv(
                spark, directory, item.schema, f"{target}/{item.table}", item.pattern, header, item.multi_line, recursive
            )
            found = loaded.report.select(
                F.lit(item.table).alias("table_name"), "file", "rows_loaded", "errors_seen",
                F.lit(None).cast("string").alias("failure"),
            )
        except Exception as error:  # reported, so that the other tables still load
            reason = f"{type(error).__name__}: {error}"
            found = spark.createDataFrame([(item.table, None, 0, 0, reason)], REPORT_SCHEMA)
        report = report.unionByName(found)
    return report
