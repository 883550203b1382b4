"""JSON sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.session import durable


# What a JSON text consists of, for counting brackets: escapes, strings, an open string.
ESCAPE = r"\\."
STRING = '"[^"]*+"'
OPEN_STRING = '"[^"]*+$'
BEFORE_OBJECT = r"""(?s)^(?:[^"{]|"(?:[^"\\]|\\.)*+")*+"""


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """(``file``, ``text``): the objects in the JSON array of each file, or the one object of
    a file that is no array.

    A file is cut at closing braces, which any task can find from anywhere in it.  Whether
    a piece begins inside a string follows from the number of quotes before it, and its
    depth from the brackets before it that stand outside of strings; both are sums, taken
    within a byte range and then over the ranges, a row each.  A piece that ends at the
    depth of the elements ends one.  Of a file that breaks off the whole objects are kept.
    """
    pieces = durable(spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("place"), F.col("value").alias("piece"),
    ))
    # a file that does not end with a brace has one brace less than pieces
    files = pieces.groupBy("file").agg(
        (F.sum(F.octet_length("piece").cast("long") + 1) <= F.max("size")).alias("closed"),
        F.max(F.struct("range", "place")).alias("last"),
        F.min_by(F.ltrim("piece"), F.struct("range", "place")).startswith("[").cast("int").alias("base"),
    )
    plain = F.regexp_replace("piece", ESCAPE, "")
    quotes = F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))
    bare = pieces.withColumns({"plain": plain, "odd": quotes % 2})

    def summed(rows: DataFrame, what: str, before: str) -> DataFrame:
        """``before``: the sum of ``what`` over all earlier pieces of the file."""
        upto = Window.partitionBy("file", "range").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        over = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        totals = rows.groupBy("file", "range").agg(F.sum(what).alias("_total"))
        starts = totals.select(
            F.col("file").alias("_file"), F.col("range").alias("_range"), F.coalesce(F.sum("_total").over(over), F.lit(0)).alias("_start")
        )
        inner = rows.withColumn(before, F.coalesce(F.sum(what).over(upto), F.lit(0)))
        joined = inner.join(starts, (F.col("file") == F.col("_file")) & (F.col("range") == F.col("_range")))
        return joined.withColumn(before, F.col(before) + F.col("_start")).drop("_file", "_range", "_start")

    begins_inside = F.col("quotes_before") % 2 == 1
    code = F.when(begins_inside, F.concat(F.lit('"'), F.col("plain"))).otherwise(F.col("plain"))
    code = F.regexp_replace(F.regexp_replace(code, STRING, ""), OPEN_STRING, "")

    def many(marks: str) -> Column:
        return F.length(code) - F.length(F.translate(code, marks, ""))

    last = F.struct("range", "place") == F.col("last")
    brace = (F.col("quotes_before") + F.col("odd")) % 2 == 0
    facts = summed(bare, "odd", "quotes_before").join(files, "file").select(
        "file", "range", "place", "base", (brace & (~last | F.col("closed"))).alias("brace"),
        (many("{[") - many("}]") - F.when(brace, 1).otherwise(0)).alias("deeper"),
    )
    deep = summed(facts, "deeper", "depth_before").withColumn(
        "ends", (F.col("brace") & (F.col("depth_before") + F.col("deeper") == F.col("base"))).cast("int")
    )
    numbered = summed(deep, "ends", "number").select(F.col("place").alias("_place"), "number", "ends")
    elements = pieces.join(numbered, F.col("place") == F.col("_place")).groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("range", "place", "piece"))).alias("pieces"), F.max("ends").alias("whole")
    ).filter("whole = 1")
    text = F.concat(F.array_join(F.transform("pieces", lambda x: x["piece"]), "}"), F.lit("}"))
    return elements.select("file", F.regexp_replace(text, BEFORE_OBJECT, "").alias("text"))


def read_records(spark: SparkSession, path: str, schema: str, required: str) -> DataFrame:
    """Records of files that hold one JSON array each, read by many tasks a file.

    Records without the required field (a file that is not an array of records
    reads as those) are left out.
    """
    values = F.from_json("text", schema)
    return array_elements(spark, path).select(values.alias("_r")).select("_r.*").filter(F.col(required).isNotNull())


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_report(metrics: DataFrame, details: DataFrame, path: str) -> None:
    """Metrics and detail rows as two tables, and the nested summary (bounded by
    the number of metric rows) as one JSON text, made of the metrics as written."""
    write_lines(metrics, f"{path}/metrics")
    write_lines(details, f"{path}/details")
    written = metrics.sparkSession.read.schema(metrics.schema).json(f"{path}/metrics")
    nested_report(written).write.mode("overwrite").text(f"{path}/summary")


def nested_report(metrics: DataFrame) -> DataFrame:
    """Metric rows (one per difficulty) as one JSON object."""
    overall = F.max(F.when(F.col("level") == "overall", F.col("total")))
    rows = F.sort_array(F.collect_list(F.struct(*metrics.columns)))
    return metrics.agg(
        F.to_json(
            F.struct(F.struct(overall.alias("total_questions")).alias("metadata"), rows.alias("metrics"))
        ).alias("report")
    )
