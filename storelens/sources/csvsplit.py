"""Records of delimited files whose fields hold line breaks, read by many tasks a file.

A reader that starts in the middle of such a file cannot know whether it is inside a
quoted field.  So every line is looked at twice, as if it began outside and as if it began
inside of quotes, which gives the state after it in both cases.  Such pairs compose: the
lines of a byte range make one, the ranges of a file are added up, one row each, and then
every line knows how it really begins.  A line that begins outside of quotes begins a
record, and numbers of records follow from counts in the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.session import durable

# A quoted field opens at the start of a field, and ends at a quote that is not doubled.
QUOTED = '"(?:[^"]++|"")*+"[^,]*+'
PLAIN = '[^",][^,]*+'
FIELDS = f"(?:(?:{QUOTED}|{PLAIN})?,)*+"
ENDS_INSIDE = f'(?s)^{FIELDS}"(?:[^"]++|"")*+$'
STAYS_INSIDE = r'(?s)^(?:[^"]++|"")*+$'
OPENS_AGAIN = f'(?s)^(?:[^"]++|"")*+"[^,]*+,{FIELDS}"(?:[^"]++|"")*+$'


def _after(start: Column, fixed: Column, flips: Column) -> Column:
    """The state after some lines: what the last line that settles it says, or else the
    state before them, turned over once per line that turns it over."""
    settled = (fixed["state"].cast("int") + flips - fixed["flips"]) % 2 == 1
    return F.when(fixed.isNotNull(), settled).otherwise((start.cast("int") + flips) % 2 == 1)


def records(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """(``file``, ``number``, ``text``): the records under ``path``, numbered from 1 in each file,
    blank ones left out.

    A record is one row, as long as it may be: a quote that is never closed makes the rest
    of its file one record.
    """
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    lines = durable(reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"),
    ))
    bare = F.regexp_replace("line", r"\r\z", "")
    outside, inside = bare.rlike(ENDS_INSIDE), bare.rlike(STAYS_INSIDE) | bare.rlike(OPENS_AGAIN)
    marked = lines.select(
        "file", "range", "place", F.when(outside == inside, outside).alias("settles"),
        (outside & ~inside).cast("int").alias("turns"),
    )
    # lines: running within a range, whose length the reader bounds
    upto = Window.partitionBy("file", "range").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    running = marked.withColumn("flips", F.sum("turns").over(upto)).withColumn(
        "fixed", F.last(F.when(F.col("settles").isNotNull(), F.struct(F.col("settles").alias("state"), "flips")), True).over(upto)
    )
    # ranges: a row each
    ends = running.groupBy("file", "range").agg(F.max_by(F.struct("flips", "fixed"), "place").alias("end"))
    ends = ends.select(
        "file", "range", F.when(F.col("end.fixed").isNotNull(), _after(F.lit(False), F.col("end.fixed"), F.col("end.flips"))).alias("settles"),
        F.when(F.col("end.fixed").isNull(), F.col("end.flips") % 2).otherwise(0).alias("turns"),
    )
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    summed = ends.withColumn("flips", F.sum("turns").over(before)).withColumn(
        "fixed", F.last(F.when(F.col("settles").isNotNull(), F.struct(F.col("settles").alias("state"), "flips")), True).over(before)
    ).withColumn("after", _after(F.lit(False), F.col("fixed"), F.col("flips")))
    in_file = Window.partitionBy("file").orderBy("range")
    starts = summed.select(
        F.col("file").alias("_file"), F.col("range").alias("_range"),
        F.coalesce(F.lag("after").over(in_file), F.lit(False)).alias("start"),
    )
    same_range = [F.col("file") == F.col("_file"), F.col("range") == F.col("_range")]
    begun = running.join(starts, same_range).drop("_file", "_range").withColumn("after", _after(F.col("start"), F.col("fixed"), F.col("flips")))
    in_range = Window.partitionBy("file", "range").orderBy("place")
    begun = begun.withColumn("begins", (~F.coalesce(F.lag("after").over(in_range), F.col("start"))).cast("int"))
    counted = begun.groupBy("file", "range").agg(F.sum("begins").alias("n"))
    earlier = counted.select(
        F.col("file").alias("_file"), F.col("range").alias("_range"), (F.sum("n").over(before) - F.col("n")).alias("earlier")
    )
    numbered = begun.withColumn("inner", F.sum("begins").over(upto)).join(earlier, same_range).select(
        F.col("place").alias("_place"), (F.col("inner") + F.col("earlier")).alias("number")
    )
    # the lines themselves join last, by their place, and move to their record once more
    whole = lines.join(numbered, F.col("place") == F.col("_place")).groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("range", "place", "line"))).alias("lines")
    )
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    return whole.select("file", "number", F.regexp_replace(text, r"\r\z", "").alias("text")).filter(F.length(F.trim("text")) > 0)


def parsed(found: DataFrame, schema: str, options: dict[str, str], header: bool) -> DataFrame:
    """The records as columns of ``schema``, with their ``file``; the first record of each
    file is left out if it is a header."""
    if header:
        first = found.groupBy(F.col("file").alias("_file")).agg(F.min("number").alias("_first"))
        found = found.join(first, F.col("file") == F.col("_file")).filter("number > _first")
    values = F.from_csv("text", schema, options)
    return found.select("file", values.alias("_values")).select("_values.*", "file")
