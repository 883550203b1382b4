"""Exact median of a column too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BINS = 1024
BRACKET_ROWS = 100_000


def exact_median(df: DataFrame, column: str, name: str, bracket_rows: int = BRACKET_ROWS) -> DataFrame:
    """Median as a one-row DataFrame (NULL values are left out).

    The middle is enclosed by histograms: a pass counts the values between two bounds in
    equal bins, and the bins of the middle values become the next bounds, until at most
    ``bracket_rows`` values lie between them or all of those are equal.  Each pass divides
    the range by the number of bins and returns a row per bin.  Only the enclosed values,
    collapsed to (value, count), are ranked in one task.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    size = values.agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).first()
    if not size.n:
        return values.agg(F.lit(None).cast("double").alias(name))
    # 0-based ranks of the one or two middle values
    first, second = (size.n - 1) // 2, size.n // 2
    low, high, inside, below = size.low, size.high, size.n, 0
    while inside > bracket_rows and low < high:
        step = high / BINS - low / BINS
        place = F.least(F.floor((F.col("v") - low) / step), F.lit(BINS - 1)) if step > 0 else (F.col("v") > low).cast("long")
        bins = (
            values.filter(F.col("v").between(low, high))
            .groupBy(place.alias("bin"))
            .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .orderBy("bin")
            .collect()
        )
        upto, kept = below, []
        for row in bins:
            if upto <= second and upto + row.n > first:
                kept.append((upto, row))
            upto += row.n
        if len(kept) == 2:  # the middle lies between two bins: the last of one, the first of the other
            middle = (kept[0][1].high + kept[1][1].low) / 2
            return df.sparkSession.range(1).select(F.lit(middle).alias(name))
        below, (low, high, inside) = kept[0][0], (kept[0][1].low, kept[0][1].high, kept[0][1].n)
    counts = values.filter(F.col("v").between(low, high)).groupBy("v").agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.orderBy("v")) + below
    ranked = counts.withColumn("upto", upto)
    return ranked.agg(
        (
            (
                F.min(F.when(F.col("upto") > first, F.col("v")))
                + F.min(F.when(F.col("upto") > second, F.col("v")))
            )
            / 2
        ).alias(name)
    )
