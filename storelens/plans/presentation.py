"""Reducing a result to what a table or a chart can show."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# Names that look like measures, and names that look like keys.
MEASURE_ENDINGS = ("_count", "_total", "_sum", "_avg", "_revenue", "_score", "_days", "_time")
KEY_ENDINGS = ("_id", "_key", "_prefix")
CHART_ROWS = 500
UPRIGHT_CATEGORIES = 7


@dataclass(frozen=True)
class Chart:
    """Chart kind ('line', 'bar' or 'scatter') and its two columns."""

    kind: str
    x: str
    y: str

    @property
    def title(self) -> str:
        word = {"line": "over", "bar": "by", "scatter": "vs"}[self.kind]
        return f"{self.y} {word} {self.x}"


def column_kinds(schema: T.StructType) -> dict[str, list[str]]:
    """Column names by kind; booleans count as categories."""
    kinds: dict[str, list[str]] = {"datetime": [], "numeric": [], "categorical": []}
    for field in schema.fields:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            kinds["datetime"].append(field.name)
        elif isinstance(field.dataType, T.NumericType):
            kinds["numeric"].append(field.name)
        else:
            kinds["categorical"].append(field.name)
    return kinds


def choose_chart(schema: T.StructType) -> Chart | None:
    """The chart that fits the column types, or None."""
    if len(schema.fields) < 2:
        return None
    kinds = column_kinds(schema)
    numeric, categories = kinds["numeric"], kinds["categorical"]
    if kinds["datetime"] and numeric:
        return Chart("line", kinds["datetime"][0], numeric[0])
    if categories and numeric:
        measures = [c for c in numeric if c.lower().endswith(MEASURE_ENDINGS)]
        names = [c for c in categories if not c.lower().endswith(KEY_ENDINGS)]
        return Chart("bar", (names or categories)[0], measures[0] if measures else numeric[-1])
    if len(numeric) >= 2:
        return Chart("scatter", numeric[0], numeric[1])
    return None


def chart_frame(df: DataFrame, rows: int = CHART_ROWS) -> DataFrame | None:
    """What is drawn, in at most ``rows`` rows: ``x``, ``y``, the number of ``points``
    behind them, kind and orientation.  None when no chart fits.

    Bars: the tallest.  Lines: the range of x in equal steps, with the first x and the
    mean y of each, and its ``low``, ``high``, ``first`` and ``last`` y, so that no peak is
    lost.  Scatters: a grid over both ranges, with the least x and y of each
    cell that has points.  So lines and scatters show the whole range.
    """
    chart = choose_chart(df.schema)
    if chart is None:
        return None
    pair = df.select(F.col(chart.x).alias("x"), F.col(chart.y).alias("y"))
    drawn = {"bar": _tallest, "line": _steps, "scatter": _cells}[chart.kind](pair, rows)
    described = drawn.withColumn("kind", F.lit(chart.kind)).withColumn("title", F.lit(chart.title))
    if chart.kind != "bar":
        return described.withColumn("horizontal", F.lit(False))
    # One task, but over no more than the ``rows`` that were kept.
    categories = F.size(F.collect_set("x").over(Window.partitionBy()))
    return described.withColumn("horizontal", categories > UPRIGHT_CATEGORIES)


def _tallest(pair: DataFrame, rows: int) -> DataFrame:
    return pair.orderBy(F.desc("y"), "x").limit(rows).withColumn("points", F.lit(1).cast("long"))


def _place(pair: DataFrame, number: Column, steps: int) -> Column:
    """Which of ``steps`` equal parts of its range a number is in."""
    bounds = pair.agg(F.min(number).alias("low"), F.max(number).alias("high"))
    low, high = bounds.select("low").scalar(), bounds.select("high").scalar()
    share = F.when(high > low, (number - low) / (high - low)).otherwise(0.0)
    return F.least(F.floor(share * steps), F.lit(steps - 1))


def _steps(pair: DataFrame, rows: int) -> DataFrame:
    when = F.unix_micros(F.col("x").cast("timestamp")).cast("double")
    known = pair.filter("x IS NOT NULL")
    return known.groupBy(_place(known, when, rows).alias("step")).agg(
        F.min("x").alias("x"), F.avg("y").alias("y"), F.min("y").alias("low"), F.max("y").alias("high"),
        F.min(F.struct("x", "y"))["y"].alias("first"), F.max(F.struct("x", "y"))["y"].alias("last"),
        F.count("*").alias("points"),
    ).drop("step")


def _cells(pair: DataFrame, rows: int) -> DataFrame:
    side = math.isqrt(rows)
    known = pair.select(F.col("x").cast("double"), F.col("y").cast("double")).filter("x IS NOT NULL AND y IS NOT NULL")
    i, j = _place(known, F.col("x"), side), _place(known, F.col("y"), side)
    return known.groupBy(i.alias("i"), j.alias("j")).agg(
        F.min("x").alias("x"), F.min("y").alias("y"), F.count("*").alias("points")
    ).drop("i", "j")


def display_frame(df: DataFrame, order: list[str], rows: int) -> DataFrame:
    """The first ``rows`` rows for display, each with the true size of the result."""
    return df.orderBy(*order).limit(rows).withColumn("total_rows", df.agg(F.count("*")).scalar())
