"""Column helpers shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_range(ts: Column, year: int) -> Column:
    """``year(ts) = year`` as a half-open range, which the parquet scan can use
    to skip row groups."""
    return (ts >= F.lit(f"{year}-01-01").cast("timestamp_ntz")) & (
        ts < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")
    )


def between_dates(ts: Column, start: str, end: str) -> Column:
    """Half-open range ``start <= ts < end``."""
    return (ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz"))


def month_of(ts: Column) -> Column:
    return F.date_trunc("month", ts).cast("timestamp_ntz")


def quarter_of(ts: Column) -> Column:
    return F.date_trunc("quarter", ts).cast("timestamp_ntz")


def days_between(start: Column, end: Column) -> Column:
    """Calendar-day boundaries crossed from ``start`` to ``end``."""
    return F.datediff(end, start)


def total(value: Column) -> Column:
    """Exact decimal sum, shown as a double."""
    return F.sum(value).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that gives NULL for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def ellipsis(text: Column, limit: int) -> Column:
    """Text cut to ``limit`` characters, marked with dots when something was cut."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def clock_text(ts: Column) -> Column:
    """A timestamp cut to whole seconds, as text."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def qualified_name(name: Column, prefix: str) -> Column:
    """Add the database prefix unless the name already carries it."""
    database = prefix.split(".")[0]
    return F.when(name.startswith(database), name).otherwise(F.concat(F.lit(prefix), name))


def sql_quoted(text: Column) -> Column:
    """Double the single quotes, for text that goes inside a SQL literal."""
    return F.replace(text, F.lit("'"), F.lit("''"))
