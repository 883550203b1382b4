"""Period-over-period measures on tables that hold one row per period.

The windows below run over periods, whose number is bounded by the calendar,
never over the rows that were aggregated into them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.functions.scalars import ratio


def growth(df: DataFrame, period: str, value: str, previous: str) -> DataFrame:
    """Value of the previous period and the relative change to it."""
    window = Window.orderBy(F.col(period).asc_nulls_last())
    return df.withColumn(previous, F.lag(value).over(window)).withColumn(
        "growth_rate", ratio(F.col(value) - F.col(previous), F.col(previous))
    )


def running_total(df: DataFrame, period: str, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Sum up to and including each period, restarting per ``by``."""
    window = Window.partitionBy(*by).orderBy(F.col(period).asc_nulls_last())
    return df.withColumn("running_total", F.sum(value).over(window))


def always_growing(df: DataFrame, entity: str, period: str, value: str) -> DataFrame:
    """Entities whose value rose in every period that follows another one."""
    window = Window.partitionBy(entity).orderBy(period)
    after = df.withColumn("_next", F.lead(value).over(window))
    return (
        after.groupBy(entity)
        .agg(
            F.count("*").alias("periods"),
            F.min(F.when(F.col("_next").isNull() | (F.col("_next") > F.col(value)), 1).otherwise(0)).alias("_rising"),
        )
        .filter((F.col("_rising") == 1) & (F.col("periods") > 1))
        .select(entity, "periods")
    )
