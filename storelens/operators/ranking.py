"""Ranks, top-k and numbering that do not push all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.session import durable


def top_k(df: DataFrame, order: Sequence[Column], k: int = 20) -> DataFrame:
    """The first ``k`` rows of ``order``; each task keeps at most ``k``."""
    return df.orderBy(*order).limit(k)


def top_n_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank_name: str = "row_num"
) -> DataFrame:
    """The first ``n`` rows of each group.  ``order`` must end in a key, so that
    ties are decided.

    The literal bound lets Spark cut every group to ``n`` rows before the
    shuffle, so a group with a third of all rows costs no more than the others.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    first = df.withColumn(rank_name, F.row_number().over(window)).filter(F.col(rank_name) <= n)
    return first.withColumn(rank_name, F.col(rank_name).cast("long"))


def top_ranked(df: DataFrame, value: str, tie: str, k: int, rank_name: str = "rank") -> DataFrame:
    """``RANK()`` over the whole table by ``value`` descending, first ``k`` rows.

    All rows that rank before one of the first ``k`` are among the first ``k``
    themselves, so the ranks are worked out on those alone.
    """
    first = top_k(df, [F.desc(value), F.col(tie)], k)
    return rank_small(first, value, rank_name).orderBy(rank_name, tie)


def rank_small(df: DataFrame, value: str, rank_name: str = "rank") -> DataFrame:
    """``RANK()`` over a whole table of group totals, ties sharing a rank.

    Runs in one task: only for results bounded by a fixed dimension (states,
    months).  Use :func:`top_ranked` for entities that grow with the data.
    """
    rank = F.rank().over(Window.orderBy(F.col(value).desc()))
    return df.withColumn(rank_name, rank.cast("long"))


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_num") -> DataFrame:
    """Consecutive numbers 1..n over the whole table, in ``order``.

    A range-partitioned sort spreads the rows over all tasks; the written result
    fixes each row's place in its partition, and only the partition sizes meet
    in one task.  ``order`` must identify a row, which also lets the range
    bounds split rows that share a leading value.
    """
    placed = durable(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(
        F.count("*").alias("_size"), F.min("_place").alias("_first")
    )
    before = F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")
    starts = sizes.select("_part", (before - F.col("_first")).alias("_shift"))
    # One row per shuffle partition: bounded by the partition count, not the data.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_place") + F.col("_shift") + 1)
        .drop("_place", "_part", "_shift")
    )


def number_rows_per_group(df: DataFrame, group: str, order: Sequence[str], name: str = "row_num") -> DataFrame:
    """Consecutive numbers 1..n in each group, without a task per group."""
    numbered = number_rows(df, [group, *order], "_overall")
    firsts = numbered.groupBy(F.col(group).alias("_group")).agg(F.min("_overall").alias("_first"))
    return (
        numbered.join(firsts, F.col(group).eqNullSafe(F.col("_group")))
        .withColumn(name, F.col("_overall") - F.col("_first") + 1)
        .drop("_overall", "_first", "_group")
    )


def keep_first(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """One row per key: the one with the lowest ``position``.

    An aggregate, so copies are dropped in each task before the shuffle and a
    key with very many copies stays cheap.
    """
    rest = [c for c in df.columns if c not in keys and c != position]
    first = F.min(F.struct(position, *rest)).alias("_first")
    return df.groupBy(*keys).agg(first).select(
        *[c if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns]
    )
