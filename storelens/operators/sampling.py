"""Repeatable splits and stratified samples, in the order of a seeded hash."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def hash_order(seed: int, key: Column) -> Column:
    """A pseudo-random order that depends on nothing but the seed and the key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def exact_split(
    df: DataFrame, key: str, seed: int = 42, train_fraction: float = 0.9, digits: int = 3, bucket_rows: int = 100_000
) -> DataFrame:
    """Add ``split``: exactly ``floor(fraction * n)`` rows are 'train', the rest
    'val'.  ``key`` must be unique.

    The hash values are counted by their first ``digits`` hex digits; the cut falls into
    one of these buckets, which is counted by the next digits, until it holds at most
    ``bucket_rows`` rows.  Only that bucket is sorted.  The data itself is not shuffled.
    """
    ordered = df.withColumn("_hash", hash_order(seed, F.col(key)))
    size = ordered.count()
    wanted = math.floor(size * train_fraction)
    if not wanted:
        return ordered.drop("_hash").withColumn("split", F.lit("val"))
    start, inside, left = "", size, wanted
    while inside > bucket_rows and len(start) < 32:
        bucket = F.substring("_hash", 1, len(start) + digits)
        # At most 16**digits rows, whatever the size of the data.
        counts = ordered.filter(F.col("_hash").startswith(start)).groupBy(bucket.alias("b")).agg(F.count("*").alias("n"))
        for row in counts.orderBy("b").collect():
            start, inside = row.b, row.n
            if left <= row.n:
                break
            left -= row.n
    last = (
        ordered.filter(F.col("_hash").startswith(start))
        .select("_hash")
        .orderBy("_hash")
        .limit(left)
        .agg(F.max("_hash").alias("h"))
        .first()
        .h
    )
    return ordered.withColumn(
        "split", F.when(F.col("_hash") <= F.lit(last), F.lit("train")).otherwise(F.lit("val"))
    ).drop("_hash")


def quotas(count: int, easy: float = 0.4, medium: float = 0.4) -> dict[str, int]:
    """Rows per difficulty; what rounding leaves over goes to 'hard'."""
    n_easy, n_medium = int(count * easy), int(count * medium)
    return {"easy": n_easy, "medium": n_medium, "hard": count - n_easy - n_medium}


def stratified_sample(
    df: DataFrame, stratum: str, key: str, quota: Mapping[str, int], seed: int = 42, batch_size: int = 5
) -> DataFrame:
    """An exact number of rows per stratum, numbered and cut into batches.

    The largest quota is applied first, as a literal, so each task drops the
    rest of a stratum before the shuffle.
    """
    window = Window.partitionBy(stratum).orderBy(hash_order(seed, F.col(key)), F.col(key))
    allowed = F.create_map(*[F.lit(x) for pair in quota.items() for x in pair])
    return (
        df.filter(F.col(stratum).isin(*quota))
        .withColumn("id", F.row_number().over(window))
        .filter(F.col("id") <= max(quota.values()))
        .filter(F.col("id") <= allowed[F.col(stratum)])
        .withColumn("id", F.col("id").cast("long"))
        .withColumn("batch", F.floor((F.col("id") - 1) / batch_size))
    )
