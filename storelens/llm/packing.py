"""Best-fit packing into sequences of several permitted lengths.

Documents are dealt into groups of some thousands, each packed by itself: longest first,
into the open sequence with the least room left, opening the size with the least cost
for what it holds.  Closed sequences shrink to the smallest size that holds them.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm.scratch import new_folder, stored
from storelens.llm.text import whole

CAPACITIES = (4096, 8192, 16384)
OVERHEAD = 64


def byte_tokens(text: str = "text") -> Column:
    """The length for a byte-level model: UTF-8 bytes and an end mark."""
    return F.octet_length(whole(text)) + 1


def best_fit(lengths: Sequence[int], opened: int, capacities: Sequence[int]) -> list[int]:
    """The sequence number of each length, given longest first; a new sequence has the
    size ``opened``, or the smallest one that holds the length."""
    room: list[tuple[int, int]] = []  # (room left, sequence), sorted
    out = []
    count = 0
    for length in lengths:
        at = bisect_left(room, (length, -1))
        if at < len(room):
            left, number = room.pop(at)
        else:
            size = opened if opened >= length else min(c for c in capacities if c >= length)
            left, number = size, count
            count += 1
        out.append(number)
        if left > length:
            insort(room, (left - length, number))
    return out


def pack_group(lengths: Sequence[int], capacities: Sequence[int], overhead: int) -> tuple[list[int], list[int]]:
    """(sequence of each length, capacity of each sequence) of the least total cost.

    A sequence of capacity c costs ``c + overhead``.  Every permitted size is tried as the
    one to open, each result is shrunk, and the cheapest stays (of equals the one that
    opens the larger size).
    """
    sizes = np.array(sorted(capacities))
    best: tuple[int, list[int], list[int]] | None = None
    for opened in sizes[::-1]:
        numbers = best_fit(lengths, int(opened), sizes.tolist())
        used = np.bincount(numbers, weights=lengths).astype(np.int64) if numbers else np.zeros(0, dtype=np.int64)
        shrunk = sizes[np.searchsorted(sizes, used)]
        cost = int(shrunk.sum() + overhead * len(shrunk))
        if best is None or cost < best[0]:
            best = cost, numbers, shrunk.tolist()
    return best[1], best[2]


def packed(
    docs: DataFrame, length: Column | None = None, capacities: Sequence[int] = CAPACITIES,
    overhead: int = OVERHEAD, group_rows: int = 20_000,
) -> DataFrame:
    """Where each document of ``docs`` (``doc_id``, ``text``) goes, a row per piece.

    Columns: ``group`` and ``sequence`` (together the packed sequence), ``capacity``,
    ``offset`` in the sequence, ``doc_id``, ``piece``, ``start`` in the document and
    ``length``.  A document longer than the largest capacity is cut into pieces of that
    capacity and a rest.  ``length`` is in tokens, of at least 0 (default: UTF-8 bytes and
    an end mark); null or negative lengths count as 0, and such a document is one piece
    of length 0.

    A null text is empty.  Repeated rows and null ids are packed like any other rows; an
    empty table gives an empty table.  Other columns are not looked at.
    """
    if not capacities or min(capacities) < 1:
        raise ValueError("capacities are positive")
    spark = docs.sparkSession
    most = max(capacities)
    tokens = F.greatest(F.coalesce((byte_tokens() if length is None else length).cast("long"), F.lit(0)), F.lit(0))
    # written once: the row number must not change when a task runs again
    slim = stored(
        docs.select(F.col("doc_id").cast("string").alias("doc_id"), tokens.alias("tokens"))
        .withColumn("row", F.monotonically_increasing_id()),
        new_folder(spark, "lengths"),
    )
    cut = slim.withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("tokens") / most), F.lit(1)) - 1))
    ).withColumn("start", F.col("piece") * most).withColumn(
        "length", F.least(F.col("tokens") - F.col("start"), F.lit(most))
    )
    groups = max(1, -(-cut.count() // group_rows))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row", "piece"], ascending=[False, True, True], kind="stable")
        numbers, sizes = pack_group(rows["length"].tolist(), capacities, overhead)
        rows = rows.assign(sequence=np.array(numbers, dtype=np.int64), capacity=np.array(sizes, dtype=np.int64)[numbers])
        rows["offset"] = rows.groupby("sequence")["length"].cumsum() - rows["length"]
        return rows[["group", "sequence", "capacity", "offset", "doc_id", "piece", "start", "length"]]

    out = dealt.select("group", "row", "doc_id", "piece", "start", "length").groupBy("group").applyInPandas(
        pack, "group long, sequence long, capacity long, offset long, doc_id string, piece long, start long, length long"
    )
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
