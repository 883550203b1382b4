"""Mixing sources to target weights by proportionate-fair (Pfair) scheduling.

Every source's documents are laid end to end and cut into blocks of ``block_chars``
characters.  Time is a row of slots, one block each.  With weight w out of D, the j-th
block of a source is released at slot floor((j - 1) D / w) and due at ceil(j D / w);
earliest deadline first among released blocks then keeps every source, after any number
of slots t, within one block of its share t w / D.  D is the length of the whole mix, so
that rounding the target weights to w / D costs less than one block from first to last;
where a caller gives a shorter D, the schedule repeats every D slots.  Numbering and
placing the blocks is left to Spark.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_left
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.llm.text import whole

SEED = 11
BUCKET_ROWS = 256
NULL_SOURCE = "0"
BROADCAST_SLOTS = 1 << 18


def source_key(source: str = "source") -> Column:
    """The source as text that is never null; a null source is one of its own."""
    return F.coalesce(F.concat(F.lit("1"), F.col(source).cast("string")), F.lit(NULL_SOURCE))


def _shared_out(exact: dict[str, float], out: dict[str, int], period: int) -> dict[str, int]:
    """``out`` with what is left of ``period`` given to the largest remainders."""
    most_left = sorted(exact, key=lambda k: (out[k] - exact[k], k))
    for k in most_left[: period - sum(out.values())]:
        out[k] += 1
    return out


def _checked(shares: dict[str, float]) -> float:
    if any(not s > 0 for s in shares.values()):
        raise ValueError("weights are positive")
    return sum(shares.values())


def whole_weights(shares: dict[str, float], period: int) -> dict[str, int]:
    """Whole numbers that add up to ``period``: ``shares`` of it by largest remainders, but
    at least one each.  A period too short for all sources is made ten times their number."""
    if not shares:
        return {}
    total, period = _checked(shares), max(period, 10 * len(shares))
    single: set[str] = set()  # sources raised to one; the others share the rest
    while True:
        rest = (period - len(single)) / total
        low = {k for k, s in shares.items() if k not in single and s * rest < 1}
        if not low:
            break
        single |= low
        total = sum(s for k, s in shares.items() if k not in single)
    exact = {k: 1.0 if k in single else s * rest for k, s in shares.items()}
    return _shared_out(exact, {k: int(x) for k, x in exact.items()}, period)


def fitted_weights(shares: dict[str, float], blocks: dict[str, int]) -> dict[str, int]:
    """Slots of each source in a period that holds the whole mix: enough for its ``blocks``
    (one at least), and less than one off its share of the period."""
    if not shares:
        return {}
    total = _checked(shares)
    share = {k: s / total for k, s in shares.items()}
    period = max(int((blocks[k] - 1) / share[k]) + 1 for k in share)
    while True:
        out = {k: max(int(s * period), blocks[k]) for k, s in share.items()}
        if sum(out.values()) <= period:
            return _shared_out({k: s * period for k, s in share.items()}, out, period)
        period = max(sum(out.values()), period + period // 50)


def pfair_slots(weights: dict[str, int]) -> dict[str, list[int]]:
    """The slots of one period, by source: earliest deadline first among released blocks."""
    period = sum(weights.values())
    slots: dict[str, list[int]] = {k: [] for k in weights}
    waiting = [(0, k) for k in weights]  # (release, source)
    heapq.heapify(waiting)
    ready: list[tuple[int, str]] = []  # (deadline, source)
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(len(slots[k]) + 1) * period // weights[k]), k))
        _, k = heapq.heappop(ready)
        slots[k].append(slot)
        if len(slots[k]) < weights[k]:
            heapq.heappush(waiting, (len(slots[k]) * period // weights[k], k))
    return slots


def _plan(
    spark: SparkSession, blocks: dict[str, int], weights: dict[str, int]
) -> tuple[DataFrame, DataFrame]:
    """One row per source: blocks, slots per period, and how often its blocks come round
    until the last block of the slowest source has come; and one row per slot of a period."""
    slots, period = pfair_slots(weights), sum(weights.values())

    def slot(k: str, i: int) -> int:
        return i // weights[k] * period + slots[k][i % weights[k]]

    length = max((slot(k, blocks[k] - 1) + 1 for k in weights), default=0)
    granted = {k: length // period * weights[k] + bisect_left(slots[k], length % period) for k in weights}
    rows = [
        {"key": k, "blocks": blocks[k], "granted": granted[k], "weight": weights[k], "slots": slots[k]}
        for k in sorted(weights)
    ]
    kind = "array<struct<key: string, blocks: long, granted: long, weight: long, slots: array<long>>>"
    one = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), kind)).alias("_s"))
    plan = one.select(F.col("_s.key").alias("_key"), *(
        F.col(f"_s.{c}").alias(f"_{c}") for c in ("blocks", "granted", "weight")
    )).withColumn("_period", F.lit(period))
    times = one.select(F.col("_s.key").alias("_key"), F.posexplode("_s.slots").alias("_at", "_slot"))
    return plan, F.broadcast(times) if period <= BROADCAST_SLOTS else times


def mixed(
    docs: DataFrame, weights: dict[str | None, float] | None = None, smoothing: float = 0.8,
    period: int | None = None, block_chars: int = 1 << 16,
) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, ``source``, others) mixed to target weights.

    Adds ``epoch`` (0 for the first pass over the source), ``block``, ``slot``, and
    ``place``, the characters before the document in its source; rows in order of
    ``slot``, ``place`` and ``doc_id`` are the mix.  ``weights`` has a positive number
    for every source; without it sources weigh as their characters to the power of
    ``smoothing``.  The mix ends with the last block of the source that is slowest to run
    out, so every document is in it; smaller sources start again from their first block.
    The last block of a source may be short, and a document belongs to the block in which
    it starts.

    A null source is a source.  Null and empty texts are placed, with no characters.
    Documents of a source come in the order of a seeded hash of id and text; repeated
    rows stay together.  An empty table gives an empty table.  Input columns named like
    an added one are replaced; names that start with ``_`` are reserved.  One row per
    source goes through the driver, as the weights do, and a number per slot: without
    ``period`` that is one for every ``block_chars`` characters of the mix, which is never
    two blocks or more from the targets.  A given ``period`` is repeated, and its rounding
    with it.
    """
    spark = docs.sparkSession
    added = ("epoch", "block", "slot", "place")
    own = [c for c in docs.columns if c not in added]
    rows = docs.select(own).withColumns({
        "_key": source_key(), "_size": F.char_length(whole("text")).cast("long"),
        "_order": F.xxhash64(F.lit(SEED), "doc_id", "text"),
    })
    sizes = rows.groupBy("_key").agg(F.sum("_size").alias("n"), F.count("*").alias("k")).collect()
    totals = {r["_key"]: r["n"] for r in sizes}
    if weights is None:
        shares = {k: max(n, 1) ** smoothing for k, n in totals.items()}
    else:
        named = {NULL_SOURCE if k is None else f"1{k}": w for k, w in weights.items()}
        missing = sorted(set(totals) - set(named))
        if missing:
            raise ValueError(f"no weight for {[k[1:] if k != NULL_SOURCE else None for k in missing]}")
        shares = {k: named[k] for k in totals}
    blocks = {k: max(1, ceil(n / block_chars)) for k, n in totals.items()}
    fitted = fitted_weights(shares, blocks) if period is None else whole_weights(shares, period)
    plan, times = _plan(spark, blocks, fitted)

    # Prefix sums in two steps: over the documents of a bucket, at most some hundreds, and
    # over the buckets of a source.  Buckets are ranges of the hash.
    depth = max(1, min(40, ceil(log2(sum(r["k"] for r in sizes) / BUCKET_ROWS + 1))))
    rows = rows.withColumn("_bucket", F.shiftrightunsigned(F.col("_order").bitwiseXOR(F.lit(-(2**63))), 64 - depth))
    bucket = ["_key", "_bucket"]
    sums = rows.groupBy(*bucket).agg(F.sum("_size").alias("_n"))
    earlier = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*bucket, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*bucket).orderBy("_order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.join(before, bucket)
        .withColumn("place", F.col("_before") + F.coalesce(F.sum("_size").over(inside), F.lit(0)))
        .join(F.broadcast(plan), "_key")  # a row per source
    )
    block = F.least(F.floor(F.col("place") / block_chars), F.col("_blocks") - 1)
    turns = F.ceil((F.col("_granted") - F.col("_block")) / F.col("_blocks"))
    turn = F.col("_epoch") * F.col("_blocks") + F.col("_block")
    out = placed.withColumn("_block", block).withColumn("_epoch", F.explode(F.sequence(F.lit(0).cast("long"), turns - 1)))
    out = out.withColumn("_turn", turn).withColumn("_at", (F.col("_turn") % F.col("_weight")).cast("int"))
    slot = F.floor(F.col("_turn") / F.col("_weight")) * F.col("_period") + F.col("_slot")
    return out.join(times, ["_key", "_at"]).select(
        *own, F.col("_epoch").alias("epoch"), F.col("_block").alias("block"), slot.alias("slot"), "place"
    )


def in_order(mix: DataFrame) -> DataFrame:
    """The rows of :func:`mixed` in their order, spread over range partitions."""
    return mix.orderBy("slot", "place", "doc_id")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mixed(docs).select("doc_id", "source", "epoch", "block", "slot", "place")
