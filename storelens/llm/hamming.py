"""Links between 64-bit fingerprints within two bits: generalised pigeonhole.

The 64 bits are split into partitions, correlated bits together.  If the partitions'
thresholds add up to ``max_distance - partitions + 1``, any two fingerprints within
``max_distance`` agree within its threshold in at least one of them; a threshold of -1
leaves a partition out.  Each fingerprint gets the thresholds with the fewest expected
candidates, found by dynamic programming over the partitions, probes an index of exact
partition values, and what it meets is verified.

Where even the best thresholds meet more candidates than ``dense``, as in a large group
of near copies, a fingerprint looks for other such ones by its ball instead: two values
are within two bits exactly if some value is within one bit of both.  65 keys a
fingerprint, at most 65 fingerprints a key, no verification.  No bucket is cut short.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.scratch import drop, new_folder, stored

BITS = 64
ONE = np.uint64(1)


def _bits(values: np.ndarray) -> np.ndarray:
    """One row of 0 and 1 per value, lowest bit first."""
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and how many have bits i and j set (64 x 64 counts)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((BITS, BITS), dtype=np.int64)
        for batch in batches:
            x = _bits(batch["fp"].to_numpy()).astype(np.float64)
            total += np.rint(x.T @ x).astype(np.int64)
        i, j = np.triu_indices(BITS)
        yield pd.DataFrame({"i": i, "j": j, "n": total[i, j]})

    rows = fps.select("fp").mapInPandas(count, "i int, j int, n long").groupBy("i", "j").agg(
        F.sum("n").alias("n")
    )
    together = np.zeros((BITS, BITS), dtype=np.int64)
    for i, j, n in rows.collect():  # 2,080 rows, whatever the corpus
        together[i, j] = together[j, i] = n
    return fps.count(), together


def partition_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Split the bits into ``parts`` groups of nearly equal size, each grown around a bit by
    adding the bit that is most correlated with those already in it."""
    ones = np.diag(together) / max(n, 1)
    covariance = together / max(n, 1) - np.outer(ones, ones)
    spread = np.sqrt(np.maximum(np.outer(ones * (1 - ones), ones * (1 - ones)), 1e-12))
    related = np.abs(covariance / spread)
    left, groups = list(range(BITS)), []
    for part in range(parts):
        size = BITS // parts + (part < BITS % parts)
        group = [max(left, key=lambda b: (related[b, left].sum() - related[b, b], -b))]
        left.remove(group[0])
        while len(group) < size:
            group.append(max(left, key=lambda b: (related[b, group].sum(), -b)))
            left.remove(group[-1])
        groups.append(sorted(group))
    return groups


def _mask(bits: list[int]) -> int:
    """The bits as a signed 64-bit number."""
    return int(np.array([sum(1 << b for b in bits)], dtype=np.uint64).astype(np.int64)[0])


def _expected(bits: np.ndarray, group: list[int], ones: np.ndarray, n: int, most: int) -> np.ndarray:
    """Expected numbers of fingerprints at distance 0..most in a partition, by the bits'
    shares of ones, for each fingerprint of a batch."""
    differ = np.where(bits[:, group] == 1, 1 - ones[group], ones[group])
    chance = np.zeros((len(bits), most + 1))
    chance[:, 0] = 1
    for b in range(len(group)):
        d = differ[:, b : b + 1]
        chance[:, 1:] = chance[:, 1:] * (1 - d) + chance[:, :-1] * d
        chance[:, :1] *= 1 - d
    return n * chance


def allocate(cost: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds of least total cost that add up to ``budget``.

    ``cost[r, p, t + 1]`` is the cost of threshold t (-1 first) in partition p for row r.
    Dynamic programming over partitions; returns thresholds (rows x partitions), costs.
    """
    rows, parts, kinds = cost.shape
    span = budget + parts  # sum of (threshold + 1)
    best = np.full((rows, span + 1), np.inf)
    best[:, 0] = 0
    choice = np.zeros((parts, rows, span + 1), dtype=np.int64)
    for p in range(parts):
        following = np.full_like(best, np.inf)
        for kind in range(min(kinds, span + 1)):
            reached = best[:, : span + 1 - kind] + cost[:, p, kind : kind + 1]
            better = reached < following[:, kind:]
            following[:, kind:] = np.where(better, reached, following[:, kind:])
            choice[p][:, kind:] = np.where(better, kind, choice[p][:, kind:])
        best = following
    thresholds = np.zeros((rows, parts), dtype=np.int64)
    left = np.full(rows, span)
    for p in reversed(range(parts)):
        thresholds[:, p] = choice[p][np.arange(rows), left]
        left = left - thresholds[:, p]
    return thresholds - 1, best[:, span]


def _flips(group: list[int], distance: int) -> np.ndarray:
    """XOR masks of all values within ``distance`` in a partition."""
    masks = [sum(1 << b for b in c) for d in range(distance + 1) for c in combinations(group, d)]
    return np.array(masks, dtype=np.uint64)


def links(fps: DataFrame, max_distance: int = 2, parts: int | None = None, dense: int = 130) -> DataFrame:
    """Edges (``a``, ``b``) between distinct 64-bit values ``fp`` whose components are those
    of the graph of all pairs within ``max_distance`` (0 to 2) differing bits.

    Every edge is such a pair.  Nulls are left out.  An empty table, or distance 0, has no
    edges.  No fingerprint meets more than ``2 * dense`` candidates: one whose estimate
    proves too low joins the dense ones.
    """
    if max_distance not in (0, 1, 2):
        raise ValueError("max_distance is 0, 1 or 2")
    spark = fps.sparkSession
    fps = fps.select("fp").filter("fp IS NOT NULL").distinct()
    if max_distance == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter("a <> b")
    parts = parts or max_distance + 1
    n, together = bit_statistics(fps)
    groups = partition_bits(n, together, parts)
    ones = np.diag(together) / max(n, 1)

    value = F.explode(F.array(*(
        F.struct(F.lit(p).alias("part"), F.col("fp").bitwiseAND(F.lit(_mask(g))).alias("value"))
        for p, g in enumerate(groups)
    ))).alias("v")
    index_path, plan_path = new_folder(spark, "hamming-index"), new_folder(spark, "hamming-plan")
    index = stored(fps.select("fp", value).select("fp", "v.*"), index_path)
    sizes = index.groupBy("part", "value").agg(F.count("*").alias("n"))
    met = index.join(sizes, ["part", "value"]).groupBy("fp").pivot("part", list(range(parts))).agg(F.max("n"))

    budget = max_distance - parts + 1

    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = batch["fp"].to_numpy()
            bits = _bits(fp)
            cost = np.zeros((len(fp), parts, max_distance + 2))
            for p, g in enumerate(groups):
                exact = batch[str(p)].to_numpy(dtype=float)
                near = _expected(bits, g, ones, n, max_distance)
                for t in range(max_distance + 1):
                    tries = sum(comb(len(g), d) for d in range(t + 1))
                    cost[:, p, t + 1] = exact + near[:, 1 : t + 1].sum(axis=1) + tries
            thresholds, total = allocate(cost, budget)
            crowded = total > dense
            out = [(fp[crowded], np.full(crowded.sum(), -1), fp[crowded])]
            for p, g in enumerate(groups):
                part = np.uint64(_mask(g) % 2**64)
                for t in range(max_distance + 1):
                    mine = fp[(thresholds[:, p] == t) & ~crowded]
                    flips = _flips(g, t)
                    keys = ((mine.astype(np.uint64) & part)[:, None] ^ flips[None, :]).ravel()
                    out.append((np.repeat(mine, len(flips)), np.full(len(keys), p), keys.astype(np.int64)))
            a, part_of, keys = (np.concatenate(c) for c in zip(*out))
            yield pd.DataFrame({"a": a, "part": part_of.astype(np.int32), "value": keys})

    plan = stored(met.mapInPandas(probes, "a long, part int, value long"), plan_path)
    load = plan.join(sizes, ["part", "value"]).groupBy("a").agg(F.sum("n").alias("n"))
    crowded = load.filter(F.col("n") > 2 * dense).select("a").union(plan.filter("part = -1").select("a"))
    crowded = stored(crowded, new_folder(spark, "hamming-dense"))
    found = (
        plan.filter("part >= 0").join(crowded, "a", "left_anti")
        .join(index.withColumnRenamed("fp", "b"), ["part", "value"])
        .filter((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance))
        .select("a", "b")
    )
    edges_path = new_folder(spark, "hamming-links")
    edges = stored(found.union(_dense_links(crowded.withColumnRenamed("a", "fp"), max_distance)), edges_path)
    drop(spark, index_path, plan_path)
    return edges


def _dense_links(fps: DataFrame, max_distance: int) -> DataFrame:
    """A star for every key that several fingerprints share."""
    flips = [np.array([1 << b], dtype=np.uint64).astype(np.int64)[0] for b in range(BITS)]
    if max_distance == 2:  # balls of radius one meet
        keys = [F.struct(F.lit(-1).alias("bit"), F.col("fp").alias("value"))] + [
            F.struct(F.lit(-1).alias("bit"), F.col("fp").bitwiseXOR(F.lit(int(m))).alias("value")) for m in flips
        ]
    else:  # equal but for one bit
        keys = [
            F.struct(F.lit(b).alias("bit"), F.col("fp").bitwiseAND(F.lit(int(~m))).alias("value"))
            for b, m in enumerate(flips)
        ]
    keyed = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.*")
    first = keyed.groupBy("bit", "value").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("_all"))
    return first.filter(F.size("_all") > 1).select("a", F.explode("_all").alias("b")).filter("a <> b")
