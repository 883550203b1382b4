"""Nearest neighbours by inner product with vantage-point trees, one per shard.

A shard is a bounded number of vectors.  Its tree cuts them at a vantage point: the half
nearer to it goes left, the other right, and each child keeps the nearest and farthest
distance of its members, down to leaves of some dozens that lie next to each other in one
matrix.  By the triangle inequality a member of a child is at least as far from a query as
the query's own distance to the vantage point lies outside the child's range.  A child
whose bound, times a factor, reaches the query's k-th best distance so far is passed over.
With factor one nothing closer can be lost and the search is exact; a larger factor passes
over more.  How much it may be depends on the data, so it is fitted: a bounded sample of
queries is searched exactly, and for each neighbour found the k-th best distance over the
bound of its leaf is the factor that would still have found it.

Largest inner product is nearest distance once every vector of a shard is given one more
component that makes all of them equally long, and queries a zero there.

Shards and blocks of queries meet in a grid of tiles sized from both counts, so a shard
moves once per column of the grid and a block once per row.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.llm.scratch import drop, new_folder, stored

SHARD_ROWS = 4096
LEAF_ROWS = 64
BLOCK_ROWS = 512
TILE_BYTES = 32 << 20
TRIALS = 8  # vantage points tried
SEED = 12
RECALL = 0.98
SAMPLE_QUERIES = 256
SHARD = "dim int, shard long, n int, ids binary, cells binary, starts binary, points binary, ranges binary, length double"
FOUND = "query_id long, vec_id long, score double, bound double, length double"


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(``id``, ``v``) of the rows with an id and a vector of finite numbers, not all zero."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return vectors.filter(
        F.col(key).isNotNull() & x.isNotNull() & finite & F.exists(x, lambda c: c != 0)
    ).select(F.col(key).cast("long").alias("id"), x.cast("array<double>").alias("v"))


# --- one tree -----------------------------------------------------------------------------


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of all rows from all points."""
    squares = (rows**2).sum(axis=1)[:, None] + (points**2).sum(axis=1)[None, :] - 2 * rows @ points.T
    return np.sqrt(np.maximum(squares, 0))


def lifted(rows: np.ndarray, length: float) -> np.ndarray:
    """The rows with one more component, so that each has the given length."""
    rest = np.maximum(length**2 - (rows**2).sum(axis=1), 0)
    return np.hstack([rows, np.sqrt(rest)[:, None]])


def tree(rows: np.ndarray, leaf_rows: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, starts, points, ranges) of a balanced tree over lifted rows.

    ``order`` puts the members of each leaf side by side and ``starts`` says where leaves
    begin.  Inner node i (children 2 i + 1 and 2 i + 2) has a vantage point and four
    distances: nearest and farthest of its left and of its right members.  Cutting at the
    middle of the sorted distances keeps the tree balanced among any number of equal rows.
    """
    rng = np.random.default_rng(seed)
    depth = max(0, ceil(np.log2(max(len(rows), 1) / leaf_rows)))
    parts, points, ranges = [np.arange(len(rows))], [], []
    for _ in range(depth):
        below = []
        for part in parts:
            tried = rows[rng.choice(part, min(TRIALS, len(part)), replace=False)]
            seen = rows[rng.choice(part, min(128, len(part)), replace=False)]
            point = tried[np.argmax(distances(seen, tried).std(axis=0))]  # it tells members apart best
            far = distances(rows[part], point[None])[:, 0]
            part = part[np.argsort(far, kind="stable")]
            far = np.sort(far)
            half = len(part) // 2
            points.append(point)
            ranges.append([far[0], far[max(half - 1, 0)], far[half], far[-1]])
            below += [part[:half], part[half:]]
        parts = below
    starts = np.cumsum([0, *map(len, parts)])
    width = rows.shape[1]
    return np.concatenate(parts), starts, np.array(points).reshape(-1, width), np.array(ranges).reshape(-1, 4)


def leaf_bounds(asked: np.ndarray, points: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """The least distance from each query that a member of each leaf can have."""
    bounds = np.zeros((len(asked), 1))
    first = 0
    while first < len(points):
        level = slice(first, first + bounds.shape[1])
        far, cut = distances(asked, points[level]), ranges[level]
        both = np.stack([
            np.maximum(cut[:, 0] - far, far - cut[:, 1]), np.maximum(cut[:, 2] - far, far - cut[:, 3])
        ], axis=2)
        first += bounds.shape[1]
        bounds = np.maximum(bounds[:, :, None], both).reshape(len(asked), -1)
    return bounds


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed from the first component to the last, so that they
    do not depend on what else is worked out with them."""
    return np.cumsum(a * b, axis=1)[:, -1] if len(a) else np.zeros(0)


class Best:
    """The k best rows so far of every query of a block."""

    def __init__(self, q_ids: np.ndarray, asked: np.ndarray, k: int) -> None:
        self.q_ids, self.asked, self.k = q_ids, asked, k
        self.length = np.linalg.norm(asked, axis=1)
        self.scores = np.full((len(asked), k), -np.inf)
        self.ids = np.full((len(asked), k), np.iinfo(np.int64).max)
        self.bounds = np.zeros((len(asked), k))  # of the leaves they were found in
        self.lengths = np.zeros((len(asked), k))  # of their shards
        self.searched = 0  # pairs of query and row

    def reach(self, at: np.ndarray, length: float) -> np.ndarray:
        """The k-th best distance in a shard whose rows have the given length when lifted."""
        gap = self.length[at] ** 2 + length**2 - 2 * self.scores[at, -1]
        return np.sqrt(np.maximum(gap, 0))

    def meet(self, at: np.ndarray, ids: np.ndarray, rows: np.ndarray, bounds: np.ndarray, length: float) -> None:
        """Let the queries ``at`` see the rows of a leaf; of equal scores the smaller id stays."""
        self.searched += len(at) * len(rows)
        rough = self.asked[at] @ rows.T
        # rough sums may differ from exact ones in the last digits
        slack = 1e-12 * self.length[at] * np.linalg.norm(rows, axis=1).max(initial=0)
        hit = (rough >= (self.scores[at, -1] - slack)[:, None]) & (ids[None, :] != self.q_ids[at][:, None])
        q, r = np.nonzero(hit)
        if not len(q):
            return
        if len(q) > 4 * self.k * len(at):  # the first leaves: rough scores tell which may stay
            kth = np.partition(np.where(hit, rough, -np.inf), -min(self.k, len(rows)), axis=1)[:, -min(self.k, len(rows))]
            q, r = np.nonzero(hit & (rough >= (kth - slack)[:, None]))
        scores = exact_products(self.asked[at[q]], rows[r])
        touched = np.unique(q)
        held = at[touched]
        fields = [(self.scores, scores), (self.ids, ids[r]), (self.bounds, bounds[q]), (self.lengths, np.full(len(q), length))]
        both = [np.concatenate([old[held].ravel(), new]) for old, new in fields]
        all_q = np.concatenate([np.repeat(touched, self.k), q])
        order = np.lexsort((both[1], -both[0], all_q))
        all_q = all_q[order]
        first = np.r_[True, all_q[1:] != all_q[:-1]]
        place = np.arange(len(all_q)) - np.flatnonzero(first)[np.cumsum(first) - 1]
        stays = place < self.k
        for (old, _), values in zip(fields, both):
            old[at[all_q[stays]], place[stays]] = values[order][stays]

    def found(self) -> pa.Table:
        q, at = np.nonzero(self.scores > -np.inf)
        return pa.table({
            "query_id": self.q_ids[q], "vec_id": self.ids[q, at], "score": self.scores[q, at],
            "bound": self.bounds[q, at], "length": self.lengths[q, at],
        })


def search(
    best: Best, ids: np.ndarray, rows: np.ndarray, starts: np.ndarray, points: np.ndarray, ranges: np.ndarray,
    length: float, factor: float,
) -> None:
    """Search one shard's tree for all queries of a block."""
    asked = np.hstack([best.asked, np.zeros((len(best.asked), 1))])
    bounds = leaf_bounds(asked, points, ranges)
    # distances carry rounding of their own; a bound is trusted but for that
    slack = 1e-7 * (best.length + length)
    order = np.argsort(bounds, axis=1, kind="stable")
    waiting = np.ones(bounds.shape, dtype=bool)
    everyone = np.arange(len(asked))

    def visit(leaf: int, at: np.ndarray) -> None:
        if len(at):
            waiting[at, leaf] = False
            span = slice(starts[leaf], starts[leaf + 1])
            best.meet(at, ids[span], rows[span], bounds[at, leaf], length)

    # the most promising leaf of each query first, so that its reach is short early
    for leaf in np.unique(order[:, 0]):
        visit(leaf, everyone[order[:, 0] == leaf])
    for leaf in np.argsort(bounds.mean(axis=0), kind="stable"):
        at = everyone[waiting[:, leaf]]
        near = factor * (bounds[at, leaf] - slack[at]) < best.reach(at, length)
        visit(leaf, at[near])


# --- shards and tiles ----------------------------------------------------------------------


def shards(vectors: DataFrame, shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The index: one row per shard with its vectors and its tree.

    ``vectors`` as from :func:`usable`.  Rows are dealt by a hash of their place in the
    input, so a shard holds about ``shard_rows`` whatever ids or vectors repeat.
    """
    dims = vectors.groupBy(F.size("v").alias("dim")).agg(F.ceil(F.count("*") / shard_rows).alias("_shards"))
    dealt = vectors.withColumns({"dim": F.size("v"), "_row": F.monotonically_increasing_id()}).join(
        F.broadcast(dims), "dim"  # a row per vector length
    ).withColumn("shard", F.pmod(F.xxhash64("_row"), F.col("_shards")))

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("_row", "ascending")])
        dim = table["dim"][0].as_py()
        ids = table["id"].to_numpy()
        rows = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        length = float(np.linalg.norm(rows, axis=1).max())
        order, starts, points, ranges = tree(lifted(rows, length), leaf_rows)
        return pa.table({
            "dim": table["dim"][:1], "shard": table["shard"][:1], "n": pa.array([len(ids)], pa.int32()),
            "ids": [ids[order].astype("<i8").tobytes()], "cells": [rows[order].astype("<f8").tobytes()],
            "starts": [starts.astype("<i8").tobytes()], "points": [points.astype("<f8").tobytes()],
            "ranges": [ranges.astype("<f8").tobytes()], "length": [length],
        })

    return dealt.select("dim", "shard", "id", "v", "_row").groupBy("dim", "shard").applyInArrow(build, SHARD)


def grid(row_bytes: int, query_bytes: int, tile_bytes: int, tasks: int) -> tuple[int, int]:
    """Rows and columns of the grid of tiles: as few columns as memory allows, since a
    column moves every shard once more, and rows until all tasks have a tile."""
    columns = max(1, ceil(query_bytes / tile_bytes))
    return max(1, ceil(row_bytes / tile_bytes), ceil(tasks / columns)), columns


def _met(index: DataFrame, asked: DataFrame, k: int, factor: float, tile_bytes: int) -> DataFrame:
    """The best ``k`` rows per query from each tile of the grid, as :data:`FOUND`."""
    spark = index.sparkSession
    rows, row_bytes = index.agg(F.count("*"), F.sum(F.octet_length("cells").cast("long"))).first()
    q_bytes = asked.agg(F.sum(8 * F.col("dim").cast("long"))).first()[0] or 0
    tall, wide = grid(row_bytes or 0, q_bytes, tile_bytes, min(4 * spark.sparkContext.defaultParallelism, rows))

    # a shard goes to every column of its row of the grid, a query to every row of its column
    def spread(df: DataFrame, own: str, place: Column, name: str, n: int) -> DataFrame:
        return df.withColumn(own, place).withColumn(
            name, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
        )

    shard_tiles = spread(index, "row", F.pmod("shard", F.lit(tall).cast("long")), "column", wide)
    query_tiles = spread(asked, "column", F.pmod(F.xxhash64("id"), F.lit(wide).cast("long")), "row", tall)

    def tile(blocks: pa.Table, trees: pa.Table) -> pa.Table:
        if not len(blocks) or not len(trees):
            return Best(np.zeros(0, dtype=np.int64), np.zeros((0, 1)), k).found()
        out = []
        blocks = blocks.sort_by("id")
        dim = blocks["dim"][0].as_py()
        ids = blocks["id"].to_numpy()
        cells = blocks["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        trees = trees.sort_by("shard").to_pylist()
        for first in range(0, len(ids), BLOCK_ROWS):
            best = Best(ids[first : first + BLOCK_ROWS], cells[first : first + BLOCK_ROWS], k)
            for t in trees:
                search(
                    best, np.frombuffer(t["ids"], "<i8"), np.frombuffer(t["cells"], "<f8").reshape(-1, dim),
                    np.frombuffer(t["starts"], "<i8"), np.frombuffer(t["points"], "<f8").reshape(-1, dim + 1),
                    np.frombuffer(t["ranges"], "<f8").reshape(-1, 4), t["length"], factor,
                )
            out.append(best.found())
        return pa.concat_tables(out)

    keys = ["dim", "row", "column"]
    return query_tiles.groupBy(*keys).cogroup(shard_tiles.groupBy(*keys)).applyInArrow(tile, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def fitted_factor(
    index: DataFrame, asked: DataFrame, k: int, recall: float, sample: int = SAMPLE_QUERIES, tile_bytes: int = TILE_BYTES
) -> float:
    """The largest factor with which a share ``recall`` of the ``k`` nearest of a sample of
    at most ``sample`` queries is found; the search is exact for those."""
    drawn = asked.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(sample)
    hits = _ranked(_met(index, drawn, k, 1.0, tile_bytes), k)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    last = hits.groupBy("query_id").agg(F.min("score").alias("last"))
    gap = F.greatest(norm + F.col("length") ** 2 - 2 * F.col("last"), F.lit(0.0))
    ratios = hits.join(last, "query_id").join(drawn.withColumnRenamed("id", "query_id"), "query_id").select(
        F.when(F.col("bound") > 0, F.sqrt(gap) / F.col("bound")).otherwise(float("inf")).alias("ratio")
    )
    at = ratios.agg(F.percentile("ratio", F.lit(1 - recall))).first()[0]
    return max(1.0, at * (1 - 1e-6)) if at is not None else 1.0


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int, recall: float = RECALL, factor: float | None = None,
    key: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS,
    tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): the ``k`` rows of ``vectors`` with the
    largest inner product found for every row of ``queries``, all if there are fewer.

    ``factor`` of one gives the exact result; larger factors pass over more of each tree.
    Without it the factor is fitted to find a share ``recall`` of a sample's neighbours;
    every row is in the index and every query is searched all the same.

    The score is the inner product of the two vectors in double precision, summed from the
    first component to the last.  A query's own id is no candidate; ties go to the smaller
    id.  Rows whose id or vector is null, whose vector is empty or zero or holds a null or
    non-finite component, take no part; only vectors of one length are compared.
    Repeated rows are candidates each; of queries with one id the smallest vector counts.
    Empty tables give an empty table; other columns are not looked at.  ``vec_id`` is a
    whole number.
    """
    if k < 1 or not 0 < recall <= 1 or factor is not None and not factor >= 1:
        raise ValueError("k and factor are at least one, recall is a share")
    spark = vectors.sparkSession
    index_path, query_path = new_folder(spark, "vp-shards"), new_folder(spark, "vp-queries")
    index = stored(shards(usable(vectors, key, vector), shard_rows, leaf_rows), index_path)
    asked = stored(
        usable(queries, key, vector).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v")), query_path
    )
    if index.isEmpty() or asked.isEmpty():
        drop(spark, index_path, query_path)
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if factor is None:
        factor = fitted_factor(index, asked, k, recall, tile_bytes=tile_bytes) if recall < 1 else 1.0
    return _ranked(_met(index, asked, k, factor, tile_bytes), k).select("query_id", "rank", "vec_id", "score")


def op12_vp_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)
