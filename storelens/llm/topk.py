"""Exact top-k search by distributed histogram selection.

Vectors and queries are packed into blocks, and every query block meets every vector
block once per pass.  A pass scores the block pair and returns, per query, the counts of
the highest score bins inside the query's bracket.  The summed histogram shows the bin
with the k-th highest score, which becomes the next bracket, until few scores are left
in it or it is one value wide.  A last pass returns the scores from the bracket up, and
ties are broken by the smaller id.  Scores of pairs never become rows, only the highest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.llm.scratch import drop, new_folder, stored

BINS = 1024
EXACT = 2.0**53  # up to here doubles hold every whole number
LIMIT = 2**61  # scores beyond are returned as this
NONE = -(2**63)
STEP = 64  # queries scored at a time
BLOCK = "n int, dim int, most double, largest double, ids binary, cells binary"


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows with an id and a vector of finite numbers."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return vectors.filter(F.col(key).isNotNull() & x.isNotNull() & finite).select(
        F.col(key).cast("long").alias("id"), x.cast("array<double>").alias("v")
    )


def _packed(vectors: DataFrame, block_bytes: int, scale: int) -> DataFrame:
    """Blocks of vectors of one dimension as matrices of floor(scale * x); ``most`` is the
    largest sum of absolute components of a vector, ``largest`` the largest component."""

    def block(ids: list[int], rows: list[np.ndarray]) -> dict:
        cells = np.stack(rows)
        return {
            "n": len(ids), "dim": cells.shape[1], "most": float(np.abs(cells).sum(axis=1).max()),
            "largest": float(np.abs(cells).max(initial=0)),
            "ids": np.array(ids, dtype="<i8").tobytes(), "cells": cells.astype("<f8").tobytes(),
        }

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[list[int], list[np.ndarray]]] = {}
        for batch in batches:
            for i, v in zip(batch["id"], batch["v"]):
                ids, rows = held.setdefault(len(v), ([], []))
                ids.append(i)
                rows.append(np.floor(scale * np.asarray(v, dtype=np.float64)))
                if len(ids) * max(len(v), 1) * 8 >= block_bytes:
                    yield pd.DataFrame([block(*held.pop(len(v)))])
        for ids, rows in held.values():
            yield pd.DataFrame([block(ids, rows)])

    return vectors.mapInPandas(pack, BLOCK)


def _scores(row: pd.Series, first: int) -> np.ndarray:
    """Whole scores of some queries of a block with all vectors of a block; NONE for a
    query's own row."""
    q = np.frombuffer(row["q_cells"], dtype="<f8").reshape(row["q_n"], row["dim"])[first : first + STEP]
    v = np.frombuffer(row["cells"], dtype="<f8").reshape(row["n"], row["dim"])
    if row["q_most"] * row["largest"] < EXACT:
        out = (q @ v.T).astype(np.int64)
    else:  # whole numbers without bounds, kept inside the limit
        to_int = np.frompyfunc(int, 1, 1)
        exact = np.dot(to_int(q), to_int(v).T) if row["dim"] else np.zeros((len(q), len(v)), dtype=object)
        out = np.clip(exact, -LIMIT, LIMIT).astype(np.int64)
    own = np.frombuffer(row["q_ids"], dtype="<i8")[first : first + STEP, None]
    out[own == np.frombuffer(row["ids"], dtype="<i8")[None, :]] = NONE
    return out


def _top_bins(scores: np.ndarray, low: int, width: int, bins: int, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins and counts inside the bracket, from the highest bin down to the one in which
    ``need`` scores are reached: the k-th best of all blocks is never below that of one."""
    inside = scores[(scores != NONE) & (scores >= low)]
    at = (inside - low) // width
    found, counts = np.unique(at[at < bins], return_counts=True)
    found, counts = found[::-1], counts[::-1]
    stop = int(np.searchsorted(np.cumsum(counts), need)) + 1
    return found[:stop], counts[:stop]


def _best(scores: np.ndarray, ids: np.ndarray, low: int, k: int) -> np.ndarray:
    """Positions of the k best scores from ``low`` up, ties to the smaller id."""
    at = np.nonzero((scores != NONE) & (scores >= low))[0]
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding",
    scale: int = 1024, block_bytes: int = 1 << 22, query_block_bytes: int = 1 << 19,
) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): the ``k`` rows of ``vectors`` with the
    highest inner product for every row of ``queries``, all if there are fewer.

    Components count as floor(``scale`` * x).  A query's own id is no candidate; ties go
    to the smaller id.  Rows whose id or vector is null, or whose vector holds a null or
    non-finite component, take no part; only vectors of one dimension are compared.
    Repeated rows are candidates each; of queries with one id the smallest vector counts.
    Scores beyond 2^61 are returned as that.  Empty tables give an empty table; other
    columns are not looked at.
    """
    spark = vectors.sparkSession
    asked = _usable(queries, key, vector).groupBy("id").agg(F.min("v").alias("v"))
    paths = [new_folder(spark, name) for name in ("vector-blocks", "query-blocks")]
    v_blocks = stored(_packed(_usable(vectors, key, vector), block_bytes, scale), paths[0])
    q_blocks = stored(
        _packed(asked, query_block_bytes, scale)
        .select(*(F.col(c).alias(f"q_{c}") for c in ("n", "dim", "most", "ids", "cells")))
        .withColumn("block", F.monotonically_increasing_id()),
        paths[1],
    )
    many, most = v_blocks.agg(F.count("*"), F.max("largest")).first()
    q_many = q_blocks.count()
    if not many or not q_many:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # Dealt so that each pair of blocks is one key of its own: both sides know its number.
    v_side = v_blocks.withColumn("cell", F.pmod(F.xxhash64("ids"), F.lit(many))).withColumn(
        "q_cell", F.explode(F.sequence(F.lit(0), F.lit(q_many - 1)))
    )
    q_side = q_blocks.withColumn("q_cell", F.pmod(F.xxhash64("q_ids"), F.lit(q_many)).cast("int"))

    def paired(brackets: DataFrame) -> DataFrame:
        state = brackets.groupBy("block").agg(
            F.sort_array(F.collect_list(F.struct("query_id", "low", "width", "bins", "above", "done"))).alias("s")
        )
        wide = q_side.join(state, "block").withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(many - 1))))
        return v_side.join(wide, ["q_cell", "cell"]).filter("dim = q_dim").select(
            "block", "n", "dim", "largest", "ids", "cells", "q_n", "q_most", "q_ids", "q_cells",
            *(F.col(f"s.{c}").alias(c) for c in ("query_id", "low", "width", "bins", "above", "done")),
        )

    def histogram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                at = {i: j for j, i in enumerate(row["query_id"])}
                ids = np.frombuffer(row["q_ids"], dtype="<i8")
                out = []
                for first in range(0, row["q_n"], STEP):
                    if all(row["done"][at[i]] for i in ids[first : first + STEP]):
                        continue
                    for i, scores in zip(ids[first : first + STEP], _scores(row, first)):
                        j = at[i]
                        if not row["done"][j]:
                            found, counts = _top_bins(
                                scores, row["low"][j], row["width"][j], row["bins"][j], k - row["above"][j]
                            )
                            out.append(pd.DataFrame({"block": row["block"], "query_id": i, "bin": found, "n": counts}))
                if out:
                    yield pd.concat(out)

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                low = dict(zip(row["query_id"], row["low"]))
                v_ids, q_ids = (np.frombuffer(row[c], dtype="<i8") for c in ("ids", "q_ids"))
                for first in range(0, row["q_n"], STEP):
                    for i, scores in zip(q_ids[first : first + STEP], _scores(row, first)):
                        at = _best(scores, v_ids, low[i], k)
                        yield pd.DataFrame({"query_id": i, "vec_id": v_ids[at], "score": scores[at]})

    bound = F.least(F.ceil(F.col("q_most") * F.lit(most)), F.lit(LIMIT)).cast("long")
    width = F.ceil((2 * bound + 1) / BINS).cast("long")
    members = q_blocks.mapInPandas(
        lambda batches: (
            pd.DataFrame({"block": row["block"], "query_id": np.frombuffer(row["q_ids"], dtype="<i8")})
            for batch in batches for _, row in batch.iterrows()
        ), "block long, query_id long",
    )
    brackets = members.join(q_blocks.select("block", (-bound).alias("low"), width.alias("width")), "block").select(
        "block", "query_id", "low", "width", F.lit(BINS + 1).cast("long").alias("bins"),
        F.lit(0).cast("long").alias("above"), F.lit(False).alias("done"),
    )
    paths.append(new_folder(spark, "brackets"))
    brackets = stored(brackets, paths[-1])
    while not brackets.filter("NOT done").isEmpty():
        paths.append(new_folder(spark, "brackets"))
        brackets = stored(_narrowed(brackets, paired(brackets).mapInPandas(
            histogram, "block long, query_id long, bin long, n long"), k), paths[-1])
        drop(spark, paths.pop(-2))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    top = paired(brackets).mapInPandas(best, "query_id long, vec_id long, score long")
    return top.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _narrowed(brackets: DataFrame, counted: DataFrame, k: int) -> DataFrame:
    """Each bracket becomes its bin with the k-th best score.  A query is done when fewer
    than k scores exist, the bin is one value wide, or at most 4 k scores are left."""
    summed = counted.groupBy("block", "query_id", "bin").agg(F.sum("n").alias("n"))
    down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
    upto = summed.withColumn("upto", F.sum("n").over(down))
    need = F.lit(k) - F.col("above")
    hit = (
        upto.join(brackets.select("query_id", "above"), "query_id").filter(F.col("upto") >= need)
        .groupBy("query_id").agg(F.max_by(F.struct("bin", "n", "upto"), "bin").alias("hit"))
    )
    found = F.col("hit").isNotNull()
    above = F.col("above") + F.col("hit.upto") - F.col("hit.n")
    narrow = F.ceil(F.col("width") / BINS).cast("long")
    few = (F.col("above") + F.col("hit.upto") <= 4 * k) | (F.col("width") == 1)
    return brackets.join(hit, "query_id", "left").select(
        "block", "query_id",
        F.when(found & ~F.col("done"), F.col("low") + F.col("hit.bin") * F.col("width")).otherwise(F.col("low")).alias("low"),
        F.when(found & ~F.col("done"), narrow).otherwise(F.col("width")).alias("width"),
        F.when(found & ~F.col("done"), F.ceil(F.col("width") / narrow).cast("long")).otherwise(F.col("bins")).alias("bins"),
        F.when(found & ~F.col("done"), above).otherwise(F.col("above")).alias("above"),
        (F.col("done") | ~found | F.coalesce(few, F.lit(False))).alias("done"),
    )


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


OP4_SQL = """
WITH v AS (
    SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS c FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
scored AS (
    SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.c, v.c) AS BIGINT) AS score
    FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
