"""Exact nearest descriptions by cosine similarity.

Vectors are packed into blocks of a bounded number of rows, and blocks of questions meet
blocks of descriptions in a grid of tiles.  The grid is sized from both tables: as few
columns as memory allows, since a block of descriptions moves once per column, and as
many rows as there is work for.  A task keeps the best rows per question of its tile, so
pairs never become rows, and no vector goes through the driver or a broadcast.

The rows of a block are gathered around centres.  By the triangle inequality no row of a
group scores above the centre's own score plus the group's radius, so a group is passed
over, without any loss, by the questions that have enough better rows already.  Questions
are gathered too, so those looked at together tend to need the same groups.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.operators.ranking import top_n_per_group
from storelens.retrieval import DEFAULT_LIMIT, checked_limit

# Fixed value: description rows looked at per table asked for.
MULTIPLIER = 10
BLOCK_ROWS = 4096
GROUP_ROWS = 64
TILE_BYTES = 32 << 20
DIGITS = 6
STEP = 256
PIECE = 1024
FOUND = "question_id long, row_id long, table_name string, score double"


def _parts(df: DataFrame, total: Column, size: int) -> Column:
    """How many parts of about ``size``, as a subquery."""
    return df.agg(F.greatest(F.ceil(total / size), F.lit(1))).scalar()


def _blocks(df: DataFrame, key: str, rows: int, group_rows: int) -> DataFrame:
    """(cell, ids, tables, matrix, centres, radii, starts): the vectors of a block, scaled
    to length one, those around one centre side by side."""

    def gathered(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The group of each row and the centres; some rounds of means from spread-out rows."""
        many = -(-len(matrix) // group_rows)
        centres = matrix[np.linspace(0, len(matrix) - 1, many).astype(int)]
        for _ in range(4):
            of = np.argmin((centres**2).sum(axis=1) - 2 * matrix @ centres.T, axis=1)
            counts = np.bincount(of, minlength=len(centres))
            sums = np.zeros_like(centres)
            np.add.at(sums, of, matrix)
            centres, of = sums[counts > 0] / counts[counts > 0, None], (np.cumsum(counts > 0) - 1)[of]
        return of, centres

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(key, kind="stable")
        matrix = np.stack([np.asarray(v, dtype="<f8") for v in block["vector"]])
        norms = np.linalg.norm(matrix, axis=1, keepdims=True)
        matrix = matrix / np.where(norms == 0, 1.0, norms)
        of, centres = gathered(matrix)
        order = np.argsort(of, kind="stable")
        radii = np.zeros(len(centres))
        np.maximum.at(radii, of, np.linalg.norm(matrix - centres[of], axis=1))
        return pd.DataFrame({
            "cell": [block["cell"].iloc[0]], "ids": [block[key].to_numpy(dtype="<i8")[order].tobytes()],
            "tables": [block["table_name"].to_numpy()[order].tolist()], "matrix": [matrix[order].tobytes()],
            "centres": [centres.tobytes()], "radii": [radii.tobytes()],
            "starts": [np.r_[0, np.cumsum(np.bincount(of))].astype("<i8").tobytes()],
        })

    schema = "cell long, ids binary, tables array<string>, matrix binary, centres binary, radii binary, starts binary"
    cells = _parts(df, F.count("*"), rows)
    return df.withColumn("cell", F.pmod(F.xxhash64(key), cells)).groupBy("cell").applyInPandas(pack, schema)


def tiles(asked: DataFrame, rows: DataFrame, tile_bytes: int = TILE_BYTES) -> tuple[Column, Column]:
    """Rows and columns of the grid for two tables with a ``vector``, as subqueries."""
    size = 8 * F.sum(F.size("vector").cast("long"))
    tasks = asked.sparkSession.sparkContext.defaultParallelism
    columns = _parts(asked, F.coalesce(size, F.lit(0)), tile_bytes)
    return F.greatest(_parts(rows, F.coalesce(size, F.lit(0)), tile_bytes), F.ceil(F.lit(tasks) / columns)), columns


def dealt(blocks: DataFrame, own: str, n: Column, other: str, m: Column) -> DataFrame:
    """Every block once for each tile of its row (or column) of the grid."""
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), m.cast("long") - 1))
    return blocks.withColumn(own, F.pmod("cell", n.cast("long"))).withColumn(other, everywhere)


def _nearest(k: int):
    """The best ``k`` rows per question of a tile.

    Whole blocks are multiplied in single precision, which rules out all but a few rows per
    question; these are scored again, exactly.  What is found waits until there is about
    as much of it as is kept, so that the lists are sorted a few times a tile.

    As inner functions they are sent to the tasks by value, so workers need no copy of
    this package.
    """
    step, piece = STEP, PIECE

    def exact(asked: np.ndarray, q: np.ndarray, rows: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Summed from the first component to the last, so that equal vectors tie."""
        parts = [slice(at, at + piece) for at in range(0, len(q), piece)]
        return np.concatenate([np.cumsum(asked[q[p]] * rows[r[p]], axis=1)[:, -1] for p in parts])

    def rough_hits(asked: np.ndarray, rows: np.ndarray, least: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray]:
        """(question, row) of all pairs that may be among the best ``k``."""
        rough = asked @ rows.T
        hits = rough >= (least - slack).astype("<f4")[:, None]
        if len(rows) > k:
            many = np.flatnonzero(np.count_nonzero(hits, axis=1) > 2 * k)
            if len(many):
                kth = np.partition(rough[many], -k, axis=1)[:, -k]
                hits[many] &= rough[many] >= (kth - slack).astype("<f4")[:, None]
        return np.divmod(np.flatnonzero(hits), len(rows))

    def merge(best: dict, found: list, ids: np.ndarray) -> None:
        """Put what was found into the lists; of equal scores the lower id stays."""
        touched = np.unique(np.concatenate([q for q, _, _ in found]))
        of = np.concatenate([np.repeat(touched, k), *(q for q, _, _ in found)])
        row = np.concatenate([best["row"][touched].ravel(), *(r for _, r, _ in found)])
        score = np.concatenate([best["score"][touched].ravel(), *(s for _, _, s in found)])
        order = np.lexsort((ids[row], -score, of))
        of = of[order]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        place = np.arange(len(of)) - np.repeat(first, np.diff(np.r_[first, len(of)]))
        stays = place < k
        best["row"][of[stays], place[stays]] = row[order][stays]
        best["score"][of[stays], place[stays]] = score[order][stays]

    def run(asked_blocks: pd.DataFrame, row_blocks: pd.DataFrame) -> pd.DataFrame:
        shape = lambda cells, n: np.frombuffer(cells, dtype="<f8").reshape(n, -1)
        out = {"question_id": [np.zeros(0, dtype="<i8")], "row_id": [np.zeros(0, dtype="<i8")],
               "table_name": [np.zeros(0, dtype=object)], "score": [np.zeros(0)]}
        blocks, ids, names, begin = [], [np.zeros(0, dtype="<i8")], [np.zeros(0, dtype=object)], 0
        for b in row_blocks.sort_values("cell").itertuples(index=False):
            ids.append(np.frombuffer(b.ids, dtype="<i8"))
            names.append(np.asarray(b.tables, dtype=object))
            rows, radii = shape(b.matrix, len(ids[-1])), np.frombuffer(b.radii, dtype="<f8")
            groups = np.repeat(np.arange(len(radii)), np.diff(np.frombuffer(b.starts, dtype="<i8")))
            blocks.append((begin, rows, rows.astype("<f4"), shape(b.centres, len(radii)), radii, groups))
            begin += len(rows)
        # the row after the last one fills lists that are not full yet
        ids = np.concatenate([*ids, [np.iinfo(np.int64).max]])
        names = np.concatenate([*names, [None]])
        for a in asked_blocks.itertuples(index=False):
            all_ids = np.frombuffer(a.ids, dtype="<i8")
            everyone = shape(a.matrix, len(all_ids))
            # bounds the error of products of rounded unit vectors, on either side
            slack = 2 * (everyone.shape[1] + 4) * 2.0**-24 + 1e-9
            for at in range(0, len(all_ids), step):
                asked, q_ids = everyone[at : at + step], all_ids[at : at + step]
                rounded, n = asked.astype("<f4"), len(asked)
                best = {"score": np.full((n, k), -np.inf), "row": np.full((n, k), begin)}
                found, waiting = [], 0
                for first, rows, rounded_rows, centres, radii, groups in blocks:
                    near = asked @ centres.T + radii + 1e-9 >= best["score"][:, -1:]
                    some, which = np.flatnonzero(near.any(axis=1)), near.any(axis=0)
                    if not len(some):
                        continue
                    chosen = np.flatnonzero(which[groups])
                    q, r = rough_hits(rounded[some], rounded_rows[chosen], best["score"][some, -1], slack)
                    if not len(q):
                        continue
                    q, r = some[q], chosen[r]
                    found.append((q, r + first, exact(asked, q, rows, r)))
                    waiting += len(q)
                    if waiting >= n * k or best["score"][0, 0] == -np.inf:
                        merge(best, found, ids)
                        found, waiting = [], 0
                if found:
                    merge(best, found, ids)
                q, place = np.nonzero(best["score"] > -np.inf)
                out["question_id"].append(q_ids[q])
                out["row_id"].append(ids[best["row"][q, place]])
                out["table_name"].append(names[best["row"][q, place]])
                out["score"].append(best["score"][q, place])
        whole = {column: np.concatenate(parts) for column, parts in out.items()}
        return pd.DataFrame(whole | {"table_name": pd.Series(whole["table_name"], dtype=object)})

    return run


def semantic_rows(
    questions: DataFrame, descriptions: DataFrame, limit: int = DEFAULT_LIMIT, multiplier: int = MULTIPLIER,
    digits: int = DIGITS, block_rows: int = BLOCK_ROWS, tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """The best ``limit * multiplier`` description rows per question.

    questions: question_id bigint, vector; descriptions: row_id bigint, table_name,
    vector; rows without a vector take no part.  Rows are ranked by the whole score, summed
    in one order, so that equal vectors tie; ties go to the lower row_id.  The score shown
    is rounded to ``digits`` digits.
    """
    k = checked_limit(limit) * multiplier
    asked = questions.filter("vector IS NOT NULL").select(
        F.col("question_id").cast("long"), F.lit(None).cast("string").alias("table_name"), "vector"
    )
    rows = descriptions.filter("vector IS NOT NULL").select(
        F.col("row_id").cast("long"), F.col("table_name").cast("string"), "vector"
    )
    tall, wide = tiles(asked, rows, tile_bytes)
    asked_blocks = _blocks(asked, "question_id", block_rows, GROUP_ROWS).select("cell", "ids", "matrix")
    row_blocks = _blocks(rows, "row_id", block_rows, GROUP_ROWS)
    tile = ["row", "column"]
    found = dealt(asked_blocks, "column", wide, "row", tall).groupBy(*tile).cogroup(
        dealt(row_blocks, "row", tall, "column", wide).groupBy(*tile)
    ).applyInPandas(_nearest(k), FOUND)
    best = top_n_per_group(found, ["question_id"], [F.desc("score"), F.col("row_id")], k, "row_rank")
    return best.withColumn("score", F.round("score", digits))


def semantic_tables(
    questions: DataFrame, descriptions: DataFrame, limit: int = DEFAULT_LIMIT, excluded: Sequence[str] = ()
) -> DataFrame:
    """The best ``limit`` tables per question by the mean score of their hits."""
    scored = (
        semantic_rows(questions, descriptions, limit)
        .filter(~F.col("table_name").isin(*excluded))
        .groupBy("question_id", "table_name")
        .agg(
            (F.sum(F.col("score").cast("decimal(10,6)")).cast("double") / F.count("*")).alias("relevance_score"),
            F.count("*").alias("listed_columns"),
        )
    )
    order = [F.desc("relevance_score"), F.col("table_name")]
    return top_n_per_group(scored, ["question_id"], order, checked_limit(limit), "table_rank")
