import math
import random

import duckdb
import numpy as np
import pytest

from storelens.llm import vptree

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, asked, k):
    """The contract by plain loops: products summed from the first component on."""
    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def doubles(v):
        return [float(np.float32(x)) for x in v]

    known = [(i, doubles(v)) for i, v, *_ in rows if i is not None and usable(v)]
    queries = {}
    for i, v, *_ in asked:
        if i is not None and usable(v):
            queries[i] = min(queries.get(i, doubles(v)), doubles(v))
    out = []
    for q, a in queries.items():
        scored = []
        for i, b in known:
            if i != q and len(a) == len(b):
                total = 0.0
                for x, y in zip(a, b):
                    total += x * y
                scored.append((-total, i))
        out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def random_rows(n, dim, seed, lengths=(1.0,)):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, dim)) * rng.choice(lengths, size=(n, 1)) / math.sqrt(dim)
    return [(i, [float(x) for x in row.astype("float32")], 0) for i, row in enumerate(rows)]


@pytest.mark.parametrize("shard_rows,tile_bytes", [(37, 2000), (1 << 12, 1 << 25)])
def test_factor_one_is_exact(spark, shard_rows, tile_bytes):
    rows = random_rows(300, 6, 3, lengths=(0.01, 1.0, 20.0))
    rows += [(1000 + i, [0.5, 0.5, 0.0, 0.0, 0.0, 0.0], 0) for i in range(120)]  # copies that tie
    rows += [(2000, None, 0), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (2002, [0.0] * 6, 0), (2003, [], 0),
             (2004, [float("nan")] + [1.0] * 5, 0), (2005, [float("inf")] + [1.0] * 5, 0), (None, [1.0] * 6, 0),
             (2006, [1.0, 2.0], 0), (2007, [2.0, -1.0], 0), (2008, [9.0], 0), (5, [0.25] * 6, 0), (5, [0.25] * 6, 0)]
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(5)
    asked = [r for r in rows if r[0] is not None and (r[0] % 10 == 0 or r[0] in (5, 1003, 2002, 2006, 2008))]
    queries = spark.createDataFrame(asked, SCHEMA)
    got = found(vptree.nearest(vectors, queries, 7, factor=1.0, shard_rows=shard_rows, leaf_rows=5, tile_bytes=tile_bytes))
    assert got == brute(rows, asked, 7)


def clusters(n, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, 16)) * 3
    return centres[rng.integers(0, 20, n)] + rng.normal(size=(n, 16)) * 0.3


def test_larger_factor_searches_less():
    cells, ids = clusters(4000), np.arange(4000)
    length = float(np.linalg.norm(cells, axis=1).max())
    order, starts, points, ranges = vptree.tree(vptree.lifted(cells, length), 32)
    assert sorted(order) == list(range(4000)) and np.diff(starts).max() <= 32
    truth = np.argsort(-(cells[:100] @ cells.T) + 1e9 * np.eye(100, 4000), axis=1)[:, :10]
    seen = []
    for factor in (1.0, 1.5, 4.0):
        best = vptree.Best(ids[:100], cells[:100], 10)
        vptree.search(best, ids[order], cells[order], starts, points, ranges, length, factor)
        seen.append(best.searched)
        if factor == 1.0:
            assert (np.sort(best.ids) == np.sort(truth)).all()
    assert 100 * 4000 > seen[0] > seen[1] > seen[2]


@pytest.mark.parametrize("unit", [False, True])
def test_fitted_factor_keeps_the_recall(spark, unit):
    """Lengths that differ, where factors a hair above one already lose, and unit vectors."""
    cells = clusters(1500)
    if unit:
        cells /= np.linalg.norm(cells, axis=1, keepdims=True)
    rows = [(i, [float(x) for x in v.astype("float32")], 0) for i, v in enumerate(cells)]
    vectors, asked = spark.createDataFrame(rows, SCHEMA), [r for r in rows if r[0] % 5 == 0]
    got = found(vptree.nearest(vectors, spark.createDataFrame(asked, SCHEMA), 10, recall=0.95, shard_rows=400, leaf_rows=16))
    want = {(q, v) for q, _, v, _ in brute(rows, asked, 10)}
    assert len({(q, v) for q, _, v, _ in got} & want) >= 0.92 * len(want)


def test_bounds_hold():
    rng = np.random.default_rng(4)
    cells = vptree.lifted(rng.normal(size=(500, 8)), 6.0)
    order, starts, points, ranges = vptree.tree(cells, 20)
    asked = np.hstack([rng.normal(size=(30, 8)), np.zeros((30, 1))])
    bounds = vptree.leaf_bounds(asked, points, ranges)
    for leaf in range(len(starts) - 1):
        members = cells[order[starts[leaf] : starts[leaf + 1]]]
        assert (vptree.distances(asked, members).min(axis=1) >= bounds[:, leaf] - 1e-7).all()


def test_grid_moves_each_shard_and_block_a_bounded_number_of_times():
    gib = 1 << 30
    tall, wide = vptree.grid(1000 * gib, 50 * gib, gib, 100)
    assert (tall, wide) == (1000, 50)
    assert vptree.grid(1 << 20, 1 << 10, gib, 24) == (24, 1)  # queries that fit are not cut


def test_empty_and_wrong(spark):
    none, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, [1.0], 0)], SCHEMA)
    assert found(vptree.nearest(none, none, 3)) == found(vptree.nearest(one, none, 3)) == found(vptree.nearest(one, one, 3)) == []
    with pytest.raises(ValueError):
        vptree.nearest(one, one, 3, factor=0.5)


def test_other_columns(spark):
    rows = [(i, [float(x) for x in random.Random(i).choices([-1, 0, 1, 2], k=4)], 0) for i in range(40)]
    plain = spark.createDataFrame(rows, SCHEMA)
    odd = plain.selectExpr("vec_id", "embedding", "1 AS id", "2 AS v", "'x' AS shard", "0 AS rank", "0 AS dim", "0 AS _row")
    queries = odd.filter("vec_id % 4 = 0")
    assert found(vptree.nearest(odd, queries, 5, factor=1.0)) == brute(rows, [r for r in rows if r[0] % 4 == 0], 5)


def test_query_on_table(spark, sf_dir):
    """Recall of the registered query, and its scores against DuckDB's."""
    want = duckdb.connect().execute(f"""
        WITH v AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS c FROM '{sf_dir}/embeddings.parquet'
                   WHERE vec_id IS NOT NULL AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
                     AND len([x FOR x IN embedding IF x <> 0]) > 0)
        SELECT q.vec_id, v.vec_id, list_dot_product(q.c, v.c) FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0
    """).fetchall()
    scores = {(q, v): s for q, v, s in want}
    by_query = {}
    for q, v, s in want:
        by_query.setdefault(q, []).append((-s, v))
    truth = {(q, v) for q, all_rows in by_query.items() for _, v in sorted(all_rows)[:20]}
    got = found(vptree.op12_vp_nearest(spark, sf_dir))
    assert all(scores[q, v] == pytest.approx(s, rel=1e-12) for q, _, v, s in got)
    assert len({(q, v) for q, _, v, _ in got} & truth) >= 0.9 * len(truth)
    per_query = {}
    for q, n, v, s in got:
        per_query.setdefault(q, []).append((n, -s, v))
    assert set(per_query) == set(by_query)
    for rows in per_query.values():
        assert [n for n, *_ in sorted(rows)] == list(range(1, 21))
        assert [x[1:] for x in sorted(rows)] == sorted(x[1:] for x in rows)
