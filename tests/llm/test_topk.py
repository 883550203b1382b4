import math
import random

import numpy as np
import pytest

from storelens.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k, scale=1024):
    def cells(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(scale * float(np.float32(x))) for x in v]

    known = [(i, c) for i, v, *_ in rows if i is not None and (c := cells(v)) is not None]
    asked = {}
    for i, v, *_ in queries:
        if i is not None and (c := cells(v)) is not None:
            asked[i] = min(asked.get(i, c), c)
    out = []
    for q, a in asked.items():
        scored = sorted(
            (-sum(x * y for x, y in zip(a, b)), i) for i, b in known if i != q and len(a) == len(b)
        )[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("block_bytes", [200, 1 << 22])
def test_odd_vectors_and_ties(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(topk, "BINS", 4)
    r = random.Random(2)
    rows = [(i, [r.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(3)], 0) for i in range(150)]
    rows += [(200 + i, [0.5, 0.5, 0.5], 0) for i in range(60)]  # many copies of one vector
    rows += [(300, None, 0), (301, [1.0, None, 0.0], 0), (302, [float("nan"), 1.0, 1.0], 0), (303, [float("inf"), 1.0, 1.0], 0),
             (None, [1.0, 1.0, 1.0], 0), (400, [1.0, 2.0], 0), (401, [3.0, 1.0], 0), (402, [9.0], 0), (7, [1.0, 1.0, 1.0], 0),
             (500, [1e30, -1e30, 5.0], 0), (501, [], 0), (-600, [0.1, 0.2, 0.3], 0)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    queries = vectors.filter("vec_id % 10 = 0 OR vec_id IN (7, 301, 401, 402, 501)")
    asked = [x for x in rows if x[0] is not None and (x[0] % 10 == 0 or x[0] in (7, 301, 401, 402, 501))]
    got = found(topk.top_k(vectors, queries, 5, block_bytes=block_bytes, query_block_bytes=block_bytes))
    want = [(q, n, i, max(-topk.LIMIT, min(topk.LIMIT, s))) for q, n, i, s in brute(rows, asked, 5)]
    clear = {500}  # beyond the limit scores tie
    assert [x for x in got if x[0] not in clear and abs(x[3]) < topk.LIMIT] == [
        x for x in want if x[0] not in clear and abs(x[3]) < topk.LIMIT]
    assert len(got) == len(want)


def test_more_than_one_pass(spark, monkeypatch):
    monkeypatch.setattr(topk, "BINS", 3)
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype("float32")], 0) for i in range(400)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    got = found(topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 7, block_bytes=2000, query_block_bytes=100))
    assert got == brute(rows, [x for x in rows if x[0] % 50 == 0], 7)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(1, [1.0], 0)], SCHEMA)
    assert found(topk.top_k(none, none, 3)) == found(topk.top_k(one, none, 3)) == found(topk.top_k(one, one, 3)) == []


def test_query_on_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert found(topk.op4_top_k(spark, sf_dir)) == brute(rows, [x for x in rows if x[0] % 100 == 0], 10)
