import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from storelens.llm import simhash
from storelens.llm.components import components
from storelens.llm.hamming import allocate, links, partition_bits

from tests.llm.tools import Groups, documents, shingles, similar_groups, table_rows


def fingerprint(text, size):
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, size)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def groups_within(values, distance):
    found = Groups(values)
    for n, a in enumerate(values):
        for b in values[n + 1 :]:
            if ((a ^ b) % 2**64).bit_count() <= distance:
                found.join(a, b)
    return {v: found.find(v) for v in values}


def groups_of_links(spark, values, **options):
    edges = links(spark.createDataFrame([(v,) for v in values], "fp long"), **options).collect()
    found = Groups(values)
    for r in edges:
        assert ((r.a ^ r.b) % 2**64).bit_count() <= options["max_distance"]
        found.join(r.a, r.b)
    return {v: found.find(v) for v in values}


@pytest.mark.parametrize("distance", [1, 2])
@pytest.mark.parametrize("dense", [2, 130])
def test_links_find_all_groups(spark, distance, dense):
    """Loose values, chains, a ball of values round one, and correlated bits."""
    r = random.Random(distance)
    values = {r.getrandbits(64) for _ in range(300)} | {0, 2**64 - 1}
    for v in list(values)[:60]:
        for _ in range(3):
            v ^= sum(1 << b for b in r.sample(range(64), r.randint(1, 3)))
            values.add(v)
    centre = r.getrandbits(64)
    values |= {centre ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(a, 64, 5)}
    values |= {(r.getrandbits(64) & 0xFFFF) | (0xABCDEF << 20) for _ in range(150)}
    values = sorted(map(signed, values))
    assert groups_of_links(spark, values, max_distance=distance, dense=dense) == groups_within(values, distance)


def test_links_of_little(spark):
    empty = spark.createDataFrame([], "fp long")
    assert links(empty).collect() == []
    assert links(spark.createDataFrame([(None,), (5,), (5,)], "fp long")).collect() == []
    assert links(spark.createDataFrame([(1,), (2,)], "fp long"), 0).collect() == []
    with pytest.raises(ValueError):
        links(empty, 3)


def test_allocation_is_the_cheapest():
    rng = np.random.default_rng(0)
    cost = rng.random((50, 4, 5))
    cost[:, :, 0] = 0
    thresholds, total = allocate(cost, -1)
    assert (thresholds.sum(axis=1) == -1).all()
    every = [t for t in np.ndindex(5, 5, 5, 5) if sum(t) - 4 == -1]
    best = np.min([sum(cost[:, p, t[p]] for p in range(4)) for t in every], axis=0)
    assert np.allclose(total, best)


def test_correlated_bits_share_a_partition():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, 1::4] = bits[:, [0]] ^ (rng.random((4000, 16)) < 0.05)
    groups = partition_bits(4000, bits.T @ bits, 3)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any(set(range(1, 64, 4)) <= set(g) for g in groups)


def test_components(spark):
    edges = [("b", "a"), ("b", "c"), ("x", "y"), ("y", "z"), ("q", "q"), ("b", "a"), (None, "a")]
    edges += [(f"n{i:03}", f"n{i + 1:03}") for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x", "z": "x"} | {f"n{i:03}": "n000" for i in range(41)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_odd_texts(spark):
    texts = [(9, None), (4, ""), (7, " \t\n"), (1, "One"), (2, "one two"), (3, "ONE\x0btwo"), (None, "one two"),
             (5, "É é"), (6, "é é"), (8, "a b c d"), (8, "a b c d"), (10, "w " * 40000), (11, "\x1c w")]
    got = simhash.simhash_components(documents(spark, texts).withColumn("fp", F.lit("clash")))
    assert got.columns == ["doc_id", "fp", "component_id"]
    fps = [signed(fingerprint(t, 3)) for _, t in texts]
    roots = groups_within(sorted(set(fps)), 2)
    least = {}
    for (i, _), fp in zip(texts, fps):
        if i is not None:
            least[roots[fp]] = min(i, least.get(roots[fp], i))
    want = [(i, fp, least.get(roots[fp])) for (i, _), fp in zip(texts, fps)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert simhash.simhash_components(documents(spark, [])).collect() == []


def test_query_on_table(spark, sf_dir):
    texts = table_rows(sf_dir, "documents", "doc_id, text")
    fps = {i: fingerprint(t, 3) for i, t in texts}
    roots = groups_within(sorted(set(fps.values())), 2)
    least = {}
    for i, fp in fps.items():
        least[roots[fp]] = min(i, least.get(roots[fp], i))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op2_simhash(spark, sf_dir).collect()}
    assert got == {i: (f"{fp:016x}", least[roots[fp]]) for i, fp in fps.items()}


def test_one_of_each_group_stays(spark, sf_dir):
    texts = dict(table_rows(sf_dir, "documents", "doc_id, text"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = simhash.keep_one_per_group(docs)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == set(similar_groups(texts, 5, 0.8).values())


def test_large_group_of_near_copies(spark):
    """300 copies, each with two words changed: pairs are far fewer than all, and one stays."""
    r = random.Random(3)
    text = [f"w{r.randrange(5000)}" for _ in range(400)]
    rows = []
    for i in range(300):
        own = list(text)
        for _ in range(2):
            own[r.randrange(400)] = f"new{r.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(f"x{r.randrange(5000)}" for _ in range(60))) for i in range(20)]
    got = {x.doc_id for x in simhash.keep_one_per_group(documents(spark, rows)).collect()}
    assert got == {0} | {1000 + i for i in range(20)}


def test_copies_with_odd_rows(spark):
    texts = [(3, "a b c d e f"), (2, "A b  c d e\nf"), (None, "a b c d e f"), (5, None), (4, " "), (None, "own text"),
             (7, "x y z"), (7, "x y z"), (8, "w " * 30000), (9, "W " * 30000)]
    got = simhash.keep_one_per_group(documents(spark, texts).withColumn("node", F.lit(1)))
    assert sorted(((r.doc_id, r.text) for r in got.select("doc_id", "text").collect()), key=repr) == sorted(
        [(2, "A b  c d e\nf"), (4, " "), (None, "own text"), (7, "x y z"), (8, "w " * 30000)], key=repr)
    assert got.columns[-1] == "node"
    assert simhash.keep_one_per_group(documents(spark, [])).collect() == []


def test_pairs_under_a_common_template(spark):
    """Most shingles are one template's, so pairs of copies meet in its crowded buckets only."""
    r = random.Random(5)
    template = [f"t{i}" for i in range(90)]
    texts = {}
    for i in range(0, 400, 2):
        own = [f"w{r.randrange(10**6)}" for _ in range(30)]
        copy = list(own)
        copy[8], copy[20] = "new", f"n{i}"
        texts[i], texts[i + 1] = " ".join(template + own), " ".join(template + copy)
    assert set(similar_groups(texts, 5, 0.8).values()) == set(range(0, 400, 2))
    got = {x.doc_id for x in simhash.keep_one_per_group(documents(spark, list(texts.items()))).collect()}
    assert got == set(range(0, 400, 2))


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(1)
    for n in [1, 2, 5, 9, 40, 200]:
        for _ in range(30):
            own = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            lost = rng.integers(0, n // 5 + 1)
            other = np.unique(np.concatenate([own[lost:], rng.integers(0, 2**63, rng.integers(0, 3)).astype(np.uint64)]))
            common = np.sort(rng.permutation(own)[: n // 2])
            often = rng.integers(2, 9, len(common))
            shared = len(np.intersect1d(own, other))
            if shared >= 0.8 * (len(own) + len(other) - shared):
                a, b = (simhash.prefix(s, common, often, 0.8) for s in (own, other))
                assert len(np.intersect1d(a, b))


@pytest.mark.parametrize("n", [3, 200, 1000, 1500, 5000])
def test_parities_allow_every_similar_pair(spark, n):
    """Tables of one width and of two: never more bits apart than members, and strangers go."""
    rng = np.random.default_rng(n)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64))]
    for lost, new in ((0, 0), (n // 10, n // 10), (0, n // 5), (n // 6, 0), (n // 2, n // 2), (n, n)):
        sets.append(np.unique(np.concatenate([sets[0][lost:], rng.integers(0, 2**63, new).astype(np.uint64)])))
    rows = [(i, len(s), simhash.parity(s).tolist()) for i, s in enumerate(sets)]
    nodes = spark.createDataFrame(rows, "id long, n int, parity array<long>")
    pairs = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))]
    got = {tuple(r) for r in simhash._can_be(spark.createDataFrame(pairs, "a long, b long"), nodes, 0.8).collect()}
    shared = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a, b in pairs}
    similar = {(a, b) for (a, b), k in shared.items() if k >= 0.8 * (len(sets[a]) + len(sets[b]) - k)}
    assert similar <= got and (0, 6) not in got and (n < 200 or (0, 5) not in got)
