import random
import zlib
from hashlib import sha256

import pytest

import __spark_entry__ as registered
from check import compare, connect
from storelens.llm import merkle
from tests.llm.tools import DOCS

from pyspark.sql import functions as F


def h(*digests):
    return sha256("".join(digests).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    out = ""
    for value in (doc_id, source, lang, n_chars, text):
        out += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return sha256(out.encode()).hexdigest()


def grow(nodes, fanout):
    """All levels of one tree, by the definition."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def climb(levels, at, digest, fanout):
    beside = []
    for level in levels[:-1]:
        first = at - at % fanout
        run = level[first : first + fanout]
        beside += run[: at - first] + run[at - first + 1 :]
        digest = h(*run[: at - first], digest, *run[at - first + 1 :])
        at //= fanout
    return beside, digest


def brute(rows, tampered, fanout=2):
    parts = {}
    for row in rows:
        parts.setdefault(row[2], []).append((row, leaf(*row)))
    names = sorted(parts, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = []
    for name in names:
        parts[name].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees.append(grow([digest for _, digest in parts[name]], fanout))
    top = grow([t[-1][0] for t in trees], fanout)
    out = []
    for n, (name, levels) in enumerate(zip(names, trees)):
        for at, ((doc_id, text, lang, source, n_chars), digest) in enumerate(parts[name]):
            changed = digest
            if tampered(doc_id) and n_chars is not None:
                changed = leaf(doc_id, text, lang, source, n_chars + 1)
            below, sub = climb(levels, at, changed, fanout)
            above, root = climb(top, n, sub, fanout)
            out.append((doc_id, digest, levels[-1][0], top[-1][0], h(*below, *above), root, root == top[-1][0]))
    return sorted(out, key=repr)


def crc(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def drawn():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0


def audited(spark, rows, **options):
    df = merkle.audit(spark.createDataFrame(rows, DOCS), drawn(), **options)
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(n, seed):
    r = random.Random(seed)
    rows = [(i, r.choice([None, "", "a b", "é" * r.randint(0, 5)]), r.choice([None, "", "en", "en", "en", "de", "ü"]),
             r.choice([None, "", "s"]), r.choice([None, 0, 7, 2**63 - 1])) for i in range(-5, n)]
    return rows + rows[:3] + [(None, None, None, None, None), (None, "x", "en", None, 1), (3, "other", "en", "s", 2)]


@pytest.mark.parametrize("n,fanout,depth", [(1, 2, 9), (40, 2, 2), (130, 2, 3), (60, 3, 1), (90, 4, 2), (33, 2, 1)])
def test_against_definition(spark, n, fanout, depth):
    rows = table(n, n)
    assert audited(spark, rows, fanout=fanout, depth=depth) == brute(rows, crc, fanout)


@pytest.mark.parametrize("n", range(1, 10))
def test_every_small_size(spark, n):
    """Runs of every length, the last one of a single node too, with the same root however cut."""
    rows = [(i, "t", "en", "s", 1) for i in range(n)]
    assert audited(spark, rows, depth=1) == brute(rows, crc)


def test_cut_makes_no_difference(spark):
    rows = [(i, "t" * (i % 9), "en" if i % 3 else "fr", "s", i) for i in range(300)]
    assert audited(spark, rows, depth=2) == audited(spark, rows, depth=9)


def test_states_are_resumed():
    digests = [h(str(i)).encode() for i in range(11)]
    levels, states = merkle.run_levels(digests, 4, None)
    other = h("other").encode()
    state = states[0][1][2].copy()  # before the third child of the second parent
    state.update(other + digests[7])
    assert state.hexdigest() == h(*(d.decode() for d in (digests[4], digests[5], other, digests[7])))
    assert levels[1][1].decode() == h(*(d.decode() for d in digests[4:8]))  # the kept state itself is unchanged


def test_empty_single_and_clashing(spark):
    assert audited(spark, []) == []
    assert merkle.manifest(spark.createDataFrame([], "grp string, doc_id long, digest string")).root is None
    one = [(9, "long " * 100_000, None, None, None)]
    assert audited(spark, one) == brute(one, crc)
    docs = spark.createDataFrame([(1, "a", "en", "s", 1), (2, "b", None, "s", None)], DOCS)
    odd = docs.selectExpr("*", "1 AS grp", "'x' AS digest", "2 AS pos", "3 AS n", "4 AS run", "5 AS replacement")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted((tuple(r) for r in merkle.audit(odd, drawn()).collect()), key=repr) == brute(rows, crc)


def test_root_of_manifest(spark):
    rows = [(i, "t", "en", "s", 1) for i in range(20)]
    leaves = spark.createDataFrame([("1en", i, leaf(*row)) for i, row in enumerate(rows)], "grp string, doc_id long, digest string")
    assert merkle.manifest(leaves, depth=2).root == brute(rows, crc)[0][3]


def test_query_agrees_with_sql(spark, sf_dir):
    assert compare(spark, connect(sf_dir), sf_dir, "op11_merkle_manifest") == ""
    assert registered.oracle_sql()["op11_merkle_manifest"]
