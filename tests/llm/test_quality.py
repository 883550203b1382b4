from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from storelens.llm import quality

from tests.llm.tools import documents, table_rows, words


def brute(text):
    found = words(text)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    many = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if many[w] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = len(found) < 50 or 100 * len(covered) > 50 * len(found)
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered), failed)


def base(df):
    return [tuple(r[c] for c in (*quality.BASE, "base_failed")) for r in df.collect()]


def test_statistics_of_odd_texts(spark):
    texts = [
        None, "", "  \n\t", "a", "a b", "a b c", "a a a a a a", "x y z x y z", "a b c d a b c d a b", "é #|<\n\né #|<",
        "one two three\none two three\n one two three", "\x0b\x0ca\rb\x1cc d", "w " * 30000, " ".join(f"w{i}" for i in range(30000)),
        "a b c a b c", "a b c a b c",
    ]
    got = base(quality.judged(documents(spark, [(i, t) for i, t in enumerate(texts)]).coalesce(1), []))
    assert got == [brute(t) for t in texts]


def test_list_applies_in_order_and_replaces_columns(spark):
    docs = documents(spark, [(1, "w # " * 50), (2, " ".join(map(str, range(90))))]).withColumn("kept", F.lit("old"))
    rules = [(quality.Condition("symbol_share", True, 0.1),)]
    got = quality.judged(docs, rules)
    assert got.columns.count("kept") == 1
    assert {r.doc_id: (r.base_failed, r.kept) for r in got.collect()} == {1: (True, False), 2: (False, True)}
    assert quality.judged(documents(spark, []), rules).collect() == []


def test_learner_finds_a_conjunction():
    random = np.random.default_rng(1)
    x, y = random.random(3000), random.random(3000)
    bad = (x > 0.7) & (y <= 0.3)
    rules = quality.learn_list({"x": x, "y": y}, bad)
    x, y = random.random(3000), random.random(3000)
    said = np.zeros(3000, dtype=bool)
    for rule in rules:
        said |= np.logical_and.reduce([c.holds({"x": x, "y": y}) for c in rule])
    assert (said == ((x > 0.7) & (y <= 0.3))).mean() > 0.97


def test_learner_without_a_class():
    assert quality.learn_list({"x": []}, []) == []
    assert quality.learn_list({"x": [1, 2, 3] * 9}, [True] * 27) == []
    assert quality.learn_list({"x": [1, 2, 3] * 9}, [False] * 27) == []


def test_fit_ignores_null_labels_and_empty_tables(spark):
    docs = documents(spark, [(1, "a"), (None, "b")])
    labels = spark.createDataFrame([(1, None, 0), (None, 0, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.fit(docs, labels) == []
    assert quality.fit(docs, labels.limit(0)) == []


def test_held_out_documents(spark):
    """Learned on one half of the labels, judged on the other."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    half = F.xxhash64(F.lit(5), "doc_id") % 2 == 0
    rules = quality.fit(docs, labels.filter(half))
    judged = quality.judged(docs.join(labels.filter(~half), "doc_id"), rules).filter("NOT base_failed")
    said = Counter((r.quality, r.kept) for r in judged.select("quality", "kept").collect())
    assert said[1, True] >= 0.99 * (said[1, True] + said[1, False])
    assert said[0, False] >= 0.95 * (said[0, True] + said[0, False])


def test_query_on_table(spark, sf_dir):
    got = {r.doc_id: r for r in quality.op7_quality_rules(spark, sf_dir).collect()}
    for doc_id, text in table_rows(sf_dir, "documents", "doc_id, text"):
        r = got.pop(doc_id)
        assert tuple(r[c] for c in (*quality.BASE, "base_failed")) == brute(text)
        assert not (r.base_failed and r.kept)
    assert not got
