import random
import re
from itertools import permutations

import pytest

from check import compare, connect
from pyspark.sql import functions as F
from storelens.llm import interaction
from tests.llm.tools import DOCS, words

LABELS = "doc_id long, quality int, toxic int"
FIELDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failing(text):
    found = words(text)
    text = text or ""
    out = set()
    if len(found) < 100:
        out.add("A")
    if 100 * len(set(found)) < 80 * len(found):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
        out.add("C")
    if re.search(r"[#$%&*|]", text):
        out.add("D")
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    docs = []
    for i, text, lang, *_ in rows:
        bad = failing(text)
        if i is not None and i > first[text or ""]:
            bad.add("E")
        docs.append((lang or "", bad, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            here = [d for d in docs if d[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                removed = [d for d in here if f in d[1]]
                redundant = sum(f in d[1] for d in gone)
                here = [d for d in here if f not in d[1]]
                gone += removed
                shapley[f] += len(removed)
                out[part, order, step] = (
                    len(here), len(removed), redundant, sum(d[1] == {f} for d in docs if d[0] == part),
                    sum(d[2] for d in removed), sum(d[3] for d in removed),
                )
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                out[part, order, step] += (shapley[f],)
    return out


def audited(spark, rows, labels):
    df = interaction.audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))
    out = {(r.part, r.filter_order, r.step): tuple(r[c] for c in (*FIELDS, "shapley")) for r in df.collect()}
    assert df.columns == ["part", "filter_order", "step", *FIELDS, "shapley"]
    return out


def test_against_definition(spark):
    r = random.Random(5)
    pool = ["word%d" % i for i in range(150)]
    texts = [None, "", " \n", "A B C", "#", "x " * 120, " ".join(pool[:100]), " ".join(pool[:99]), " ".join(pool) + " & more",
             " ".join(pool[:80] + pool[:20]), " ".join(pool[:79] + pool[:21]), "ABC" + "d" * 27, "ABC" + "d" * 26, "É" * 9 + "A",
             " ".join(pool).upper(), "a\x0bb\x0cc d"]
    rows = [(i, r.choice(texts), r.choice(["en", "en", "en", "de", None, ""]), "s", 0) for i in range(400)]
    rows += rows[:20] + [(None, texts[3], "en", "s", 0), (None, texts[3], "de", "s", 0), (-7, texts[6], "de", None, None)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 500, 3)]
    labels += [(3, 1, 1), (3, 0, 0), (None, 1, 1)]
    assert audited(spark, rows, labels) == brute(rows, labels)


def test_large_group_of_copies_and_long_text(spark):
    rows = [(i, "same text", "en" if i % 4 else "fr", "s", 0) for i in range(1, 3000)]
    rows += [(0, "word " * 200_000, "en", "s", 0)]
    labels = [(i, 1, i % 2) for i in range(0, 100)]
    assert audited(spark, rows, labels) == brute(rows, labels)


def test_empty_and_clashing(spark):
    assert audited(spark, [], []) == {}
    rows = [(1, "A", "en", "s", 1), (2, "A", None, "s", 1)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr(
        "*", "0 AS mask", "'x' AS part", "1 AS good", "1 AS toxic", "1 AS n", "1 AS step", "2 AS kept", "3 AS quality")
    labels = spark.createDataFrame([(1, 1, 0)], LABELS).selectExpr("*", "'t' AS text", "'l' AS lang", "0 AS part")
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in (*FIELDS, "shapley")) for r in interaction.audit(docs, labels).collect()}
    assert got == brute(rows, [(1, 1, 0)])


def test_other_filters(spark):
    """Any filters of the text, without the one for identical texts."""
    docs = spark.createDataFrame([(1, "ab", "en", "s", 1), (2, "abc", "en", "s", 1), (3, None, "en", "s", 1)], DOCS)
    labels = spark.createDataFrame([], LABELS)
    cells = interaction.mask_cells(
        docs, labels, lambda t: F.array(F.length(t) < 3, t.contains("a")), n_filters=2, identical=False)
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails) for r in interaction.fold_cells(cells, "SA").collect()}
    assert got == {("SA", 1): (1, 2, 0, 1), ("SA", 2): (0, 1, 1, 1), ("AS", 1): (1, 2, 0, 1), ("AS", 2): (0, 1, 1, 1)}
    with pytest.raises(ValueError):
        interaction.fold_cells(cells, "ABCDEFG")


def test_query_agrees_with_sql(spark, sf_dir):
    assert compare(spark, connect(sf_dir), sf_dir, "op13_filter_audit") == ""
