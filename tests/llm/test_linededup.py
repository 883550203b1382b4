import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from storelens.llm.linededup import LineRuns, dedupe_lines, op1_line_dedup

from tests.llm.tools import documents, lower, table_rows

STRIP = " \t\n\x0b\x0c\r"


def brute(texts, min_docs, min_chars=1):
    """{row number: (lines, dropped, kept text)} of (id, text) rows."""
    holders = defaultdict(set)
    for i, text in texts:
        for line in (text or "").split("\n"):
            holders[lower(line).strip(STRIP)].add((i, text))
    out = []
    for i, text in texts:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(k := lower(x).strip(STRIP)) < min_chars or len(holders[k]) < min_docs]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def rows(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect()), key=repr)


@pytest.mark.parametrize("batches", [1, 5])
def test_odd_texts(spark, batches):
    texts = [
        (1, "Same line\nown 1\n\n"), (2, " same LINE\t\nown 2"), (3, "x\nSAME line\nx\nx"), (4, None), (5, ""),
        (6, "\n\n"), (7, "É same line\né same line"), (8, "É same line"), (None, "same line"), (9, "x\r\nx"),
        (9, "x\r\nx"), (10, "long " * 20000 + "\nsame line"), (11, "É SAME line\ny"),
    ]
    got = dedupe_lines(documents(spark, texts), min_docs=3, batches=batches)
    assert rows(got) == sorted(brute(texts, 3), key=repr)


def test_columns_stay_and_clashes_are_replaced(spark):
    docs = documents(spark, [(1, "a\nb"), (2, "a")]).withColumn("n_lines", F.lit("old")).withColumn("extra", F.lit(7))
    got = dedupe_lines(docs, min_docs=2)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra", "n_lines", "n_dropped"]
    assert [(r.doc_id, r.text, r.n_lines, r.extra) for r in got.orderBy("doc_id").collect()] == [(1, "b", 2, 7), (2, "", 1, 7)]


def test_empty_table(spark):
    assert dedupe_lines(documents(spark, []), min_docs=2).collect() == []


def test_first_keeps_the_line(spark):
    texts = [(i, f"common\nown {i}") for i in (5, 3, 9, 7)]
    got = {r.doc_id: r.text for r in dedupe_lines(documents(spark, texts), min_docs=2, keep="first").collect()}
    assert got == {3: "common\nown 3", 5: "own 5", 7: "own 7", 9: "own 9"}


def test_runs_count_over_batches_and_levels(spark):
    runs = LineRuns(spark, min_docs=3)
    want, first = Counter(), {}
    for number in range(5):
        batch = [(h, -h, 1, 10 * number + h) for h in range(8) if (h + number) % 3]
        want.update(h for h, *_ in batch)
        for h, _, _, doc in batch:
            first.setdefault(h, doc)
        runs.add(spark.createDataFrame(batch, "_h1 long, _h2 long, n long, first long"))
    assert len(runs.levels[0]) < 2 and len(runs.levels) > 2
    got = {r["_h1"]: r["first"] for r in runs.common().collect()}
    assert got == {h: first[h] for h, n in want.items() if n >= 3}


def test_merge_moves_no_run(spark):
    runs = LineRuns(spark, min_docs=3)
    for number in range(2):
        runs._put(number + 5, spark.createDataFrame([(number, 1, 1, 1)], "_h1 long, _h2 long, n long, first long"))
    plan = runs._merged(runs._runs())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_query_on_table(spark, sf_dir):
    texts = table_rows(sf_dir, "documents", "doc_id, text")
    want = sorted((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(texts, 10))
    got = sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in op1_line_dedup(spark, sf_dir).collect())
    assert got == want
