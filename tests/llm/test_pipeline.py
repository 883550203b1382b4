import re
from collections import Counter, defaultdict

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from storelens.llm import mixing, packing, quality
from storelens.llm.scratch import new_folder, stored

from tests.llm.test_linededup import STRIP
from tests.llm.test_quality import brute as statistics
from tests.llm.tools import documents, lower, similar_groups


def features(text):
    n, chars, symbols, dup, repeat, failed = statistics(text)
    found, size = re.findall(r"[^\x20\x09-\x0D]+", text or ""), max(1, len(text or ""))
    lines = [x for x in (text or "").split("\n") if x.strip(STRIP)]
    share = lambda c: len(re.findall(c, text or "")) / size
    return failed, {
        "words": float(n), "word_length": chars / max(n, 1), "symbol_share": symbols / size, "capital_share": share("[A-Z]"),
        "digit_share": share("[0-9]"), "mark_share": share("[.,;:!?]"), "vocabulary_share": len(set(found)) / max(n, 1),
        "dup_line_share": dup / max(len(lines), 1), "repeat_share": repeat / max(n, 1),
    }


def without_lines(texts):
    holders = defaultdict(set)
    for i, t in texts.items():
        for line in t.split("\n"):
            holders[lower(line).strip(STRIP)].add(i)

    def stays(i, line):
        own = holders[lower(line).strip(STRIP)]
        return not lower(line).strip(STRIP) or len(own) < 10 or min(own) == i

    return {i: "\n".join(x for x in t.split("\n") if stays(i, x)) for i, t in texts.items()}


def test_every_stage_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "mix_sources", "best_fit_packing"]
    rules = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    texts = {}
    for r in docs.collect():
        failed, f = features(r.text)
        hit = any(all((f[c.feature] > c.threshold) == c.above for c in rule) for rule in rules)
        if not failed and not hit:
            texts[r.doc_id] = r.text
    made, columns = docs, docs.columns
    for step, (name, stage) in enumerate(pipeline.STAGES[:-1]):
        made = stored(stage(spark, made, sf_dir), new_folder(spark, name))
        assert made.columns == columns
        got = {r.doc_id: r for r in made.collect()}
        if name == "line_dedup":
            texts = without_lines(texts)
            assert all(r.n_chars == len(r.text) for r in got.values())
        if name == "simhash_near_dedup":
            texts = {i: texts[i] for i in set(similar_groups(texts, 5, 0.8).values())}
        assert {i: r.text for i, r in got.items()} == texts, name
    many = Counter(r.doc_id for r in made.collect())
    mixed = mixing.mixed(stored(made.dropDuplicates(["doc_id"]), new_folder(spark, "again")))
    assert many == Counter(r.doc_id for r in mixed.collect())
    packed = Counter()
    for r in pipeline.run(spark, sf_dir).collect():
        packed[r.doc_id] += r.length
    assert packed == {i: n * (len(texts[i].encode()) + 1) for i, n in many.items()}


def test_stages_with_odd_rows(spark, sf_dir):
    body = " ".join(f"word{i}" for i in range(80))
    rows = [(1, None), (2, ""), (3, body), (4, body), (4, body), (None, body + " end"), (5, "line\n" + body.upper()), (6, "\n".join([body] * 2))]
    docs = documents(spark, rows, None)
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert stage(spark, docs.limit(0), sf_dir).collect() == [], name
        if name != "best_fit_packing":
            assert out.columns == docs.columns
            docs = stored(out, new_folder(spark, name))
    assert {r.doc_id for r in out.collect()} == {3}


def test_many_copies_leave_one_text(spark, sf_dir):
    body = "\n".join(" ".join(f"w{i}x{j}" for j in range(20)) for i in range(6))
    docs = documents(spark, [(i, body) for i in range(30, 60)] + [(99, " ".join(f"own{i}" for i in range(70)))])
    for name, stage in pipeline.STAGES[:3]:
        docs = stored(stage(spark, docs, sf_dir), new_folder(spark, name))
    assert {(r.doc_id, r.text) for r in docs.filter(F.col("text") != "").collect()} == {
        (30, body), (99, " ".join(f"own{i}" for i in range(70)))}
