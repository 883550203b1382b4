import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from storelens.functions.keywords import EDGE_CHARACTERS, STOPWORDS, with_keywords
from storelens.retrieval import checked_limit, keyword, linking, semantic

QUESTIONS = [
    (1, "Show the total Price per 'seller', please?"),
    (2, "what is that"),
    (3, "a of"),
    (4, "  "),
    (5, "? ok"),
    (6, "50% off_price"),
    (7, "nothing-like-it"),
    (8, "Show the total Price per 'seller', please?"),
    (9, "one two2 three four five sixx seven eight nine tenth eleven twelve thirteen fourteen"),
]
DESCRIPTIONS = [
    ("ITEMS", "price", "DECIMAL", "The price paid\nto the seller", "cost"),
    ("ITEMS", "freight", "DECIMAL", "Freight, 50% OFF on request", None),
    ("ITEMS", "seller_id", "VARCHAR", "who sold it", "vendor"),
    ("SELLERS", "city", "VARCHAR", "city of the SELLERS", ""),
    ("PEOPLE", "name", "VARCHAR", "that name", "offer"),
    ("OTHER", "off_price_x", "INT", "", "fourteen eleven tenth"),
    ("OTHER", "pleaser", "INT", "x", "y"),
]


def reference_keywords(text):
    words = [w.strip(EDGE_CHARACTERS) for w in text.lower().split()]
    long_words = [w for w in words if len(w) > 3]
    return ([w for w in long_words if w not in STOPWORDS] or long_words or words)[:10]


def reference_matches(questions, descriptions):
    found = set()
    for q, text in questions:
        for table, column, _, description, synonyms in descriptions:
            fields = [description.lower(), column.lower(), (synonyms or "").lower()]
            if any(w in f for w in reference_keywords(text) for f in fields):
                found.add((q, table, column))
    return found


@pytest.fixture(scope="module")
def questions(spark):
    return spark.createDataFrame(QUESTIONS, "question_id long, text string")


@pytest.fixture(scope="module")
def descriptions(spark):
    return spark.createDataFrame(
        DESCRIPTIONS, "table_name string, column_name string, data_type string, description string, synonyms string"
    ).repartition(3)


def test_keywords(questions):
    rows = with_keywords(questions, "text", "k").collect()
    assert {r.question_id: r.k for r in rows} == {q: reference_keywords(t) for q, t in QUESTIONS}


def test_counts_are_those_of_brute_force(questions, descriptions):
    asked = keyword.with_signatures(questions)
    words = keyword.described_words(asked, descriptions)
    counts = keyword.match_counts(words, asked, descriptions).join(asked, "signature")
    got = {(r.question_id, r.table_name): r.match_count for r in counts.collect()}
    want = {}
    for q, name, _ in reference_matches(QUESTIONS, DESCRIPTIONS):
        want[q, name] = want.get((q, name), 0) + 1
    assert got == want


def test_rows_are_those_of_brute_force(questions, descriptions):
    rows = keyword.keyword_rows(questions, descriptions, limit=10).collect()
    got = [(r.question_id, r.table_name, r.column_name) for r in rows]
    assert len(got) == len(set(got))
    assert set(got) == reference_matches(QUESTIONS, DESCRIPTIONS)


def test_a_word_that_all_descriptions_share_is_counted_before_it_is_listed(spark):
    """Questions meet a table's bitmaps, not its descriptions, however different these are."""
    many = spark.range(3000).selectExpr(
        "concat('T', id % 3) AS table_name", "lpad(id, 6, '0') AS column_name", "'INT' AS data_type",
        "concat('shared own', id) AS description", "'' AS synonyms",
    )
    asked = spark.createDataFrame([(i, f"shared own{i}") for i in range(50)], "question_id long, text string")
    signatures = keyword.with_signatures(asked)
    words = keyword.described_words(signatures, many)
    assert words.count() >= 3000 + 50
    met = keyword.unions(keyword.postings(words), signatures)
    assert met.count() == 3 * 50  # a row per question, table and 32,768 descriptions
    assert {r.n for r in met.selectExpr("bitmap_count(bits) AS n").collect()} == {1000}
    rows = keyword.keyword_rows(asked, many, limit=2, rows_per_table=5).collect()
    assert len(rows) == 50 * 10 and {r.table_name for r in rows} == {"T0"}
    assert {r.column_name for r in rows} == {f"{i:06}" for i in range(0, 30, 3)}


def test_words_of_descriptions_are_not_written(spark, monkeypatch):
    """What is written grows with the keywords and tables, not with descriptions times keywords."""
    many = spark.range(400).selectExpr(
        "concat('T', id % 2) AS table_name", "lpad(id, 6, '0') AS column_name", "'INT' AS data_type",
        "concat_ws(' ', transform(sequence(0, 9), i -> concat('sharedword', i))) AS description", "'' AS synonyms",
    )
    asked = spark.createDataFrame([(1, " ".join(f"sharedword{i}" for i in range(10)))], "question_id long, text string")
    written, durable = [], keyword.durable

    def counted(df):
        written.append(durable(df))
        return written[-1]

    monkeypatch.setattr(keyword, "durable", counted)
    rows = keyword.keyword_rows(asked, many, limit=1, rows_per_table=9).collect()
    assert sorted(r.column_name for r in rows) == [f"{i:06}" for i in range(0, 18, 2)]
    assert max(df.count() for df in written) <= 10 * 2


def test_first_numbers_of_bitmaps(spark):
    """Over bucket and byte borders; groups with fewer numbers give all."""
    numbers = {"a": [1, 8, 9, 32767, 32768, 32769, 98304, 98305], "b": list(range(40000, 40100)), "c": [65536]}
    flat = spark.createDataFrame([(g, n) for g, of in numbers.items() for n in of], "g string, number long")
    bitmaps = flat.groupBy("g", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )
    for n in (1, 3, 6, 200):
        got = {g: [] for g in numbers}
        for r in keyword.first_numbers(bitmaps, ["g"], n).collect():
            got[r.g].append(r.number)
        for g, of in numbers.items():
            assert sorted(got[g])[:n] == of[:n] and set(got[g]) <= set(of) and len(got[g]) == len(set(got[g]))


def test_long_tokens_and_short_keywords(spark):
    """A keyword across the border of two stretches of a token, at its end, and one of a letter."""
    edge = keyword.STRETCH
    texts = {"border": "x" * (edge - 3) + "needle" + "y" * edge, "end": "z" * (2 * edge - 2) + "needle", "none": "needl e"}
    described = spark.createDataFrame(
        [("T", name, "INT", text, "") for name, text in texts.items()],
        "table_name string, column_name string, data_type string, description string, synonyms string",
    )
    asked = spark.createDataFrame([(1, "needle"), (2, "zz"), (3, "l")], "question_id long, text string")
    got = {(r.question_id, r.column_name) for r in keyword.keyword_rows(asked, described).collect()}
    assert got == {(1, "border"), (1, "end"), (2, "end"), (3, "border"), (3, "end"), (3, "none")}


def test_tables_and_rows_are_ranked_and_cut(questions, descriptions):
    tables = keyword.keyword_tables(questions, descriptions, limit=2, excluded=("SELLERS",))
    ranked = {}
    for r in tables.orderBy("question_id", "table_rank").collect():
        ranked.setdefault(r.question_id, []).append((r.table_name, r.match_count))
    assert ranked[1] == ranked[8] == [("ITEMS", 2), ("OTHER", 2)]
    assert ranked[2] == [("PEOPLE", 1)]
    assert ranked[5] == [("ITEMS", 3), ("OTHER", 2)]
    assert 4 not in ranked and 7 not in ranked
    rows = keyword.keyword_rows(questions, descriptions, limit=2).filter("question_id = 5").orderBy("column_rank")
    assert [(r.table_name, r.column_name) for r in rows.collect()][:3] == [
        ("ITEMS", "freight"), ("ITEMS", "price"), ("ITEMS", "seller_id"),
    ]


def test_row_budget(spark):
    many = spark.createDataFrame(
        [("A", f"c{i:03d}", "INT", "price", "") for i in range(20)] + [("B", f"c{i:03d}", "INT", "price", "") for i in range(9)],
        "table_name string, column_name string, data_type string, description string, synonyms string",
    )
    asked = spark.createDataFrame([(1, "price")], "question_id long, text string")
    rows = keyword.keyword_rows(asked, many, limit=1).collect()
    assert len(rows) == 15 and {r.table_name for r in rows} == {"A"}
    assert [(r.table_name, r.listed_columns) for r in keyword.keyword_tables(asked, many, limit=1).collect()] == [("A", 15)]


def test_limit_below_one_is_the_default():
    assert checked_limit(0) == checked_limit(-3) == 5
    assert checked_limit(2) == 2


def vectors_of(spark, cells, key, tables=None):
    rows = [(i, tables and f"t{i % tables}", v and [float(x) for x in v]) for i, v in enumerate(cells)]
    return spark.createDataFrame(rows, f"{key} long, table_name string, vector array<double>")


@pytest.mark.parametrize("block_rows,tile_bytes", [(4096, 1 << 25), (7, 200)])
def test_nearest_rows_equal_brute_force(spark, block_rows, tile_bytes):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 8))
    vectors[50:70] = vectors[10]  # ties
    vectors[80] = 0.0
    vectors[90:95] = vectors[10] + rng.normal(size=(5, 8)) * 1e-8  # equal but for the seventh digit
    asked = np.vstack([rng.normal(size=(30, 8)), vectors[10:11], np.zeros((1, 8))])
    rows = vectors_of(spark, [*vectors.tolist(), None], "row_id", 7)
    questions = vectors_of(spark, [*asked.tolist(), None], "question_id").drop("table_name")
    got = {}
    found = semantic.semantic_rows(questions, rows.repartition(5), limit=3, block_rows=block_rows, tile_bytes=tile_bytes)
    for r in found.orderBy("question_id", "row_rank").collect():
        assert r.score == pytest.approx(round(r.score, 6)) and r.table_name == f"t{r.row_id % 7}"
        got.setdefault(r.question_id, []).append(r.row_id)

    def unit(v):
        n = np.linalg.norm(v, axis=1, keepdims=True)
        return v / np.where(n == 0, 1.0, n)

    score = np.cumsum(unit(asked)[:, None, :] * unit(vectors)[None, :, :], axis=2)[:, :, -1]
    for i in range(len(asked)):
        assert got[i] == sorted(range(300), key=lambda d: (-score[i, d], d))[:30]
    assert set(got) == set(range(len(asked)))


def test_blocks_move_a_bounded_number_of_times(spark):
    """A block of descriptions is copied once per column of the grid, whatever the number of
    question blocks, and the grid has few columns while the questions fit in a tile."""
    rows = spark.range(4000).select(F.col("id").alias("row_id"), F.lit("t").alias("table_name"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vector"))
    asked = rows.limit(1000).withColumnRenamed("row_id", "question_id")
    for tile_bytes, columns in ((1 << 20, 1), (8000, 2)):
        tall, wide = semantic.tiles(asked, rows, tile_bytes)
        grid = spark.range(1).select(tall.alias("tall"), wide.alias("wide")).first()
        assert grid.wide == columns and grid.tall >= max(64000 // tile_bytes, 1)
        blocks = semantic._blocks(rows, "row_id", 100, 10).select("cell")
        assert semantic.dealt(blocks, "row", tall, "column", wide).count() == blocks.count() * columns <= 40 * columns


def test_groups_are_passed_over(spark, monkeypatch):
    """Rows far from a question are never multiplied with it."""
    rng = np.random.default_rng(0)
    centres = np.eye(12)
    cells = centres[np.arange(2400) % 12] + rng.normal(size=(2400, 12)) * 0.02
    blocks = semantic._blocks(vectors_of(spark, cells.tolist(), "row_id", 3), "row_id", 4096, 64).collect()
    radii = np.frombuffer(blocks[0].radii)
    near = np.frombuffer(blocks[0].centres).reshape(len(radii), 12) @ cells[0] / np.linalg.norm(cells[0])
    assert len(blocks) == 1 and (near + radii < 0.5).mean() > 0.8  # the best 20 all score above 0.99


def test_lists_are_sorted_a_few_times_a_tile(spark, monkeypatch):
    """Blocks are multiplied whole: the lists of the best are sorted as often as a list fills
    up with better rows, not once per group of rows."""
    cells = np.random.default_rng(5).normal(size=(6000, 16)).tolist()
    blocks = semantic._blocks(vectors_of(spark, cells, "row_id", 3), "row_id", 512, 64).toPandas()
    asked = semantic._blocks(vectors_of(spark, cells[:200], "question_id", 3), "question_id", 512, 64).toPandas()
    sorts, lexsort = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: sorts.append(1) or lexsort(keys))
    found = semantic._nearest(10)(asked, blocks)
    assert len(blocks) > 8 and len(found) == 200 * 10 and len(sorts) <= len(blocks)
    unit = np.array(cells) / np.linalg.norm(cells, axis=1, keepdims=True)
    of_first = found[found.question_id == 0].sort_values(["score", "row_id"], ascending=[False, True])
    assert of_first.row_id.tolist() == np.argsort(-(unit @ unit[0]), kind="stable")[:10].tolist()


def test_no_vector_is_broadcast_or_collected(spark):
    vectors = spark.createDataFrame([(1, "t", [1.0])], "row_id long, table_name string, vector array<double>")
    questions = vectors.select(F.col("row_id").alias("question_id"), "vector")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "")
    found = semantic.semantic_rows(questions, vectors)
    assert not jobs.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # only the two block counts, one number each, may be asked for beside the join of blocks
    assert "Broadcast" not in found._jdf.queryExecution().sparkPlan().toString()


def test_no_questions_gives_no_rows(spark):
    none = spark.createDataFrame([], "question_id long, vector array<double>")
    rows = spark.createDataFrame([(1, "t", [1.0])], "row_id long, table_name string, vector array<double>")
    assert semantic.semantic_rows(none, rows).count() == 0


def test_lowest_tier_wins(spark):
    asked = spark.createDataFrame([(1, "a"), (2, "b"), (3, " "), (4, "c")], "question_id long, text string")
    schema = "question_id long, table_name string, relevance_score double"
    near = spark.createDataFrame([(1, "N", 0.9), (3, "N", 0.9)], schema)
    words = spark.createDataFrame([(1, "K", 0.5), (2, "K", 0.5)], schema)
    catalog = spark.createDataFrame([("Z",), ("A",), ("B",), ("A",)], "table_name string")
    rest = linking.first_tables(asked, catalog, 2)
    got = {(r.question_id, r.table_name, r.tier) for r in linking.by_tier(asked, [near, words, rest]).collect()}
    assert got == {(1, "N", 1), (2, "K", 2), (4, "A", 3), (4, "B", 3)}


def test_a_tier_is_asked_only_for_what_is_left(spark):
    asked = spark.createDataFrame([(1, "a"), (2, "b"), (3, "\u00a0\u2003"), (4, "c")], "question_id long, text string")
    given = []

    def tier(known):
        def find(left):
            given.append(sorted(r.question_id for r in left.collect()))
            return left.filter(F.col("question_id").isin(*known)).select(
                "question_id", F.lit("T").alias("table_name"), F.lit(0.5).alias("relevance_score"))
        return find

    got = {(r.question_id, r.tier) for r in linking.by_tier(asked, [tier([1]), tier([1, 4]), tier([2, 3])]).collect()}
    assert got == {(1, 1), (4, 2), (2, 3)} and given == [[1, 2, 4], [2, 4], [2]]


def test_partners_one_hop_only(spark):
    linked = spark.createDataFrame(
        [(1, "ORDER_ITEMS", 0.9, 3), (2, "ORDERS", 0.8, 2), (2, "CUSTOMERS", 0.7, 1), (3, "LONER", 0.5, 1), (4, "LONER", 0.5, 1),
         (4, "ORDER_ITEMS", 0.4, 1)],
        "question_id long, table_name string, relevance_score double, listed_columns long",
    )
    edges = spark.createDataFrame(
        [("ORDER_ITEMS", "ORDERS"), ("ORDERS", "CUSTOMERS"), ("LONER", "UNDESCRIBED"), ("LONER", "UNKNOWN")],
        "table_name string, partner string",
    )
    described = spark.createDataFrame([("ORDERS", "a"), ("ORDERS", "b"), ("CUSTOMERS", "c")], "table_name string, column_name string")
    catalog = spark.createDataFrame([("ORDERS", "a"), ("UNDESCRIBED", "x")], "table_name string, column_name string")
    rows = linking.supplement(linked, edges, described, catalog).filter("added").collect()
    assert {(r.question_id, r.table_name, r.relevance_score, r.listed_columns) for r in rows} == {
        (1, "ORDERS", 0.4, 2), (3, "UNDESCRIBED", 0.3, 1), (4, "ORDERS", 0.4, 2),
    }


def test_hot_source(spark):
    """A third of all descriptions in one table, and one question asked by many."""
    rng = random.Random(1)
    words = ["alpha", "bravo", "charlie", "delta"]
    descriptions = [("HOT" if i % 3 == 0 else f"t{i % 50}", f"c{i}", "INT", rng.choice(words) * 2, "") for i in range(1500)]
    asked = [(i, "alpha" if i % 3 == 0 else rng.choice(words)) for i in range(60)]
    found = keyword.keyword_tables(
        spark.createDataFrame(asked, "question_id long, text string"),
        spark.createDataFrame(descriptions, "table_name string, column_name string, data_type string, description string, synonyms string"),
    )
    hot = {r.question_id: r.match_count for r in found.filter(F.col("table_name") == "HOT").collect()}
    for q, word in asked:
        assert hot[q] == sum(t == "HOT" and word in d for t, _, _, d, _ in descriptions)
