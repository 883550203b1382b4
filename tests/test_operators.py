import random
import statistics

import pytest
from pyspark.sql import functions as F

from storelens.operators.median import exact_median
from storelens.operators.ranking import (
    keep_first, number_rows, number_rows_per_group, rank_small, top_n_per_group, top_ranked,
)
from storelens.operators.sampling import exact_split, quotas, stratified_sample
from storelens.operators.trend import always_growing, growth, running_total
from storelens.plans import dataset


def hot_rows(n=3000):
    """A third of the rows share one key."""
    rng = random.Random(7)
    return [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(40)}", rng.randrange(50)) for i in range(n)]


@pytest.fixture(scope="module")
def hot(spark):
    return spark.createDataFrame(hot_rows(), "id long, k string, v long").repartition(6)


def test_top_n_is_decided_under_ties(hot):
    expected = {}
    for i, k, v in hot_rows():
        expected.setdefault(k, []).append((-v, i))
    expected = {k: [i for _, i in sorted(pairs)[:4]] for k, pairs in expected.items()}
    for parts in (1, 5):
        got = {}
        rows = top_n_per_group(hot.repartition(parts), ["k"], [F.desc("v"), F.col("id")], 4).orderBy("k", "row_num")
        for row in rows.collect():
            got.setdefault(row.k, []).append(row.id)
        assert got == expected


def test_group_limit_applies_before_the_shuffle(hot):
    plan = top_n_per_group(hot, ["k"], [F.desc("v"), F.col("id")], 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_ranks_share_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 3), ("d", 1)], "e string, v int")
    assert [r.rank for r in rank_small(df, "v").orderBy("e").collect()] == [1, 1, 3, 4]
    assert [(r.e, r.rank) for r in top_ranked(df, "v", "e", 3).collect()] == [("a", 1), ("b", 1), ("c", 3)]


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_numbers_are_consecutive_in_order(hot, parts):
    rows = number_rows(hot.repartition(parts), ["v", "id"], "n").select("v", "id", "n").collect()
    by_number = sorted(rows, key=lambda r: r.n)
    assert [r.n for r in by_number] == list(range(1, 3001))
    assert [(r.v, r.id) for r in by_number] == sorted((v, i) for i, _, v in hot_rows())


def test_numbers_restart_per_group(hot):
    rows = number_rows_per_group(hot, "k", ["id"], "n").collect()
    seen = {}
    for row in sorted(rows, key=lambda r: r.id):
        seen[row.k] = seen.get(row.k, 0) + 1
        assert row.n == seen[row.k]
    assert len(rows) == 3000


def test_numbering_of_nothing(spark):
    empty = spark.createDataFrame([], "id long")
    assert number_rows(empty, ["id"]).count() == 0


def test_keep_first_keeps_the_lowest_position(hot):
    rows = keep_first(hot, ["k", "v"], "id").collect()
    expected = {}
    for i, k, v in hot_rows():
        expected.setdefault((k, v), i)
    assert {(r.k, r.v): r.id for r in rows} == expected
    assert len(rows) == len(expected)


@pytest.mark.parametrize("values", [[1.0], [3.0, 1.0], [5.0] * 300 + [1.0, 9.0], list(range(1001)), [2.5, None, 7.0, 7.0]])
def test_median_is_exact(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(4)
    known = [float(v) for v in values if v is not None]
    assert exact_median(df, "v", "m").first().m == statistics.median(known)


def test_median_with_a_coarse_first_guess(hot):
    expected = statistics.median(v for _, _, v in hot_rows())
    assert exact_median(hot, "v", "m", bracket_rows=3).first().m == expected


@pytest.mark.parametrize("values", [
    [1.0] * 40 + [2.0] * 40, [0.1 * i for i in range(50)] + [1000 + 0.1 * i for i in range(50)], [5.0] * 99,
    [1e308, -1e308] * 30 + [0.5, 0.25, 5e-324, 0.0], [float(i % 7) for i in range(201)], [1.0, 1.0000000000000002] * 25,
])
def test_median_in_small_brackets(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    for rows in (1, 10):
        assert exact_median(df, "v", "m", bracket_rows=rows).first().m == statistics.median(values)


def test_split_in_small_buckets(spark):
    df = spark.range(700).withColumnRenamed("id", "key")
    whole = {r.key: r.split for r in exact_split(df, "key").collect()}
    assert whole == {r.key: r.split for r in exact_split(df, "key", digits=1, bucket_rows=2).collect()}
    assert sum(s == "train" for s in whole.values()) == 630


def test_median_of_nothing(spark):
    assert exact_median(spark.createDataFrame([], "v double"), "v", "m").first().m is None


@pytest.mark.parametrize("n", [0, 1, 7, 82, 1000])
def test_split_is_exact_complete_and_stable(spark, n):
    df = spark.range(n).withColumnRenamed("id", "key")
    first = {r.key: r.split for r in exact_split(df.repartition(3), "key").collect()}
    again = {r.key: r.split for r in exact_split(df.repartition(8), "key").collect()}
    assert first == again and len(first) == n
    assert sum(v == "train" for v in first.values()) == int(n * 0.9)


def test_split_depends_on_the_seed(spark):
    df = spark.range(500).withColumnRenamed("id", "key")
    assert exact_split(df, "key", seed=1).collect() != exact_split(df, "key", seed=2).collect()


def test_quotas_and_sample(spark):
    assert quotas(50) == {"easy": 20, "medium": 20, "hard": 10}
    assert quotas(7) == {"easy": 2, "medium": 2, "hard": 3}
    rows = [(i, "easy" if i % 3 else "hard") for i in range(300)]
    sample = stratified_sample(
        spark.createDataFrame(rows, "key long, d string"), "d", "key", {"easy": 7, "hard": 4}
    ).collect()
    assert sorted(r.id for r in sample if r.d == "easy") == list(range(1, 8))
    assert sorted(r.id for r in sample if r.d == "hard") == list(range(1, 5))
    assert all(r.batch == (r.id - 1) // 5 for r in sample)


def test_growth_handles_zero_and_null_periods(spark):
    df = spark.createDataFrame([("1", 4.0), ("2", 0.0), ("3", 3.0), (None, 9.0)], "m string, v double")
    rows = growth(df, "m", "v", "prev").orderBy(F.col("m").asc_nulls_last()).collect()
    assert [r.prev for r in rows] == [None, 4.0, 0.0, 3.0]
    assert [r.growth_rate for r in rows] == [None, -1.0, None, 2.0]


def test_running_total_restarts(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 3), ("b", 1, 5)], "g string, m int, v int")
    rows = running_total(df, "m", "v", ("g",)).orderBy("g", "m").collect()
    assert [r.running_total for r in rows] == [2, 5, 5]


def test_always_growing(spark):
    df = spark.createDataFrame(
        [("up", 1, 1), ("up", 2, 4), ("flat", 1, 2), ("flat", 2, 2), ("one", 1, 9), ("dip", 1, 1), ("dip", 2, 3), ("dip", 3, 2)],
        "e string, p int, v int",
    )
    assert [(r.e, r.periods) for r in always_growing(df, "e", "p", "v").collect()] == [("up", 2)]


def test_pairs_skip_turns_without_an_answer(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2"), (2, 0, "user", "q3"),
         (2, 1, "user", "q4"), (2, 2, "assistant", "a4")],
        "conv_id long, turn long, role string, text string",
    )
    rows = dataset.conversation_pairs(turns).orderBy("conv_id", "turn").collect()
    assert [(r.input, r.output) for r in rows] == [("q1", "a1"), ("q4", "a4")]


def test_stats_count_both_ways(spark):
    df = spark.createDataFrame([("golden", "easy")] * 3 + [("augmented", "augmented")] * 2, "source string, difficulty string")
    rows = {(r.kind, r.value): r.records for r in dataset.counts(df).collect()}
    assert rows == {("source", "golden"): 3, ("source", "augmented"): 2, ("difficulty", "easy"): 3, ("difficulty", "augmented"): 2}
