"""Filter interaction audit: what each filter removes, in every order of the filters.

A document's outcome is a mask with one bit per filter that it fails.  Documents are
counted per part and mask, at most ``2^n`` cells a part.  Each cell is then folded across
the array of all orders by SQL's higher-order functions: ``transform`` walks the orders,
``aggregate`` the steps of one, and a cell becomes one struct for every order and step,
weighted by its counts.  A part's cells are merged by elementwise sums.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.llm.text import content_key, whole, words

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
MOST_FILTERS = 6  # all orders of more would be more than 720


def text_filters(text: Column) -> Column:
    """Whether the text fails the filters A to D, as an array.

    A: under 100 words; B: fewer than 80 different words in 100; C: more than 10 of 100
    code points are A-Z; D: holds one of ``#$%&*|``.
    """
    capitals = (F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))).cast("long")
    # the words as the one element of an array, so that they are split once
    return F.transform(F.array(words(text)), lambda w: F.array(
        F.size(w) < 100,
        100 * F.size(F.array_distinct(w)).cast("long") < 80 * F.size(w).cast("long"),
        100 * capitals > 10 * F.char_length(text).cast("long"),
        text.rlike(r"[#$%&*|]"),
    ))[0]


def _labelled(labels: DataFrame) -> DataFrame:
    """One row per labelled document: a mark counts if any of its rows gives it."""
    def any_one(c: str) -> Column:
        return F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(f"_{c}")

    return labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(
        any_one("quality"), any_one("toxic")
    )


def mask_cells(
    docs: DataFrame, labels: DataFrame, filters: Callable[[Column], Column], n_filters: int, part: str = "lang",
    identical: bool = True,
) -> DataFrame:
    """(``part``, ``mask``, ``docs``, ``good``, ``toxic``): documents per part and outcome.

    ``filters`` makes an array of ``n_filters`` booleans of a text, and bit i of the mask is set
    if the i-th is true.  ``identical`` adds a filter, last in the mask: a text that a
    smaller ``doc_id`` has too.  Only the smallest id of a text passes it, so rows of one text,
    part and outcome are counted before they meet and no group of copies is gathered.
    A null id is not smaller than any and has no smaller one; a null filter does not fail.
    """
    text = F.col("_text")
    bits = F.transform(filters(text), lambda fails, i: F.when(fails, F.call_function("shiftleft", F.lit(1), i)).otherwise(0))
    slim = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole("text").alias("_text"))
    keys = ["_h1", "_h2"] if identical else []
    slim = slim.select(
        "doc_id", "part", F.aggregate(bits, F.lit(0), lambda a, b: a + b).alias("mask"),
        *(c.alias(k) for k, c in zip(keys, content_key(text))),
    )
    known = slim.join(_labelled(labels), F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", "part", "mask", *keys, F.coalesce("_quality", F.lit(0)).alias("good"),
        F.coalesce("_toxic", F.lit(0)).alias("toxic"),
    )
    if identical:
        own = ["part", "mask", "good", "toxic"]
        per_id = known.groupBy(*keys, *own, "doc_id").agg(F.count("*").alias("n"))
        least = F.min("doc_id")
        per_text = per_id.groupBy(*keys, *own).agg(
            F.sum("n").alias("n"), least.alias("least"), F.min_by("n", "doc_id").alias("at_least"),
            F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("without"),
        )
        # a row per part and outcome that one text has: few, whatever the number of copies
        per_text = per_text.withColumn("first", F.min("least").over(Window.partitionBy(*keys)))
        passing = F.col("without") + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
        bit = 1 << n_filters
        sides = F.array(
            F.struct(F.col("mask"), passing.alias("n")),
            F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - passing).alias("n")),
        )
        known = per_text.select("part", "good", "toxic", F.explode(sides).alias("s")).select(
            "part", "good", "toxic", "s.mask", "s.n").filter("n > 0")
    else:
        known = known.withColumn("n", F.lit(1))
    return known.groupBy("part", "mask").agg(
        F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )


def fold_cells(cells: DataFrame, letters: str) -> DataFrame:
    """(``part``, ``filter_order``, ``step``, counts, ``shapley``) for all orders and steps.

    ``cells`` as from :func:`mask_cells`, bit i for ``letters[i]``.
    """
    if not 0 < len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"one to {MOST_FILTERS} different filters")
    orders = ["".join(p) for p in permutations(letters)]
    # Closed by the number of filters: n! orders of n bits.
    order_array = F.lit([[1 << letters.index(c) for c in order] for order in orders])
    struct = "struct<" + ",".join(f"{c}: bigint" for c in COUNTS) + ">"

    def step(state: Column, bit: Column) -> Column:
        """A cell at one step: still there or not, and what this filter does to it."""
        fails = F.col("mask").bitwiseAND(bit) != 0
        here = state["alive"] & fails
        alive = state["alive"] & ~fails

        def weight(condition: Column, count: str = "docs") -> Column:
            return F.when(condition, F.col(count)).otherwise(F.lit(0).cast("bigint"))

        row = F.struct(
            weight(alive).alias("kept"), weight(here).alias("removed"), weight(~state["alive"] & fails).alias("redundant"),
            weight(F.col("mask") == bit).alias("unique_fails"), weight(here, "good").alias("good_lost"),
            weight(here, "toxic").alias("toxic_lost"),
        )
        return F.struct(alive.alias("alive"), F.concat(state["out"], F.array(row)).alias("out"))

    start = F.struct(F.lit(True).alias("alive"), F.array().cast(f"array<{struct}>").alias("out"))
    folded = cells.select("part", F.flatten(F.transform(
        order_array, lambda order: F.aggregate(order, start, step, lambda state: state["out"])
    )).alias("rows"))

    def added(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.struct(*((x[c] + y[c]).alias(c) for c in COUNTS)))

    # at most 2^n cells a part
    gathered = folded.groupBy("part").agg(F.collect_list("rows").alias("cells"))
    merged = gathered.select("part", F.aggregate(
        F.slice("cells", 2, F.size("cells")), F.col("cells")[0], added).alias("rows"))

    n = len(letters)
    at = F.col("at")
    names = F.lit(orders)
    shown = merged.select("part", F.posexplode("rows").alias("at", "r")).select(
        "part", F.element_at(names, (F.floor(at / n) + 1).cast("int")).alias("filter_order"),
        (at % n + 1).cast("int").alias("step"), "r.*",
    )
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    # every part has n * n! rows, spread by part and letter
    total = F.sum("removed").over(Window.partitionBy("part", letter))
    return shown.withColumn("shapley", total)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters A to E in all 120 orders, per language of ``docs``.

    Columns: ``part`` (the language, empty if null), ``filter_order``, ``step`` (1 to 5; the
    step's filter is that letter of the order), and numbers of documents of the part:
    ``kept`` after the step, ``removed`` by it, ``redundant`` (fail its filter, but were
    removed before), ``unique_fails`` (fail its filter alone), ``good_lost`` and
    ``toxic_lost`` (removed by it, labelled quality 1 or toxic 1), and ``shapley``: what
    the filter removes, summed over all orders, whichever step it has there.

    A null text is empty, and an empty text fails A, and E if a smaller id is empty too.
    Repeated rows are documents each; of one id that is repeated all rows count as the
    smallest.  Labels of unknown documents and null labels change nothing; a document
    with several label rows has a mark if one of them gives it.  A null id is never
    labelled and never fails E.  An empty table gives an empty table; other columns are
    not looked at.
    """
    return fold_cells(mask_cells(docs, labels, text_filters, n_filters=4), "ABCDE")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return audit(docs, labels)


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
firsts AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
w AS (SELECT d.doc_id, part, d.t, regexp_extract_all(d.t, '[^\x20\x09-\x0D]+') AS ws, least FROM d JOIN firsts USING (t)),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(l.toxic, 0) AS toxic, map {
        'A': len(ws) < 100, 'B': 100 * len(list_distinct(ws)) < 80 * len(ws),
        'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
        'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(w.doc_id > least, false)} AS f
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
k AS (SELECT part, f['A'] AS a, f['B'] AS b, f['C'] AS c, f['D'] AS d, f['E'] AS e, count(*) AS n,
        sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT p.x || q.x || r.x || s.x || t.x AS o FROM letters p JOIN letters q ON q.x <> p.x
    JOIN letters r ON r.x NOT IN (p.x, q.x) JOIN letters s ON s.x NOT IN (p.x, q.x, r.x)
    JOIN letters t ON t.x NOT IN (p.x, q.x, r.x, s.x)),
steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
cells AS (SELECT *, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END)
        || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS failed
    FROM k),
walked AS (SELECT part, o, step, n, good, toxic, failed, contains(failed, o[step]) AS fails,
        len(list_filter(range(1, step), lambda i: contains(failed, o[i]))) > 0 AS gone
    FROM cells CROSS JOIN steps),
counted AS (SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step,
        CAST(sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS BIGINT) AS kept,
        CAST(sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS BIGINT) AS removed,
        CAST(sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS BIGINT) AS redundant,
        CAST(sum(CASE WHEN failed = o[step] THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
        CAST(sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS BIGINT) AS good_lost,
        CAST(sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
    FROM walked GROUP BY ALL)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley FROM counted
"""
