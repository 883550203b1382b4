"""Choosing a tier per question, and adding the partners of linked tables.

Linked tables are rows (question_id, table_name, relevance_score).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.retrieval import DEFAULT_LIMIT, checked_limit
from storelens.session import durable

DESCRIBED_SCORE = 0.4
CATALOG_SCORE = 0.3
LAST_RESORT_SCORE = 0.1


def first_tables(questions: DataFrame, catalog: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The last resort: the first ``limit`` tables of the catalog by name, for
    every question given.  Only those names come to the driver."""
    listed = catalog.select("table_name").distinct().orderBy("table_name").limit(checked_limit(limit)).collect()
    names = F.array(*[F.lit(row.table_name) for row in listed]).cast("array<string>")
    return questions.select("question_id", F.explode(names).alias("table_name")).withColumn(
        "relevance_score", F.lit(LAST_RESORT_SCORE)
    )


def by_tier(questions: DataFrame, tiers: Sequence[DataFrame | Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """The tables of the first tier that has any for the question.  A blank
    question gets none.

    A tier is a table of what it found, or a function that is given the questions for which
    no earlier tier found anything; what it finds is written before the next one is asked.
    """
    left = questions.filter(F.regexp_like("text", F.lit(r"(?U)\S")))
    found = []
    for n, tier in enumerate(tiers, 1):
        rows = tier(left) if callable(tier) else tier
        rows = rows.select("question_id", "table_name", "relevance_score").withColumn("tier", F.lit(n))
        found.append(durable(rows.join(left.select("question_id"), "question_id", "left_semi")))
        left = left.join(found[-1].select("question_id"), "question_id", "left_anti")
    return reduce(DataFrame.unionByName, found)


def supplement(linked: DataFrame, edges: DataFrame, descriptions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add the one-hop partners (edges: table_name, partner) not linked yet.

    Partners with descriptions score 0.4.  Only for a question none of whose
    partners is described do partners known to the catalog come in, at 0.3.
    Returns the linked rows and the added ones, with ``listed_columns``.
    """
    # A question links at most ``limit`` tables, so these lists stay short.
    tables = F.collect_set(F.struct("table_name", "relevance_score", "listed_columns"))
    grouped = (
        linked.join(edges, "table_name", "left")
        .groupBy("question_id")
        .agg(tables.alias("tables"), F.collect_set("partner").alias("partners"))
    )
    kept = F.transform(
        "tables", lambda t: F.struct(t["table_name"], t["relevance_score"], t["listed_columns"], F.lit(False).alias("added"))
    )
    needed = F.transform(
        F.array_except("partners", F.col("tables.table_name")),
        lambda name: F.struct(
            name.alias("table_name"),
            F.lit(None).cast("double").alias("relevance_score"),
            F.lit(None).cast("long").alias("listed_columns"),
            F.lit(True).alias("added"),
        ),
    )
    described = descriptions.groupBy("table_name").agg(F.count("*").alias("described_columns"))
    known = catalog.groupBy("table_name").agg(F.count("*").alias("catalog_columns"))
    rows = (
        grouped.select("question_id", F.explode(F.concat(kept, needed)).alias("t"))
        .select("question_id", "t.*")
        .join(described, "table_name", "left")
        .join(known, "table_name", "left")
    )
    is_described = F.col("added") & F.col("described_columns").isNotNull()
    any_described = F.max(is_described).over(Window.partitionBy("question_id"))
    return (
        rows.withColumn("_any", any_described)
        .filter(~F.col("added") | is_described | (~F.col("_any") & F.col("catalog_columns").isNotNull()))
        .select(
            "question_id",
            "table_name",
            F.coalesce("relevance_score", F.when(F.col("_any"), DESCRIBED_SCORE).otherwise(CATALOG_SCORE)).alias(
                "relevance_score"
            ),
            F.coalesce("listed_columns", "described_columns", "catalog_columns").alias("listed_columns"),
            "added",
        )
    )


def description_coverage(expected: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Described against expected columns per table and in total.

    expected and descriptions: table_name, column_name.
    """
    wanted = expected.groupBy("table_name").agg(F.count("*").alias("expected_columns"))
    found = descriptions.groupBy("table_name").agg(F.count("*").alias("described_columns"))
    per_table = wanted.join(found, "table_name", "left").withColumn(
        "described_columns", F.coalesce("described_columns", F.lit(0))
    )
    total = per_table.agg(
        F.lit("TOTAL").alias("table_name"),
        F.sum("expected_columns").alias("expected_columns"),
        F.sum("described_columns").alias("described_columns"),
    )
    return per_table.unionByName(total).withColumn(
        "complete", F.col("described_columns") >= F.col("expected_columns")
    )
