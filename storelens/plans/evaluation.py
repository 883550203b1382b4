"""Accuracy and latency over tables of answered questions.

A result row has: id, question, difficulty, model, success, latency, and where
needed sql, error, tables_found, first_sql.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.scalars import ellipsis, ratio_or_zero
from storelens.functions.sqltext import has_sql

LATENCY = "decimal(12,3)"
FOUND_NOTHING = "not run"


def select_records(records: DataFrame, difficulty: str | None, limit: int | None) -> DataFrame:
    """Records of one difficulty, first ``limit`` by id."""
    chosen = records if difficulty is None else records.filter(F.col("difficulty") == difficulty)
    return chosen if limit is None else chosen.orderBy("id").limit(limit)


def metrics(results: DataFrame) -> DataFrame:
    """Totals and rates: ``level`` 'overall' (labelled 'all'), and 'difficulty' for every
    label that occurs, also an unknown or missing one.

    Results are summed per difficulty once; the rollup adds up those few rows.
    A row of zeros is added in, so that the overall row is there without results.
    """
    sums = ("total", "successful", "latency_sum")
    per_difficulty = results.groupBy("difficulty").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("success")).alias("successful"),
        F.sum(F.col("latency").cast(LATENCY)).alias("latency_sum"),
    )
    rolled = (
        per_difficulty.rollup("difficulty")
        .agg(F.grouping_id().alias("level"), *[F.sum(c).alias(c) for c in sums])
        .withColumn("difficulty", F.when(F.col("level") == 1, "all").otherwise(F.col("difficulty")))
        .withColumn("level", F.when(F.col("level") == 1, "overall").otherwise("difficulty"))
    )
    nothing = results.sparkSession.range(1).select(
        F.lit("all").alias("difficulty"), F.lit("overall").alias("level"), *[F.lit(0).alias(c) for c in sums]
    )
    total, successful = F.col("total"), F.col("successful")
    return (
        rolled.unionByName(nothing)
        .groupBy("level", "difficulty")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select(
            "level",
            "difficulty",
            "total",
            "successful",
            (total - successful).alias("failed"),
            (ratio_or_zero(successful, total) * 100).alias("accuracy"),
            ratio_or_zero(F.col("latency_sum"), total).alias("average_latency"),
        )
    )


def failed_queries(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("success")).select(
        "id", "question", "difficulty", "error", F.col("sql").alias("generated_sql"),
        ellipsis(F.col("sql"), 200).alias("short_sql"),
    )


def outcome(tables_found: Column, sql: Column, error: Column, success: Column) -> Column:
    """Which step ended the question."""
    return (
        F.when(~tables_found, "no tables")
        .when(~has_sql(sql), "empty sql")
        .when(success, "success")
        .when(error.startswith("Unexpected error:"), "unexpected")
        .otherwise("error")
    )


def outcome_counts(results: DataFrame) -> DataFrame:
    kind = outcome(F.col("tables_found"), F.col("sql"), F.col("error"), F.col("success"))
    return results.groupBy(kind.alias("outcome")).agg(F.count("*").alias("questions"))


def retried(results: DataFrame, first: str = "first_sql", final: str = "sql") -> DataFrame:
    return results.withColumn("retried", ~F.col(first).eqNullSafe(F.col(final)))


def model_summary(results: DataFrame) -> DataFrame:
    """Per model: passed, qualified, latency; ``level`` 'overall' (labelled 'all'), and
    'difficulty' for every label that occurs, also 'all', an unknown or a missing one."""
    sums = results.groupBy("model", "difficulty").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("success")).alias("passed"),
        F.count_if(F.col("uses_qualified_names")).alias("qualified"),
        F.sum(F.col("latency").cast(LATENCY)).alias("latency_sum"),
    )
    # The rollup runs over one row per model and difficulty.
    return (
        sums.rollup("model", "difficulty")
        .agg(
            F.grouping_id().alias("level"),
            *[F.sum(c).alias(c) for c in ("total", "passed", "qualified", "latency_sum")],
        )
        .filter(F.col("level") < 3)
        .select(
            "model",
            F.when(F.col("level") == 1, "overall").otherwise("difficulty").alias("level"),
            F.when(F.col("level") == 1, "all").otherwise(F.col("difficulty")).alias("difficulty"),
            "total",
            "passed",
            "qualified",
            F.round(ratio_or_zero(F.col("latency_sum"), F.greatest(F.col("total"), F.lit(1))), 1).alias("avg_latency"),
        )
    )


def side_by_side(results: DataFrame, models: Sequence[str]) -> DataFrame:
    """PASS or FAIL of each model per question, from its first row; a model
    without a row reads FAIL."""
    firsts = [
        F.min(F.when(F.col("model") == model, F.struct("id", "success"))).alias(f"_{model}") for model in models
    ]
    short = F.when(F.length("question") > 55, F.concat(F.substring("question", 1, 52), F.lit("..."))).otherwise(
        F.col("question")
    )
    return (
        results.groupBy("question")
        .agg(*firsts)
        .select(
            "question",
            short.alias("short_question"),
            *[
                F.when(F.coalesce(F.col(f"_{model}.success"), F.lit(False)), "PASS").otherwise("FAIL").alias(model)
                for model in models
            ],
        )
    )


def model_grid(questions: DataFrame, results: DataFrame, models: Sequence[str]) -> DataFrame:
    """A row for every question and model; defaults where nothing was run.

    What was run comes from an inner join, which Spark can split when one
    question has very many results; what was not, from the keys alone.
    """
    grid = questions.select("question", "difficulty", F.explode(F.array(*map(F.lit, models))).alias("model"))
    keys = ["question", "model"]
    columns = [*keys, "difficulty", "success", "sql", "latency", "error"]
    ran = results.select(*keys, "success", "sql", "latency", "error").join(grid, keys)
    missing = (
        grid.join(results.select(*keys).distinct(), keys, "left_anti")
        .withColumn("success", F.lit(False))
        .withColumn("sql", F.lit(""))
        .withColumn("latency", F.lit(0.0))
        .withColumn("error", F.lit(FOUND_NOTHING))
    )
    return ran.select(*columns).unionByName(missing.select(*columns))
