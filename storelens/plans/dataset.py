"""Building a set of instruction records from two sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.prompts import describe_prompt, generation_prompt, training_text
from storelens.functions.sqltext import qualify_sql
from storelens.operators.ranking import keep_first, number_rows_per_group
from storelens.plans.responses import PREFIX, WAREHOUSE_TABLES

INSTRUCTION = "Answer the question about the retail warehouse with one SQL query. Return only the query."


def unique_questions(golden: DataFrame) -> DataFrame:
    """The first row per (question, sql_query), by ``position``."""
    return keep_first(golden, ["question", "sql_query"], "position")


def conversation_pairs(turns: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn right after it.

    Joined on (conversation, turn), so a long conversation is not gathered in
    one task.
    """
    asked = turns.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("input"), (F.col("turn") + 1).alias("answer_turn")
    )
    answered = turns.filter(F.col("role") == "assistant").select(
        "conv_id", F.col("turn").alias("answer_turn"), F.col("text").alias("output")
    )
    return asked.join(answered, ["conv_id", "answer_turn"]).select("conv_id", "turn", "input", "output")


def build(golden: DataFrame, written: DataFrame, instruction: str = INSTRUCTION) -> DataFrame:
    """Instruction records from golden rows (question, sql_query, difficulty,
    position) and written pairs (input, output)."""
    from_golden = unique_questions(golden).select(
        F.lit(instruction).alias("instruction"),
        F.col("question").alias("input"),
        qualify_sql(F.col("sql_query"), WAREHOUSE_TABLES, PREFIX).alias("output"),
        "difficulty",
        F.lit("golden").alias("source"),
    )
    from_written = written.select(
        F.lit(instruction).alias("instruction"),
        "input",
        "output",
        F.lit("augmented").alias("difficulty"),
        F.lit("augmented").alias("source"),
    )
    return from_golden.unionByName(from_written)


def counts(dataset: DataFrame) -> DataFrame:
    """Records by source and by difficulty."""
    both = dataset.groupBy("source", "difficulty").agg(F.count("*").alias("n"))
    # The cube runs over one row per source and difficulty.
    by_source = F.col("level") == 1
    return (
        both.cube("source", "difficulty")
        .agg(F.grouping_id().alias("level"), F.sum("n").alias("records"))
        .filter(F.col("level").isin(1, 2))
        .select(
            F.when(by_source, "source").otherwise("difficulty").alias("kind"),
            F.when(by_source, F.col("source")).otherwise(F.col("difficulty")).alias("value"),
            "records",
        )
    )


def training_texts(dataset: DataFrame, end_mark: str = "</s>") -> DataFrame:
    return dataset.withColumn(
        "text", training_text(F.col("instruction"), F.col("input"), F.col("output"), end_mark)
    )


def describe_prompts(columns: DataFrame, page_columns: int = 50) -> DataFrame:
    """Prompts that ask for column descriptions, one per table and page of
    columns, so that a table with very many columns gives more prompts instead
    of a longer one.  columns: table_name, column_name, data_type."""
    numbered = number_rows_per_group(columns, "table_name", ["column_name"], "place")
    line = F.concat(F.lit("- "), "column_name", F.lit(" ("), "data_type", F.lit(")"))
    return (
        numbered.withColumn("page", F.floor((F.col("place") - 1) / page_columns))
        .groupBy("table_name", "page")
        .agg(F.sort_array(F.collect_list(F.struct("place", line.alias("line")))).alias("lines"))
        .select("table_name", "page", describe_prompt(F.col("table_name"), F.col("lines.line")).alias("prompt"))
    )


def generation_prompts(sample: DataFrame, schema: Column) -> DataFrame:
    """One prompt per difficulty and batch of a stratified sample."""
    batches = sample.groupBy("difficulty", "batch").agg(F.count("*").alias("wanted"))
    return batches.withColumn("prompt", generation_prompt(schema, F.col("difficulty"), F.col("wanted")))
