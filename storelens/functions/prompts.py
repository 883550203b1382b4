"""Texts put in front of a model: schema listings, prompts, training texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.scalars import qualified_name

# Section marks of the training template.
INSTRUCTION_MARK = "### Instruction:\n"
INPUT_MARK = "\n\n### Input:\n"
OUTPUT_MARK = "\n\n### Response:\n"


def column_line(name: Column, data_type: Column, description: Column, synonyms: Column) -> Column:
    known = F.length(F.trim(F.coalesce(synonyms, F.lit("")))) > 0
    return F.concat(
        F.lit("  - "), name, F.lit(" ("), data_type, F.lit("): "), description,
        F.when(known, F.concat(F.lit(" [Synonyms: "), synonyms, F.lit("]"))).otherwise(F.lit("")),
    )


def schema_text(linked: DataFrame, key: str, prefix: str) -> DataFrame:
    """One schema listing per ``key`` from rows (key, table_rank, table_name,
    relevance_score, column_rank, column_name, data_type, description, synonyms).

    The rows are a retrieval result, which holds a fixed number of rows per
    key, so the lists built here are bounded.
    """
    line = column_line(F.col("column_name"), F.col("data_type"), F.col("description"), F.col("synonyms"))
    tables = (
        linked.groupBy(key, "table_rank", "table_name", "relevance_score")
        .agg(F.sort_array(F.collect_list(F.struct("column_rank", line.alias("line")))).alias("columns"))
        .withColumn(
            "block",
            F.concat(
                F.lit("\nTable: "), qualified_name(F.col("table_name"), prefix), F.lit(" (Relevance: "),
                F.format_string("%.2f", "relevance_score"), F.lit(")\n"),
                F.array_join(F.col("columns.line"), "\n"),
            ),
        )
    )
    return tables.groupBy(key).agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("table_rank", "block"))), lambda t: t["block"]), "\n"
        ).alias("schema_text")
    )


def short_schema_text(linked: DataFrame, key: str, prefix: str) -> DataFrame:
    """Schema listing with one line per table, columns separated by commas."""
    item = F.concat(F.col("column_name"), F.lit(" ("), F.col("data_type"), F.lit(")"))
    tables = (
        linked.groupBy(key, "table_rank", "table_name")
        .agg(F.sort_array(F.collect_list(F.struct("column_rank", item.alias("item")))).alias("columns"))
        .withColumn(
            "line",
            F.concat(
                F.lit("- "), qualified_name(F.col("table_name"), prefix), F.lit(": "),
                F.array_join(F.col("columns.item"), ", "),
            ),
        )
    )
    lines = F.transform(F.sort_array(F.collect_list(F.struct("table_rank", "line"))), lambda t: t["line"])
    return tables.groupBy(key).agg(
        F.concat(F.lit("Available tables:\n"), F.array_join(lines, "\n")).alias("schema_text")
    )


def question_prompt(rules: Sequence[str], schema: Column, examples: Sequence[tuple[str, str]], question: Column) -> Column:
    """Rules, schema listing, worked examples and the question, in this order."""
    numbered = "\n".join(f"{i}. {rule}" for i, rule in enumerate(rules, 1))
    worked = "".join(f"Question: {q}\nSQL:\n{sql}\n\n" for q, sql in examples)
    return F.concat(
        F.lit(f"Write one SQL query that answers the question.\n\nRULES:\n{numbered}\n\nSCHEMA:\n"),
        F.coalesce(schema, F.lit("")),
        F.lit(f"\n\nEXAMPLES:\n{worked}QUESTION:\n"),
        question,
    )


def describe_prompt(table: Column, columns: Column) -> Column:
    """Ask for descriptions of a table's columns (an array of ready lines)."""
    return F.concat(
        F.lit("Describe each column of this table for business users.\n\nTable: "), table,
        F.lit("\nColumns:\n"), F.array_join(columns, "\n"),
        F.lit("\n\nAnswer with a JSON array of objects: column_name, description, synonyms, sample_values."),
    )


GUIDANCE = {
    "easy": "answerable from a single table",
    "medium": "needs tables to be combined and grouped",
    "hard": "needs several steps, such as a ranking inside groups",
}


def generation_prompt(
    schema: Column, difficulty: Column, count: Column, guidance: Mapping[str, str] = GUIDANCE
) -> Column:
    """Ask for ``count`` questions of a difficulty, with their SQL, as JSON."""
    rules = F.create_map(*[F.lit(x) for pair in guidance.items() for x in pair])
    number = count.cast("string")
    return F.concat(
        F.lit("Write business questions about this warehouse, each with one SQL query.\n\nSCHEMA:\n"), schema,
        F.lit("\n\nDIFFICULTY: "), difficulty, F.lit(" ("), rules[difficulty], F.lit(")\nNUMBER: "), number,
        F.lit("\n\nAnswer with a JSON array of "), number,
        F.lit(" objects: question, sql_query, tables_used. Prefix tables with their schema; do not repeat a pattern."),
    )


def retry_prompt(
    question: Column, error: Column, failed_sql: Column,
    headings: tuple[str, str, str] = ("This statement did not run:", "The database said:", "Send one that does."),
) -> Column:
    """The question again, with the statement that failed and the error it caused."""
    statement, said, wish = headings
    return F.concat(
        question, F.lit(f"\n\n{statement}\n"), failed_sql, F.lit(f"\n\n{said}\n"), error, F.lit(f"\n\n{wish}")
    )


def model_input(instruction: Column, question: Column) -> Column:
    return F.concat(
        F.lit(INSTRUCTION_MARK), instruction, F.lit(INPUT_MARK), question, F.lit(OUTPUT_MARK)
    )


def training_text(instruction: Column, question: Column, answer: Column, end_mark: str) -> Column:
    return F.concat(model_input(instruction, question), answer, F.lit(end_mark))
