"""Jobs over tables of model responses: SQL, JSON records, error texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions import jsontext, sqltext

# The warehouse tables whose names may appear in responses.
WAREHOUSE_TABLES = (
    "ORDERS", "CUSTOMERS", "ORDER_ITEMS", "ORDER_PAYMENTS", "ORDER_REVIEWS", "PRODUCTS", "SELLERS",
    "GEOLOCATION", "PRODUCT_CATEGORY_TRANSLATION", "SUPERSTORE_SALES",
)
PREFIX = "WAREHOUSE.RAW."


def extracted(responses: DataFrame, text: str = "text") -> DataFrame:
    return responses.withColumn("sql", sqltext.extract_sql(F.col(text)))


def cleaned(responses: DataFrame, text: str = "text") -> DataFrame:
    return responses.withColumn("sql", sqltext.clean_sql(F.col(text)))


def tails(responses: DataFrame, text: str = "text") -> DataFrame:
    return responses.withColumn("sql", sqltext.response_tail_sql(F.col(text)))


def qualified(responses: DataFrame, sql: str = "sql", prefix: str = PREFIX) -> DataFrame:
    return responses.withColumn("qualified_sql", sqltext.qualify_sql(F.col(sql), WAREHOUSE_TABLES, prefix))


def flags(responses: DataFrame, sql: str = "sql", prefix: str = PREFIX) -> DataFrame:
    return responses.withColumn("uses_qualified_names", sqltext.uses_qualified_names(F.col(sql), prefix)).withColumn(
        "has_sql", sqltext.has_sql(F.col(sql))
    )


def question_records(responses: DataFrame, text: str, difficulty: Column) -> DataFrame:
    """Question records found in responses, one row per array element, with
    the reason why an element was not accepted."""
    def field(name: str) -> Column:
        return F.coalesce(sqltext.strip(jsontext.text_field(F.col("fields"), name)), F.lit(""))

    items = jsontext.parse_items(responses, jsontext.unfenced(F.col(text)))
    named = (
        items.withColumn("question", field("question"))
        .withColumn("sql_query", field("sql_query"))
        .withColumn("tables_used", field("tables_used"))
    )
    outcome = (
        F.when(F.col("pos").isNull(), "no array")
        .when(F.col("fields").isNull(), "not an object")
        .when(F.col("question") == "", "no question")
        .when(F.col("sql_query") == "", "no query")
        .otherwise("accepted")
    )
    accepted = F.col("outcome") == "accepted"
    return named.withColumn("outcome", outcome).select(
        *[c for c in responses.columns if c != text],
        "pos",
        "outcome",
        *[F.when(accepted, F.col(c)).alias(c) for c in ("question", "sql_query", "tables_used")],
        difficulty.alias("difficulty"),
    )


def column_descriptions(responses: DataFrame, catalog: DataFrame) -> DataFrame:
    """Description rows from responses (table_name, text), typed from the
    catalog (table_name, column_name, data_type); 'UNKNOWN' where it has none.
    What cannot be read is listed by ``description_rejects``."""
    items = _described_items(responses).filter("reason IS NULL")

    def field(name: str) -> Column:
        return F.coalesce(jsontext.text_field(F.col("fields"), name), F.lit(""))

    described = items.select(
        "table_name",
        F.upper(field("column_name")).alias("column_name"),
        field("description").alias("description"),
        field("synonyms").alias("synonyms"),
        field("sample_values").alias("sample_values"),
    )
    return described.join(catalog, ["table_name", "column_name"], "left").withColumn(
        "data_type", F.coalesce("data_type", F.lit("UNKNOWN"))
    )


def _described_items(responses: DataFrame) -> DataFrame:
    """The elements of the responses' arrays, with the reason where one cannot be read."""
    marked = responses.withColumn("_object", F.coalesce(jsontext.is_json_object(F.col("text")), F.lit(False)))
    items = jsontext.parse_items(marked, F.when(~F.col("_object"), F.col("text")))
    reason = (
        F.when(F.col("_object"), "one object instead of an array")
        .when(F.col("pos").isNull(), "no array")
        .when(F.col("fields").isNull(), "not an object")
    )
    return items.withColumn("reason", reason).drop("_object")


def description_rejects(responses: DataFrame) -> DataFrame:
    """What ``column_descriptions`` leaves out: the response's columns but its text, the
    position of the element (null for a whole response) and the reason."""
    kept = [c for c in responses.columns if c != "text"]
    return _described_items(responses).filter("reason IS NOT NULL").select(*kept, "pos", "reason")


def error_lines(errors: DataFrame, text: str = "error_text") -> DataFrame:
    return errors.withColumn("error", sqltext.error_line(F.col(text)))
