"""JSON arrays inside noisy model responses.

Built column by column: a parsed value is used several times, and as a column
it is parsed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.sqltext import strip

END_MARK = "end of text"


def unfenced(text: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(strip(text), r"(?U)```json\s*", ""), r"(?U)```\s*", ""))


def array_text(text: Column) -> Column:
    """From the first ``[`` to the last ``]``; empty without both."""
    return F.regexp_extract(text, r"(?s)\[.*\]", 0)


def _marked(text: Column) -> Column:
    """The text as the first of two array elements.  The parser stops after the
    first value of a text; with anything left over, the second element is not
    the mark."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f', "{END_MARK}"]')))


def _complete(marked: Column) -> Column:
    return (F.try_variant_get(marked, "$[1]", "string") == END_MARK) & (
        F.try_variant_get(marked, "$[2]", "string").isNull()
    )


def is_json_object(text: Column) -> Column:
    """True where the text as a whole is one JSON object."""
    bare = strip(text)
    return bare.startswith("{") & F.coalesce(_complete(_marked(bare)), F.lit(False))


def parse_items(df: DataFrame, text: Column) -> DataFrame:
    """One row per element of the array in ``text``: ``pos`` and ``fields``, the
    members of the element, NULL when it is not an object.

    A text without a readable array gives one row with NULL ``pos``.
    """
    kept = df.columns
    items = F.when(_complete(F.col("_marked")), F.try_variant_get("_marked", "$[0]", "array<variant>"))
    return (
        df.withColumn("_array", array_text(text))
        .withColumn("_marked", _marked(F.col("_array")))
        .withColumn("_items", items)
        .select(*kept, F.posexplode_outer("_items").alias("pos", "_item"))
        .withColumn("fields", F.try_variant_get("_item", "$", "map<string,variant>"))
        .drop("_item")
    )


def text_field(fields: Column, name: str) -> Column:
    """A string member of an object; NULL for a missing or non-string one."""
    value = fields[name]
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))
