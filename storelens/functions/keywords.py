"""Keywords of a question."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that do not help to find a table, characters taken off
# the ends of a word, and the size limits of the keyword rule.
STOPWORDS = (
    "what", "which", "where", "when", "who", "how", "many", "much",
    "have", "been", "that", "this", "with", "from", "they", "each",
    "highest", "lowest", "average", "total", "count", "find", "show",
    "list", "give", "most", "least", "more", "than", "over", "last",
    "first", "were", "does", "also", "into", "some", "only", "their",
    "there", "these", "those", "very", "just", "will", "would",
    "could", "should", "across", "between", "within", "using", "based",
)
EDGE_CHARACTERS = "'\"?,"
MIN_LENGTH = 4
MAX_KEYWORDS = 10


def words(text: Column) -> Column:
    """Lower-case words of a text, without quotes and marks at their ends."""
    bare = F.regexp_replace(F.lower(text), r"(?U)^\s+|\s+$", "")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.split(bare, r"(?U)\s+"), lambda w: F.btrim(w, F.lit(EDGE_CHARACTERS)))
    )


def with_keywords(df: DataFrame, text: str, name: str, most: int = MAX_KEYWORDS) -> DataFrame:
    """Add the first ``most`` keywords of a text column: long words that are not
    stopwords; if there are none, long words; if there are none either, all
    words.  Built column by column, so that each list is made once."""
    stop = F.array(*map(F.lit, STOPWORDS))
    return (
        df.withColumn("_words", words(F.col(text)))
        .withColumn("_long", F.filter("_words", lambda w: F.length(w) >= MIN_LENGTH))
        .withColumn("_telling", F.filter("_long", lambda w: ~F.array_contains(stop, w)))
        .withColumn(
            name,
            F.slice(
                F.when(F.size("_telling") > 0, F.col("_telling"))
                .when(F.size("_long") > 0, F.col("_long"))
                .otherwise(F.col("_words")),
                1,
                most,
            ),
        )
        .drop("_words", "_long", "_telling")
    )
