"""Registered retrieval jobs: benchmark texts ask, documents describe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.catalog.entry import Entry, with_ctes
from storelens.functions import prompts
from storelens.functions.keywords import STOPWORDS, with_keywords
from storelens.plans.responses import PREFIX
from storelens.retrieval import keyword, linking, semantic
from storelens.sources.tables import table

EXCLUDED = ("src19",)
LIMIT = 5

# Questions next to those of the benchmark: blank, with quote and percent sign,
# without any hit, and with a word that is nothing but a mark.
EXTRA_QUESTIONS = (
    (-1, "  "),
    (-2, "What's in doc_1 at 100%, 'src'?"),
    (-3, "zzqqxx yyvvkk"),
    (-4, "? of"),
)
EDGES = (("src1", "src0"), ("src2", "src0"), ("src3", "src0"), ("src0", "src4"), ("src5", "lang_en"), ("src6", "lang_en"))
RULES = ("Use only the tables listed.", "Qualify every table name.", "Return one statement.")
EXAMPLES = (("How many orders are there?", "SELECT COUNT(*) FROM WAREHOUSE.RAW.ORDERS"),)


def _values(rows) -> str:
    def literal(v) -> str:
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


_LONG = "length(w) > 3"
_STOP = "[" + ", ".join(f"'{w}'" for w in STOPWORDS) + "]"

CTES = {
    "w_questions": f"""
        SELECT item_id AS question_id, text FROM benchmark
        UNION ALL SELECT * FROM (VALUES {_values(EXTRA_QUESTIONS)})""",
    "w_words": r"""
        SELECT question_id, list_transform(string_split_regex(
            regexp_replace(lower(text), '^\s+|\s+$', '', 'g'), '\s+'), lambda w: trim(w, '''"?,')) AS words
        FROM w_questions WHERE regexp_matches(text, '\S')""",
    "w_keywords": f"""
        SELECT question_id, (CASE
            WHEN len(list_filter(words, lambda w: {_LONG} AND NOT list_contains({_STOP}, w))) > 0
            THEN list_filter(words, lambda w: {_LONG} AND NOT list_contains({_STOP}, w))
            WHEN len(list_filter(words, lambda w: {_LONG})) > 0 THEN list_filter(words, lambda w: {_LONG})
            ELSE words END)[1:10] AS keywords
        FROM w_words""",
    "w_descriptions": """
        SELECT source AS table_name, concat('doc_', doc_id) AS column_name, 'VARCHAR' AS data_type,
               text AS description, lang AS synonyms FROM documents""",
    "w_catalog": """
        SELECT DISTINCT source AS table_name, lang AS column_name FROM documents
        UNION ALL SELECT DISTINCT concat('lang_', lang), source FROM documents""",
    "w_hits": """
        SELECT DISTINCT question_id, table_name, column_name
        FROM (SELECT question_id, unnest(keywords) AS k FROM w_keywords)
        JOIN (SELECT *, lower(concat_ws(' ', description, column_name, synonyms)) AS searched FROM w_descriptions)
          ON contains(searched, k)
        WHERE table_name <> 'src19'""",
    "w_rows": """
        SELECT * FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY question_id
                          ORDER BY match_count DESC, table_name, column_name) AS column_rank,
                   DENSE_RANK() OVER (PARTITION BY question_id ORDER BY match_count DESC, table_name) AS table_rank
            FROM (SELECT *, COUNT(*) OVER (PARTITION BY question_id, table_name) AS match_count FROM w_hits))
        WHERE column_rank <= 75""",
    "w_keyword_tables": """
        SELECT question_id, table_name, 0.5::DOUBLE AS relevance_score, table_rank, match_count,
               COUNT(*) AS listed_columns
        FROM w_rows WHERE table_rank <= 5 GROUP BY question_id, table_name, table_rank, match_count""",
    "w_vectors": "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vector, label FROM embeddings",
    "w_near": """
        SELECT question_id, row_id, table_name, round(cosine, 6) AS score, row_rank FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY question_id ORDER BY cosine DESC, row_id) AS row_rank
            FROM (SELECT q.vec_id AS question_id, d.vec_id AS row_id, CAST(d.label AS VARCHAR) AS table_name,
                         list_cosine_similarity(q.vector, d.vector) AS cosine
                  FROM w_vectors q CROSS JOIN w_vectors d))
        WHERE row_rank <= 50""",
    "w_near_tables": """
        SELECT * FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY question_id
                          ORDER BY relevance_score DESC, table_name) AS table_rank
            FROM (SELECT question_id, table_name, COUNT(*) AS listed_columns,
                         CAST(SUM(CAST(score AS DECIMAL(10,6))) AS DOUBLE) / COUNT(*) AS relevance_score
                  FROM w_near WHERE table_name <> '9' GROUP BY question_id, table_name))
        WHERE table_rank <= 5""",
}


def _sql(body: str) -> str:
    return with_ctes(body, CTES)


def _questions(spark, sf_dir) -> DataFrame:
    extra = spark.createDataFrame(EXTRA_QUESTIONS, "question_id long, text string")
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("long").alias("question_id"), "text")
    return asked.unionByName(extra)


def _descriptions(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("table_name"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("column_name"),
        F.lit("VARCHAR").alias("data_type"),
        F.col("text").alias("description"),
        F.col("lang").alias("synonyms"),
    )


def _catalog(spark, sf_dir) -> DataFrame:
    """Columns known to the catalog: a table per source and one per language."""
    pairs = table(spark, sf_dir, "documents").select("source", "lang").distinct()
    return pairs.select(F.col("source").alias("table_name"), F.col("lang").alias("column_name")).unionByName(
        pairs.select(F.concat(F.lit("lang_"), "lang").alias("table_name"), F.col("source").alias("column_name"))
    )


def _vectors(spark, sf_dir, key: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias(key), F.col("label").cast("string").alias("table_name"), F.col("embedding").alias("vector")
    )


def _keyword_tables(spark, sf_dir) -> DataFrame:
    return keyword.keyword_tables(_questions(spark, sf_dir), _descriptions(spark, sf_dir), LIMIT, EXCLUDED)


def _keyword_rows(spark, sf_dir) -> DataFrame:
    return keyword.keyword_rows(_questions(spark, sf_dir), _descriptions(spark, sf_dir), LIMIT, EXCLUDED)


def _semantic_tables(spark, sf_dir) -> DataFrame:
    return semantic.semantic_tables(
        _vectors(spark, sf_dir, "question_id"), _vectors(spark, sf_dir, "row_id"), LIMIT, ("9",)
    )


def _tiers(spark, sf_dir) -> DataFrame:
    """Questions that have a vector are found by vector, those left by keyword, and the
    rest by the table list."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("question_id"), F.col("embedding").alias("vector"))

    def by_vector(left: DataFrame) -> DataFrame:
        asked = vectors.join(left.select("question_id"), "question_id", "left_semi")
        return semantic.semantic_tables(asked, _vectors(spark, sf_dir, "row_id"), LIMIT, ("9",))

    def by_word(left: DataFrame) -> DataFrame:
        return keyword.keyword_tables(left, _descriptions(spark, sf_dir), LIMIT, EXCLUDED)

    def by_name(left: DataFrame) -> DataFrame:
        return linking.first_tables(left, _catalog(spark, sf_dir), LIMIT)

    return linking.by_tier(_questions(spark, sf_dir), [by_vector, by_word, by_name])


def _supplement(spark, sf_dir) -> DataFrame:
    edges = spark.createDataFrame(EDGES, "table_name string, partner string")
    return linking.supplement(
        _keyword_tables(spark, sf_dir), edges, _descriptions(spark, sf_dir), _catalog(spark, sf_dir)
    )


def _prompt(spark, sf_dir) -> DataFrame:
    schema = prompts.schema_text(_keyword_rows(spark, sf_dir), "question_id", PREFIX)
    asked = _questions(spark, sf_dir).join(schema, "question_id", "left")
    prompt = prompts.question_prompt(RULES, F.col("schema_text"), EXAMPLES, F.col("text"))
    return asked.select("question_id", F.md5(prompt).alias("prompt_md5"), F.length(prompt).cast("long").alias("prompt_length"))


_LINE = """concat('  - ', column_name, ' (', data_type, '): ', description,
    CASE WHEN length(trim(synonyms)) > 0 THEN concat(' [Synonyms: ', synonyms, ']') ELSE '' END)"""
SCHEMA_TEXT_SQL = f"""
    SELECT question_id, string_agg(concat(chr(10), 'Table: WAREHOUSE.RAW.', table_name, ' (Relevance: 0.50)', chr(10),
               lines), chr(10) ORDER BY table_rank) AS schema_text
    FROM (SELECT question_id, table_rank, table_name, string_agg({_LINE}, chr(10) ORDER BY column_rank) AS lines
          FROM w_rows JOIN w_descriptions USING (table_name, column_name) GROUP BY question_id, table_rank, table_name)
    GROUP BY question_id"""
_PROMPT_SQL = """concat('Write one SQL query that answers the question.', chr(10), chr(10), 'RULES:', chr(10),
    '1. Use only the tables listed.', chr(10), '2. Qualify every table name.', chr(10),
    '3. Return one statement.', chr(10), chr(10), 'SCHEMA:', chr(10), coalesce(schema_text, ''), chr(10), chr(10),
    'EXAMPLES:', chr(10), 'Question: How many orders are there?', chr(10), 'SQL:', chr(10),
    'SELECT COUNT(*) FROM WAREHOUSE.RAW.ORDERS', chr(10), chr(10), 'QUESTION:', chr(10), text)"""

ENTRIES: dict[str, Entry] = {
    "keyword_extract": Entry(
        lambda s, d: with_keywords(_questions(s, d).filter(F.regexp_like("text", F.lit(r"(?U)\S"))), "text", "found")
        .select("question_id", F.array_join("found", "|").alias("keywords")),
        _sql("SELECT question_id, array_to_string(keywords, '|') AS keywords FROM w_keywords"),
    ),
    "keyword_match": Entry(
        lambda s, d: _keyword_rows(s, d).select("question_id", "table_name", "column_name", "match_count", "column_rank"),
        _sql("SELECT question_id, table_name, column_name, match_count, column_rank FROM w_rows"),
    ),
    "keyword_tables": Entry(
        lambda s, d: _keyword_tables(s, d),
        _sql(
            """SELECT question_id, table_name, relevance_score, table_rank, match_count, listed_columns
               FROM w_keyword_tables"""
        ),
    ),
    "semantic_rows": Entry(
        lambda s, d: semantic.semantic_rows(_vectors(s, d, "question_id"), _vectors(s, d, "row_id"), LIMIT),
        _sql("SELECT question_id, row_id, table_name, score, row_rank FROM w_near"),
    ),
    "semantic_tables": Entry(
        _semantic_tables,
        _sql("SELECT question_id, table_name, relevance_score, listed_columns, table_rank FROM w_near_tables"),
    ),
    "fk_supplement": Entry(
        _supplement,
        _sql(
            f"""SELECT question_id, table_name, relevance_score, listed_columns, false AS added FROM w_keyword_tables
                UNION ALL
                SELECT question_id, table_name, CASE WHEN any_described THEN 0.4 ELSE 0.3 END::DOUBLE,
                       coalesce(d_columns, c_columns), true
                FROM (SELECT *, max(d_columns IS NOT NULL) OVER (PARTITION BY question_id) AS any_described
                      FROM (SELECT DISTINCT k.question_id, e.partner AS table_name FROM w_keyword_tables k
                            JOIN (VALUES {_values(EDGES)}) e(table_name, partner) ON k.table_name = e.table_name
                            WHERE NOT EXISTS (SELECT 1 FROM w_keyword_tables x
                                              WHERE x.question_id = k.question_id AND x.table_name = e.partner))
                      LEFT JOIN (SELECT table_name, COUNT(*) AS d_columns FROM w_descriptions GROUP BY 1)
                          USING (table_name)
                      LEFT JOIN (SELECT table_name, COUNT(*) AS c_columns FROM w_catalog GROUP BY 1)
                          USING (table_name))
                WHERE d_columns IS NOT NULL OR (NOT any_described AND c_columns IS NOT NULL)"""
        ),
    ),
    "retrieval_tiers": Entry(
        _tiers,
        _sql(
            """SELECT question_id, table_name, relevance_score, tier FROM (
                   SELECT *, min(tier) OVER (PARTITION BY question_id) AS best FROM (
                       SELECT n.question_id, n.table_name, n.relevance_score, 1 AS tier FROM w_near_tables n
                       JOIN embeddings e ON e.vec_id = n.question_id
                       UNION ALL SELECT question_id, table_name, relevance_score, 2 FROM w_keyword_tables
                       UNION ALL SELECT question_id, table_name, 0.1::DOUBLE, 3 FROM w_questions CROSS JOIN
                           (SELECT DISTINCT table_name FROM w_catalog ORDER BY table_name LIMIT 5))
                   WHERE question_id IN (SELECT question_id FROM w_words))
               WHERE tier = best"""
        ),
    ),
    "description_coverage": Entry(
        lambda s, d: linking.description_coverage(
            _descriptions(s, d).select("table_name", "column_name"),
            table(s, d, "documents")
            .join(table(s, d, "labels").select("doc_id"), "doc_id", "left_semi")
            .select(F.col("source").alias("table_name"), F.col("doc_id").alias("column_name")),
        ),
        """SELECT coalesce(source, 'TOTAL') AS table_name, COUNT(*) AS expected_columns, COUNT(l.doc_id) AS described_columns,
                  COUNT(l.doc_id) >= COUNT(*) AS complete
           FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id
           GROUP BY ROLLUP (source)""",
    ),
    "schema_text": Entry(
        lambda s, d: prompts.schema_text(_keyword_rows(s, d), "question_id", PREFIX),
        _sql(SCHEMA_TEXT_SQL),
    ),
    "short_schema_text": Entry(
        lambda s, d: prompts.short_schema_text(_keyword_rows(s, d), "question_id", PREFIX),
        _sql(
            """SELECT question_id, concat('Available tables:', chr(10), string_agg(concat('- WAREHOUSE.RAW.', table_name,
                          ': ', items), chr(10) ORDER BY table_rank)) AS schema_text
               FROM (SELECT question_id, table_rank, table_name,
                            string_agg(concat(column_name, ' (VARCHAR)'), ', ' ORDER BY column_rank) AS items
                     FROM w_rows GROUP BY question_id, table_rank, table_name)
               GROUP BY question_id"""
        ),
    ),
    "prompt_text": Entry(
        _prompt,
        _sql(
            f"""SELECT question_id, md5({_PROMPT_SQL}) AS prompt_md5, length({_PROMPT_SQL}) AS prompt_length
                FROM w_questions LEFT JOIN ({SCHEMA_TEXT_SQL}) USING (question_id)"""
        ),
    ),
}
