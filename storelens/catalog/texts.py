"""Registered text jobs.  Responses are put together from the test tables, the
same way in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.catalog.entry import Entry, with_ctes
from storelens.functions import prompts, sqltext
from storelens.functions.scalars import sql_quoted
from storelens.plans import responses
from storelens.sources.tables import table

NL = "chr(10)"

# -- responses from orders -------------------------------------------------

# The shapes a response may have (Spark SQL and DuckDB share this text).
RESPONSE_TEXT = """CASE WHEN o_orderkey % 35 = 4 THEN concat('SELECT ORDER_ID,', chr(10), chr(10), 'CASE WHEN TOTAL > ', o_custkey,
                       ' THEN "Large" END AS SIZE', chr(10), chr(10), 'FROM ORDERS', chr(10), chr(10), 'It says what is large.')
    WHEN o_orderkey % 35 = 11 THEN concat('With c as (select count(*) from ORDERS where NOTE = ', chr(39), 'It', chr(39), chr(39), 's',
                       chr(10), chr(10), 'Fine', chr(39), ' -- the customer', chr(39), 's (own', chr(10), ')', chr(10), chr(10),
                       'Select * from c', chr(10), chr(10), 'Done ', o_custkey)
    WHEN o_orderkey % 35 = 18 THEN concat('Here is it: SELECT STATUS,', chr(10), chr(10), 'ORDER_ID FROM ORDERS WHERE ID IN (', o_custkey,
                       ',', chr(10), chr(10), 'NULL)', chr(10), chr(10), 'Note: one row.')
    ELSE CASE o_orderkey % 7
    WHEN 0 THEN concat('SELECT  COUNT(*) FROM ORDERS WHERE CUSTOMER_ID = ', o_custkey, ';')
    WHEN 1 THEN concat('Sure.', chr(10), '```sql', chr(10), 'SELECT STATUS FROM RAW.ORDERS', chr(10), chr(10),
                       'WHERE ID = ', o_orderkey, ';', chr(10), '```', chr(10), 'Done.')
    WHEN 2 THEN concat('The query is select * from CUSTOMERS JOIN ORDERS ON ID = ', o_custkey, chr(10), chr(10),
                       'It reads status ', o_orderstatus, '.')
    WHEN 3 THEN concat('### Instruction: count', chr(10), '### Response:', chr(10),
                       'SELECT SUM(PRICE) FROM ORDER_ITEMS', chr(10), chr(10), '### Next ', o_orderkey)
    WHEN 4 THEN ''
    WHEN 5 THEN concat('I have no table for priority ', o_orderpriority, ';')
    ELSE concat('WITH c AS (SELECT * FROM WAREHOUSE.RAW.ORDERS)', chr(10), chr(10), 'SELECT * FROM c JOIN SELLERS',
                ' ON c.ID = ', o_custkey, ';;') END END"""

RESPONSES = {
    "w_responses": f"SELECT o_orderkey AS resp_id, {RESPONSE_TEXT} AS text FROM orders",
}


def _responses(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("resp_id"), F.expr(RESPONSE_TEXT).alias("text")
    )


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _unsemicolon(x: str) -> str:
    return rf"regexp_replace({x}, ';+$', '')"


def _clean(x: str) -> str:
    bare = _strip(_unsemicolon(f"regexp_replace({x}, '(?i)```(?:sql)?', '', 'g')"))
    one_space = rf"regexp_replace({bare}, '[ \t]+', ' ', 'g')"
    return _strip(rf"regexp_replace({one_space}, '\n\s*\n', chr(10), 'g')")


def _before(x: str, pattern: str) -> str:
    return f"string_split_regex({x}, '{pattern}')[1]"


# The same patterns for an engine whose flags have no Unicode switch.
FENCED, STATEMENT, QUERY = (x.replace("(?sUi)", "(?si)") for x in (sqltext.FENCED, sqltext.STATEMENT, sqltext.QUERY))


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _open(x: str) -> str:
    code = f"regexp_replace({x}, {_literal(sqltext.SHORT_FORM)}, '\\1', 'g')"
    code = f"regexp_replace({code}, {_literal(sqltext.QUOTED_OR_COMMENT)}, '\\1', 'g')"
    code = f"regexp_replace({code}, {_literal(sqltext.QUOTED)}, '0', 'g')"
    deep = f"len(string_split({code}, '(')) > len(string_split({code}, ')'))"
    return f"""(regexp_matches({code}, '[''"]') OR {deep} OR regexp_matches({code}, {_literal(sqltext.DANGLING)}))"""


def _before_prose(x: str) -> str:
    """The same fold; a mark at the end of the text says that the statement has ended."""
    paragraphs = rf"string_split(regexp_replace({x}, '\n\n([A-Z])', chr(1) || '\1', 'g'), chr(1))"
    waits = f"""regexp_matches(kept, {_literal(sqltext.CTE)}) AND NOT regexp_matches(kept, {_literal(sqltext.CTE_QUERY)})
        AND regexp_matches(p, {_literal(sqltext.VERB)})"""
    goes_on = f"{_open('kept')} OR regexp_matches(p, {_literal(sqltext.IN_CAPITALS)}) OR ({waits})"
    return f"""replace(list_reduce({paragraphs}, lambda kept, p: CASE WHEN suffix(kept, chr(2)) THEN kept
        WHEN {goes_on} THEN kept || chr(10) || chr(10) || p ELSE kept || chr(2) END), chr(2), '')"""


def _extract(x: str) -> str:
    text = _strip(x)
    started = _strip(f"regexp_extract({text}, '{STATEMENT}', 0)")
    return _clean(
        f"""CASE WHEN regexp_matches({text}, '{FENCED}') THEN {_strip(f"regexp_extract({text}, '{FENCED}', 1)")}
            WHEN regexp_matches({text}, '{STATEMENT}') THEN {_before_prose(started)}
            ELSE {text} END"""
    )


def _tail(x: str) -> str:
    bare = f"regexp_replace(string_split({x}, '### Response:')[-1], '(?i)```(?:sql)?', '', 'g')"
    started = f"CASE WHEN regexp_matches({bare}, '{QUERY}') THEN regexp_extract({bare}, '{QUERY}', 0) ELSE {bare} END"
    return _strip(_unsemicolon(_before(_before_prose(f"({started})"), r"\n\n###")))


def _qualify(x: str) -> str:
    names = "|".join(sorted(responses.WAREHOUSE_TABLES, key=len, reverse=True))
    keyword = rf"\b(FROM|JOIN) (?:(?:WAREHOUSE\.)?RAW\.)?({names})\b"
    schema = rf"\b(?:WAREHOUSE\.)?RAW\.({names})\b"
    once = rf"regexp_replace({x}, '{keyword}', '\1 WAREHOUSE.RAW.\2', 'g')"
    return rf"regexp_replace({once}, '{schema}', 'WAREHOUSE.RAW.\1', 'g')"


# -- JSON responses from events --------------------------------------------

SECOND_ITEM = """CASE event_id % 5
    WHEN 0 THEN '7'
    WHEN 1 THEN '{"question": "", "sql_query": "SELECT 1"}'
    WHEN 2 THEN '{"question": "Only a question"}'
    WHEN 3 THEN '"{\\\\"question\\\\": \\\\"quoted\\\\"}"'
    ELSE '{"question": 5, "sql_query": "SELECT 1"}' END"""
SECOND_ITEM_SQL = SECOND_ITEM.replace("\\\\", "\\")

JSON_TEXT = """CASE WHEN event_id % 7 = 0 THEN concat('[{"question": "cut off at ', event_id)
    WHEN event_id % 11 = 0 THEN concat('[', event_id, '] or [', event_id, ']')
    WHEN event_id % 3 = 0 THEN concat('Records: ', records, ' and no more')
    WHEN event_id % 3 = 1 THEN concat('```json', chr(10), records, chr(10), '```')
    ELSE records END"""
RECORDS = """concat('[{"question": "  How many ', event_type, ' events has user ', user_id, '? ", "sql_query": ',
    '"SELECT COUNT(*) FROM EVENTS WHERE USER_ID = ', user_id, '", "tables_used": "EVENTS", "props": ', props, '}, ',
    second_item, ']')"""
DIFFICULTY = "CASE event_id % 3 WHEN 0 THEN 'easy' WHEN 1 THEN 'medium' ELSE 'hard' END"


def _json_responses(spark, sf_dir) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .withColumn("second_item", F.expr(SECOND_ITEM))
        .withColumn("records", F.expr(RECORDS))
        .select("event_id", F.expr(JSON_TEXT).alias("text"))
    )


def _question_records(spark, sf_dir) -> DataFrame:
    return responses.question_records(_json_responses(spark, sf_dir), "text", F.expr(DIFFICULTY))


QUESTION_RECORDS_SQL = f"""
WITH made AS (
    SELECT event_id, {JSON_TEXT} AS text FROM (
        SELECT *, {RECORDS} AS records FROM (SELECT *, {SECOND_ITEM_SQL} AS second_item FROM events))),
found AS (
    SELECT event_id, TRY_CAST(regexp_extract(text, '(?s)\\[.*\\]', 0) AS JSON) AS doc FROM made),
items AS (
    SELECT event_id, unnest(range(CAST(json_array_length(doc) AS BIGINT))) AS pos, unnest(json_extract(doc, '$[*]')) AS item
    FROM found WHERE json_type(doc) = 'ARRAY'),
fields AS (
    SELECT event_id, pos, json_type(item) = 'OBJECT' AS is_object,
           CASE WHEN json_type(item, '$.question') = 'VARCHAR'
                THEN trim(json_extract_string(item, '$.question')) END AS question,
           CASE WHEN json_type(item, '$.sql_query') = 'VARCHAR'
                THEN trim(json_extract_string(item, '$.sql_query')) END AS sql_query,
           coalesce(trim(json_extract_string(item, '$.tables_used')), '') AS tables_used
    FROM items),
judged AS (
    SELECT *, CASE WHEN NOT is_object THEN 'not an object' WHEN coalesce(question, '') = '' THEN 'no question'
                   WHEN coalesce(sql_query, '') = '' THEN 'no query' ELSE 'accepted' END AS outcome FROM fields
    UNION ALL
    SELECT event_id, NULL, NULL, NULL, NULL, NULL, 'no array' FROM found
    WHERE doc IS NULL OR json_type(doc) <> 'ARRAY')
SELECT event_id, CAST(pos AS INTEGER) AS pos, outcome, {DIFFICULTY} AS difficulty,
       CASE WHEN outcome = 'accepted' THEN question END AS question,
       CASE WHEN outcome = 'accepted' THEN sql_query END AS sql_query,
       CASE WHEN outcome = 'accepted' THEN tables_used END AS tables_used
FROM judged"""


# -- descriptions from documents -------------------------------------------


def _column_descriptions(spark, sf_dir) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    answer = F.to_json(
        F.array(
            F.struct(
                F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("column_name"),
                F.col("text").alias("description"),
                F.col("lang").alias("synonyms"),
            )
        )
    )
    answers = documents.select(
        F.col("source").alias("table_name"), F.concat(F.lit("Here: "), answer, F.lit(" .")).alias("text")
    )
    catalog = (
        documents.select("doc_id", F.col("source").alias("table_name"))
        .join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
        .select(
            "table_name",
            F.concat(F.lit("DOC_"), F.col("doc_id").cast("string")).alias("column_name"),
            F.lit("VARCHAR").alias("data_type"),
        )
    )
    return responses.column_descriptions(answers, catalog)


REJECTED_TEXT = """CASE doc_id % 5 WHEN 0 THEN concat('sorry, ', lang) WHEN 1 THEN '{"columns": [1]}'
    WHEN 2 THEN '[{"column_name": "a"}, 7, {"column_name": "b"}]' WHEN 3 THEN '[{"column_name": "cut' ELSE '[]' END"""


def _description_rejects(spark, sf_dir) -> DataFrame:
    answers = table(spark, sf_dir, "documents").select("doc_id", F.expr(REJECTED_TEXT).alias("text"))
    return responses.description_rejects(answers)


COLUMN_DESCRIPTIONS_SQL = """
SELECT source AS table_name, concat('DOC_', d.doc_id) AS column_name, text AS description, lang AS synonyms,
       '' AS sample_values, CASE WHEN l.doc_id IS NULL THEN 'UNKNOWN' ELSE 'VARCHAR' END AS data_type
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id"""


# -- errors from events ----------------------------------------------------

ERROR_TEXT = """CASE event_id % 6
    WHEN 0 THEN concat('Error: SQL compilation error for user ', user_id, chr(10), 'line ', event_id)
    WHEN 1 THEN concat(' ', chr(10), '  DatabaseError: Error: no table ', event_type, '  ', chr(10), 'end')
    WHEN 2 THEN concat(chr(10), '  timeout after ', value, chr(10), 'try again')
    WHEN 3 THEN ''
    WHEN 4 THEN concat(' ', chr(10), '  ')
    ELSE concat('Exception: ERROR at ', event_id) END"""


def _error_texts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.expr(ERROR_TEXT).alias("error_text"))


def _error_line_sql(x: str) -> str:
    lines = f"string_split({x}, chr(10))"
    naming = _strip(f"list_filter({lines}, lambda x: contains(lower(x), 'error'))[1]")
    naming = f"regexp_replace({naming}, '{sqltext.ERROR_CLASSES}', '')"
    filled = f"list_filter({lines}, lambda x: length({_strip('x')}) > 0)"
    return f"""CASE WHEN {x} = '' THEN 'Unknown error (empty error message)'
        WHEN len(list_filter({lines}, lambda x: contains(lower(x), 'error'))) > 0 THEN {naming}
        WHEN len({filled}) > 0 THEN {_strip(f'{filled}[1]')}
        ELSE {_strip(x)} END"""


def _retry_prompts(spark, sf_dir) -> DataFrame:
    failed = responses.error_lines(
        table(spark, sf_dir, "events").select(
            "event_id",
            F.concat(F.lit("What did user "), "user_id", F.lit(" do?")).alias("question"),
            F.concat(F.lit("SELECT * FROM EVENTS WHERE TYPE = "), "event_type").alias("failed_sql"),
            F.expr(ERROR_TEXT).alias("error_text"),
        )
    )
    prompt = prompts.retry_prompt(F.col("question"), F.col("error"), F.col("failed_sql"))
    return failed.select("event_id", prompt.alias("prompt"))


RETRY_PROMPT_SQL = f"""
SELECT event_id, concat('What did user ', user_id, ' do?', chr(10), chr(10),
    'This statement did not run:', chr(10), 'SELECT * FROM EVENTS WHERE TYPE = ', event_type, chr(10), chr(10),
    'The database said:', chr(10), {_error_line_sql('error_text')}, chr(10), chr(10), 'Send one that does.') AS prompt
FROM (SELECT *, {ERROR_TEXT} AS error_text FROM events)"""


ENTRIES: dict[str, Entry] = {
    "extract_sql": Entry(
        lambda s, d: responses.extracted(_responses(s, d)).select("resp_id", "sql"),
        with_ctes(
            f"""SELECT resp_id, {_extract('text')} AS sql FROM w_responses""",
            RESPONSES,
        ),
    ),
    "clean_sql": Entry(
        lambda s, d: responses.cleaned(_responses(s, d)).select("resp_id", "sql"),
        with_ctes(f"SELECT resp_id, {_clean('text')} AS sql FROM w_responses", RESPONSES),
    ),
    "response_tail_sql": Entry(
        lambda s, d: responses.tails(_responses(s, d)).select("resp_id", "sql"),
        with_ctes(f"SELECT resp_id, {_tail('text')} AS sql FROM w_responses", RESPONSES),
    ),
    "qualify_sql": Entry(
        lambda s, d: responses.qualified(_responses(s, d), "text").select("resp_id", "qualified_sql"),
        with_ctes(f"SELECT resp_id, {_qualify('text')} AS qualified_sql FROM w_responses", RESPONSES),
    ),
    "response_flags": Entry(
        lambda s, d: responses.flags(responses.extracted(_responses(s, d)))
        .groupBy("uses_qualified_names", "has_sql")
        .agg(F.count("*").alias("responses")),
        with_ctes(
            f"""SELECT contains(upper(sql), 'WAREHOUSE.RAW.') AS uses_qualified_names,
                       length(trim(sql)) > 0 AS has_sql, COUNT(*) AS responses
                FROM (SELECT {_extract('text')} AS sql FROM w_responses) GROUP BY 1, 2""",
            RESPONSES,
        ),
    ),
    "question_records": Entry(_question_records, QUESTION_RECORDS_SQL),
    "column_descriptions": Entry(_column_descriptions, COLUMN_DESCRIPTIONS_SQL),
    "description_rejects": Entry(
        _description_rejects,
        """SELECT doc_id, CASE WHEN doc_id % 5 = 2 THEN 1 END AS pos,
                  CASE doc_id % 5 WHEN 1 THEN 'one object instead of an array' WHEN 2 THEN 'not an object'
                                  ELSE 'no array' END AS reason
           FROM documents""",
    ),
    "error_line": Entry(
        lambda s, d: responses.error_lines(_error_texts(s, d)).select("event_id", "error"),
        f"""SELECT event_id, {_error_line_sql('error_text')} AS error
            FROM (SELECT event_id, {ERROR_TEXT} AS error_text FROM events)""",
    ),
    "retry_prompt": Entry(_retry_prompts, RETRY_PROMPT_SQL),
    "quoted_questions": Entry(
        lambda s, d: table(s, d, "documents").select("doc_id", sql_quoted(F.col("text")).alias("quoted")),
        "SELECT doc_id, replace(text, '''', '''''') AS quoted FROM documents",
    ),
}
