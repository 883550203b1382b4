import json

import pytest
from pyspark.sql import functions as F

from storelens.functions import prompts, sqltext
from storelens.functions.scalars import clock_text, days_between, ellipsis, qualified_name, ratio_or_zero
from storelens.plans import responses


def one(spark, text, expression):
    return spark.createDataFrame([(text,)], "t string").select(expression(F.col("t")).alias("x")).first().x


EXTRACT = [
    ("SELECT COUNT(*) FROM ORDERS", "SELECT COUNT(*) FROM ORDERS"),
    ("```sql\nSELECT * FROM ORDERS\n```", "SELECT * FROM ORDERS"),
    ("Text\n```SQL\nSELECT  1;\n```\nmore ```\nSELECT 2\n```", "SELECT 1"),
    ("``` ```", ""),
    ("", ""),
    (None, ""),
    ("Answer: select a\tb  from t;\n\nThis reads t.", "select a b from t"),
    ("SELECT 1\n\nNote: one", "SELECT 1"),
    ("SELECT 1\n\n\n  \nfrom t", "SELECT 1\nfrom t"),
    ("no statement here;", "no statement here"),
    ("WITH c AS (SELECT 1)\n\nSELECT * FROM c", "WITH c AS (SELECT 1)\nSELECT * FROM c"),
    ("SELECT a\n\nWHERE x\n\nFrom here on it is prose", "SELECT a\nWHERE x"),
    ("SELECT 1;\n", "SELECT 1"),
    ("SELECT A,\n\nCASE WHEN B > 1 THEN 2 END FROM T", "SELECT A,\nCASE WHEN B > 1 THEN 2 END FROM T"),
    ("SELECT A,\n\nORDER_ID FROM T\n\nThis reads T.", "SELECT A,\nORDER_ID FROM T"),
    ("select (a +\n\nB)\n\nAs c\n\nfrom t", "select (a +\nB)"),
    ("SELECT 'One\n\nTwo' FROM t\n\nThe end", "SELECT 'One\nTwo' FROM t"),
    ("With a as (select 1)\n\nSelect * from a\n\nSelect rows you like", "With a as (select 1)\nSelect * from a"),
    ("SELECT 1 -- what's (here\n\nIt is one.", "SELECT 1 -- what's (here"),
    ("SELECT a FROM t WHERE x AND\n\nY = 1\n\nNOTE: x", "SELECT a FROM t WHERE x AND\nY = 1"),
    ("With this you'll see: SELECT 1\n\nThat's all.", "With this you'll see: SELECT 1"),
    ("unselected SELECT 1 ", "SELECT 1"),
]


@pytest.mark.parametrize("text,expected", EXTRACT)
def test_extract_sql(spark, text, expected):
    assert one(spark, text, sqltext.extract_sql) == expected


@pytest.mark.parametrize(
    "text,expected",
    [
        ("### Response:\nold\n### Response:\nHere: select 1;", "select 1"),
        ("SELECT 1\n\n### Input", "SELECT 1"),
        ("```sql\nWITH a AS (SELECT 1)\n```\n\nDone", "WITH a AS (SELECT 1)"),
        ("nothing", "nothing"),
    ],
)
def test_response_tail(spark, text, expected):
    assert one(spark, text, sqltext.response_tail_sql) == expected


@pytest.mark.parametrize(
    "sql,expected",
    [
        ("SELECT * FROM ORDERS", "SELECT * FROM WAREHOUSE.RAW.ORDERS"),
        ("FROM RAW.ORDERS JOIN ORDER_ITEMS ON 1", "FROM WAREHOUSE.RAW.ORDERS JOIN WAREHOUSE.RAW.ORDER_ITEMS ON 1"),
        ("SELECT RAW.ORDERS.ID FROM ORDERS\n", "SELECT WAREHOUSE.RAW.ORDERS.ID FROM WAREHOUSE.RAW.ORDERS\n"),
        ("FROM ORDERS_OLD JOIN MYORDERS", "FROM ORDERS_OLD JOIN MYORDERS"),
        ("FROM WAREHOUSE.RAW.SELLERS", "FROM WAREHOUSE.RAW.SELLERS"),
    ],
)
def test_qualify_sql_runs_twice_without_change(spark, sql, expected):
    def qualify(c):
        return sqltext.qualify_sql(c, responses.WAREHOUSE_TABLES, responses.PREFIX)

    assert one(spark, sql, qualify) == expected
    assert one(spark, sql, lambda c: qualify(qualify(c))) == expected


@pytest.mark.parametrize(
    "text,expected",
    [
        ("Error: SQL compilation error:\nline 1", "SQL compilation error:"),
        ("note\n  Exception: bad error  \nx", "bad error"),
        ("DatabaseError: Exception: an error", "an error"),
        ("\n  timeout\nrest", "timeout"),
        ("", "Unknown error (empty error message)"),
        (None, "Unknown error (empty error message)"),
        (" \n ", ""),
    ],
)
def test_error_line(spark, text, expected):
    assert one(spark, text, sqltext.error_line) == expected


RECORD = {"question": " How many? ", "sql_query": "SELECT 1 ", "tables_used": "T"}


@pytest.mark.parametrize(
    "text,outcomes",
    [
        (json.dumps([RECORD, RECORD]), ["accepted", "accepted"]),
        ("```json\n" + json.dumps([RECORD]) + "\n```", ["accepted"]),
        ("Here: " + json.dumps([RECORD]) + " bye", ["accepted"]),
        (json.dumps([1, "{}", None, {"question": ""}, {"question": "q"}, {"question": 3, "sql_query": "s"}]),
         ["not an object", "not an object", "not an object", "no question", "no query", "no question"]),
        ("[1] and [2]", ["no array"]),
        ("[1], [2]", ["no array"]),
        ("[1]]", ["no array"]),
        ("[{'question': 'single quotes'}]", ["no array"]),
        ("nothing", ["no array"]),
        ("[]", ["no array"]),
        (None, ["no array"]),
    ],
)
def test_question_records(spark, text, outcomes):
    df = spark.createDataFrame([(1, text)], "id int, t string")
    rows = responses.question_records(df, "t", F.lit("easy")).orderBy("pos").collect()
    assert [r.outcome for r in rows] == outcomes
    for row in rows:
        expected = ("How many?", "SELECT 1", "T") if row.outcome == "accepted" else (None, None, None)
        assert (row.question, row.sql_query, row.tables_used) == expected


def test_column_descriptions_take_types_from_the_catalog(spark):
    answer = json.dumps([{"column_name": "id", "description": "it's the key", "synonyms": "no"}, {"column_name": "x"}, 7])
    given = spark.createDataFrame(
        [("T", "Sure: " + answer), ("U", '{"list": [{"column_name": "y"}]}')], "table_name string, text string"
    )
    catalog = spark.createDataFrame([("T", "ID", "VARCHAR")], "table_name string, column_name string, data_type string")
    rows = responses.column_descriptions(given, catalog).orderBy("column_name").collect()
    assert [(r.column_name, r.data_type, r.description) for r in rows] == [
        ("ID", "VARCHAR", "it's the key"), ("X", "UNKNOWN", ""),
    ]


def test_descriptions_that_cannot_be_read_are_listed(spark):
    given = spark.createDataFrame(
        [("T", '[{"column_name": "id"}, 7]'), ("U", '{"list": [1]}'), ("V", "no"), ("W", None)], "table_name string, text string"
    )
    assert {(r.table_name, r.pos, r.reason) for r in responses.description_rejects(given).collect()} == {
        ("T", 1, "not an object"), ("U", None, "one object instead of an array"), ("V", None, "no array"), ("W", None, "no array"),
    }


def test_flags(spark):
    df = spark.createDataFrame([("select 1 from warehouse.raw.t",), ("  ",), (None,)], "sql string")
    rows = responses.flags(df).collect()
    assert [r.has_sql for r in rows] == [True, False, False]
    assert rows[0].uses_qualified_names


def test_prompts(spark):
    linked = spark.createDataFrame(
        [(1, 1, "ORDERS", 0.5, 2, "b", "INT", "second", " "), (1, 1, "ORDERS", 0.5, 1, "a", "INT", "first", "x, y"),
         (1, 2, "WAREHOUSE.RAW.S", 0.126, 3, "c", "INT", "third", None)],
        "q int, table_rank int, table_name string, relevance_score double, column_rank int, column_name string, "
        "data_type string, description string, synonyms string",
    )
    assert prompts.schema_text(linked, "q", responses.PREFIX).first().schema_text == (
        "\nTable: WAREHOUSE.RAW.ORDERS (Relevance: 0.50)\n  - a (INT): first [Synonyms: x, y]\n  - b (INT): second"
        "\n\nTable: WAREHOUSE.RAW.S (Relevance: 0.13)\n  - c (INT): third"
    )
    assert prompts.short_schema_text(linked, "q", responses.PREFIX).first().schema_text == (
        "Available tables:\n- WAREHOUSE.RAW.ORDERS: a (INT), b (INT)\n- WAREHOUSE.RAW.S: c (INT)"
    )
    assert one(spark, "q?", lambda c: prompts.training_text(F.lit("do"), c, F.lit("SELECT 1"), "<end>")) == (
        "### Instruction:\ndo\n\n### Input:\nq?\n\n### Response:\nSELECT 1<end>"
    )
    asked = one(spark, "q?", lambda c: prompts.question_prompt(["r1", "r2"], F.lit("S"), [("e", "SELECT 2")], c))
    assert asked.index("1. r1") < asked.index("2. r2") < asked.index("SELECT 2") < asked.index("q?")
    again = one(spark, "q?", lambda c: prompts.retry_prompt(c, F.lit("bad"), F.lit("SELECT x")))
    assert again.startswith("q?") and "bad" in again and "SELECT x" in again
    lines = F.array(F.lit("- a (INT)"), F.lit("- b (INT)"))
    assert "Table: T\nColumns:\n- a (INT)\n- b (INT)" in one(spark, "T", lambda c: prompts.describe_prompt(c, lines))


def test_scalars(spark):
    row = (
        spark.sql("SELECT timestamp_ntz'2024-01-01 23:00:00.5' AS a, timestamp_ntz'2024-01-02 01:00:00' AS b, 'abcdef' AS s")
        .select(
            days_between(F.col("a"), F.col("b")).alias("days"),
            clock_text(F.col("a")).alias("clock"),
            ellipsis(F.col("s"), 3).alias("cut"),
            ellipsis(F.col("s"), 6).alias("whole"),
            ratio_or_zero(F.lit(1), F.lit(0)).alias("zero"),
            qualified_name(F.lit("T"), "DB.RAW.").alias("added"),
            qualified_name(F.lit("DB.RAW.T"), "DB.RAW.").alias("kept"),
        )
        .first()
    )
    assert tuple(row) == (1, "2024-01-01 23:00:00", "abc...", "abcdef", 0.0, "DB.RAW.T", "DB.RAW.T")
