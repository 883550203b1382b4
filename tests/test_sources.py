import os
import random
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.plans import evaluation
from storelens.plans.responses import WAREHOUSE_TABLES
from storelens.session import durable, remove, scratch_path, shared_dir
from storelens.sources import csvload, jsonio, warehouse
from storelens.sources.retail_schemas import RETAIL_FILES, TableFile
from storelens.streaming import csv_ledger

TRANSLATION = "name string, english string"


def write(path, text):
    path.write_bytes(text.encode("utf-8"))


@pytest.fixture
def folder(tmp_path_factory):
    tmp_path = tmp_path_factory.mktemp("csv")
    # byte order mark, CRLF, doubled quotes, quoted comma and line end, no final newline
    write(tmp_path / "a_translation.csv", '﻿name,english\r\nbeleza,health\r\n"um ""dois""","one, two"\r\nfim,end')
    write(tmp_path / "b_translation.csv", "name,english\nlong,x,extra\nshort\nok,fine\n")
    write(tmp_path / "c_numbers.csv", "id,price,at\n1,2.50,2020-01-02 03:04:05\nx,1.00,2020-01-01 00:00:00\n3,,\n")
    return tmp_path


def test_csv_load_keeps_good_and_bad_rows(spark, folder, tmp_path):
    target = str(tmp_path / "out")
    for _ in range(2):  # loading twice equals loading once
        loaded = csvload.load_csv(spark, str(folder), TRANSLATION, target, "*_translation.csv")
    rows = {(r.name, r.english) for r in loaded.rows.collect()}
    assert rows == {("beleza", "health"), ('um "dois"', "one, two"), ("fim", "end"), ("ok", "fine")}
    assert loaded.rows.count() == 4
    assert {r.line for r in loaded.quarantine.collect()} == {"long,x,extra", "short"}
    report = {os.path.basename(r.file): (r.rows_loaded, r.errors_seen) for r in loaded.report.collect()}
    assert report == {"a_translation.csv": (3, 0), "b_translation.csv": (1, 2)}


def test_csv_types(spark, folder, tmp_path):
    schema = "id int, price decimal(12,2), at timestamp_ntz"
    loaded = csvload.load_csv(spark, str(folder), schema, str(tmp_path / "typed"), "*numbers.csv")
    assert [(r.id, r.price is None, r["at"] is None) for r in loaded.rows.orderBy("id").collect()] == [
        (1, False, False), (3, True, True),
    ]
    assert loaded.quarantine.count() == 1


def test_one_failing_table_does_not_stop_the_others(spark, folder, tmp_path):
    files = (
        TableFile("*_translation.csv", "TRANSLATION", TRANSLATION),
        TableFile("*.csv", "BROKEN", "not a schema !"),
        TableFile("*numbers.csv", "NUMBERS", "id int, price decimal(12,2), at timestamp_ntz"),
    )
    report = csvload.load_all(spark, str(folder), str(tmp_path / "all"), files)
    sums = report.groupBy("table_name").agg(F.sum("rows_loaded").alias("n"), F.count("failure").alias("failed"))
    assert {(r.table_name, r.n, r.failed) for r in sums.collect()} == {
        ("TRANSLATION", 4, 0), ("BROKEN", 0, 1), ("NUMBERS", 2, 0),
    }


def test_retail_files_cover_all_tables():
    assert {item.table for item in RETAIL_FILES} == set(WAREHOUSE_TABLES)
    assert sum(len(item.schema.split(", ")) for item in RETAIL_FILES) == 73
    assert [item.table for item in RETAIL_FILES if item.multi_line] == ["ORDER_REVIEWS"]


def test_line_breaks_inside_fields(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "r.csv", 'name,english\n"one\ntwo, ""three""\n\n",a\nbad\nb,"x\n"\n')
    loaded = csvload.load_csv(spark, str(tmp_path / "in"), TRANSLATION, str(tmp_path / "out"), multi_line=True)
    assert {(r.name, r.english) for r in loaded.rows.collect()} == {('one\ntwo, "three"\n\n', "a"), ("b", "x\n")}
    assert [r.line for r in loaded.quarantine.collect()] == ["bad"]


ODD_CSV = [
    'a,b', '"two\nlines",x', '', '"","q"', 'un"quoted,5" pipe', '"a ""quoted"" word",y', '"open\n\n, still ""open""\nend","z\n"',
    'only one', 'one,two,three', '"x"tail,y', ',', '"last\r\none",w', '"é\n""",ü', 'p,"', '",q"',
]


@pytest.mark.parametrize("range_bytes", [60, 1 << 20])
def test_one_file_with_line_breaks_is_read_by_many_tasks(spark, tmp_path, range_bytes):
    """Whatever the borders of the ranges, the rows are those of the one-task reader."""
    rng = random.Random(3)
    (tmp_path / "in").mkdir()
    for name, records in (("a", ODD_CSV), ("b", [rng.choice(ODD_CSV[:-2]) for _ in range(300)]), ("c", ["h,i"])):
        write(tmp_path / "in" / f"{name}.csv", "name,english\n" + "\n".join(records) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        loaded = csvload.load_csv(spark, str(tmp_path / "in"), TRANSLATION, str(tmp_path / "out"), multi_line=True)
        ranges = spark.read.text(str(tmp_path / "in" / "b.csv")).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert ranges > 8 or range_bytes > 100
    fields = csvload.with_bad_column(T.StructType.fromDDL(TRANSLATION))
    alone = spark.read.schema(fields).options(**csvload.parse_options(True, True)).csv(str(tmp_path / "in")).collect()
    assert Counter((r.name, r.english) for r in loaded.rows.collect()) == Counter((r.name, r.english) for r in alone if r[csvload.BAD] is None)
    assert Counter(r.line for r in loaded.quarantine.collect()) == Counter(r[csvload.BAD] for r in alone if r[csvload.BAD] is not None)


@pytest.mark.parametrize("range_bytes", [150, 1 << 20])
def test_one_array_is_read_by_many_tasks(spark, tmp_path, range_bytes):
    rng = random.Random(4)
    odd = ["plain", 'a "quoted" } text', "}{][", "\\", '\\"', "\n\t}", "", "é}ü", "x" * 90, '{"id": 5}']
    records = [{"id": i, "text": rng.choice(odd), "more": rng.choice([[], [{"a": "}]"}], {"b": {"c": [1]}}])} for i in range(150)]
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "flat.json", json.dumps(records[:60], ensure_ascii=False))
    write(tmp_path / "in" / "wide.json", json.dumps(records[60:100], indent=3) + "\n")
    write(tmp_path / "in" / "mixed.json", " [1, \"a{\", " + ", ".join(json.dumps(r) for r in records[100:140]) + ', {"text": "no id"}, null ]')
    write(tmp_path / "in" / "one.json", json.dumps(records[140]))
    write(tmp_path / "in" / "cut.json", json.dumps(records[141:145])[:-30])
    write(tmp_path / "in" / "none.json", "[]")
    write(tmp_path / "in" / "empty.json", "")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = jsonio.read_records(spark, str(tmp_path / "in"), "id long, text string", "id").collect()
        ranges = spark.read.option("lineSep", "}").text(str(tmp_path / "in" / "flat.json")).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert ranges > 8 or range_bytes > 1000
    assert sorted((r.id, r.text) for r in read) == [(r["id"], r["text"]) for r in records[:144]]


def test_files_of_one_name_are_reported_apart(spark, tmp_path):
    for folder in ("x", "y"):
        (tmp_path / "in" / folder).mkdir(parents=True)
        write(tmp_path / "in" / folder / "same.csv", "name,english\na,b\n")
    loaded = csvload.load_csv(spark, str(tmp_path / "in"), TRANSLATION, str(tmp_path / "out"), recursive=True)
    assert sorted(r.rows_loaded for r in loaded.report.collect()) == [1, 1]


def test_a_failed_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    stored = warehouse.replace_table(spark.range(5), path)
    with pytest.raises(Exception):
        warehouse.replace_table(spark.range(9).select(F.raise_error(F.lit("no")).alias("id")), path)
    assert spark.read.parquet(path).count() == 5
    grown = warehouse.replace_table(stored.union(spark.range(2)), path)  # reads what it replaces
    assert grown.count() == 7
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_failed_swap_is_taken_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    warehouse.replace_table(spark.range(5), path)
    real = warehouse._renamed
    monkeypatch.setattr(
        warehouse, "_renamed", lambda store, a, b: False if a.getName().endswith("-new") else real(store, a, b))
    with pytest.raises(OSError):
        warehouse.replace_table(spark.range(9), path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_versions_change_in_one_step(spark, tmp_path, monkeypatch):
    folder, name = str(tmp_path / "versions"), "versions_of_a_table"
    try:
        warehouse.replace_versioned(spark.range(5), name, folder)
        warehouse.replace_versioned(spark.range(7), name, folder)
        begun = spark.table(name)
        warehouse.replace_versioned(begun.union(spark.range(2)), name, folder)  # reads what it replaces
        assert spark.table(name).count() == 9 and len(list(tmp_path.glob("versions/v*"))) == 2

        def broken(*_):
            raise OSError("no catalog")

        with monkeypatch.context() as at_commit:
            at_commit.setattr(warehouse, "_point", broken)
            with pytest.raises(OSError):
                warehouse.replace_versioned(spark.range(1), name, folder)
        with pytest.raises(Exception):
            warehouse.replace_versioned(spark.range(9).select(F.raise_error(F.lit("no")).cast("long").alias("id")), name, folder)
        with pytest.raises(ValueError):
            warehouse.replace_versioned(spark.range(1).selectExpr("id AS other"), name, folder)
        assert spark.table(name).count() == 9 and len(list(tmp_path.glob("versions/v*"))) == 2
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_ledger_loads_each_file_once(spark, folder, tmp_path):
    source, target, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "checkpoint")
    source.mkdir()
    write(source / "1.csv", "name,english\na,b\nbad\n")
    for _ in range(2):
        loaded = csv_ledger.load_new_files(spark, str(source), TRANSLATION, target, checkpoint)
        assert loaded.rows.count() == 1
    write(source / "2.csv", "name,english\nc,d\n")
    loaded = csv_ledger.load_new_files(spark, str(source), TRANSLATION, target, checkpoint)
    assert {r.name for r in loaded.rows.collect()} == {"a", "c"}
    assert loaded.quarantine.count() == 1


def test_json_array_source(spark, tmp_path):
    path = tmp_path / "golden.json"
    path.write_text(json.dumps([{"id": 1, "question": "q1", "verified": False}, {"id": 2, "question": "q2"}], indent=2))
    schema = "id int, question string, verified boolean"
    rows = jsonio.read_records(spark, str(path), schema, "question").orderBy("id").collect()
    assert [(r.id, r.question, r.verified) for r in rows] == [(1, "q1", False), (2, "q2", None)]
    (tmp_path / "object.json").write_text('{"other": 1}')
    assert jsonio.read_records(spark, str(tmp_path / "object.json"), schema, "question").count() == 0


def test_report_sink(spark, tmp_path):
    results = spark.createDataFrame(
        [(1, "q", "easy", True, 1.5, "s", None), (2, "r", "hard", False, 0.5, "s" * 300, "e")],
        "id int, question string, difficulty string, success boolean, latency double, sql string, error string",
    )
    path = str(tmp_path / "report")
    jsonio.write_report(evaluation.metrics(results), evaluation.failed_queries(results), path)
    report = json.loads(spark.read.text(f"{path}/summary").first().value)
    assert report["metadata"]["total_questions"] == 2
    assert {m["difficulty"]: m["accuracy"] for m in report["metrics"]} == {"all": 50.0, "easy": 100.0, "hard": 0.0}
    detail = spark.read.json(f"{path}/details").first()
    assert len(detail.generated_sql) == 300 and len(detail.short_sql) == 203


def test_replace_append_and_audit(spark, tmp_path):
    df = spark.range(5)
    path = str(tmp_path / "t")
    warehouse.replace_table(df, path)
    assert warehouse.replace_table(df, path).count() == 5
    assert warehouse.append_rows(df, path).count() == 10
    audit = warehouse.row_count_audit({"a": df, "b": spark.range(0)})
    assert {(r.table_name, r.row_count) for r in audit.collect()} == {("a", 5), ("b", 0), ("TOTAL", 5)}


def test_catalog_and_profile(spark):
    df = spark.createDataFrame(
        [(1, "x", [1]), (2, "x", [2]), (10, None, None), (2, "y", [3])], "n int, t string, skipped array<int>"
    )
    catalog = warehouse.columns_per_table(warehouse.column_catalog(spark, {"T": df}))
    assert [c.column_name for c in catalog.first().columns] == ["n", "t", "skipped"]
    profile = {r.column_name: r for r in warehouse.column_profile(df, k=2).collect()}
    assert set(profile) == {"n", "t"}
    assert (profile["n"].non_null, profile["n"].distinct_values, profile["n"].max_number) == (4, 3, 10.0)
    assert profile["n"].sample_values == "2, 1"
    assert (profile["t"].row_count, profile["t"].non_null, profile["t"].min_text, profile["t"].sample_values) == (4, 3, "x", "x, y")


def test_profile_orders_equally_frequent_values_by_the_value(spark):
    long_a, long_b = "a" * 64, "b" * 65
    df = spark.createDataFrame([(long_b,), (long_a,), ("c",)], "t string")
    assert warehouse.column_profile(df, k=2).first().sample_values == f"{long_a}, {long_b}"


class _Session:
    """Only what the folder choice looks at."""

    def __init__(self, configured=None):
        self.conf = {"spark.sql.warehouse.dir": "hdfs:///warehouse/"}
        self.conf |= {"spark.checkpoint.dir": configured} if configured else {}


def test_shared_folder_follows_the_setting():
    assert shared_dir(_Session("hdfs:///shared/")) == "hdfs:///shared"
    assert shared_dir(_Session()) == "hdfs:///warehouse"


def test_scratch_tables_can_be_removed(spark, tmp_path):
    kept = durable(spark.range(3))
    other = scratch_path(spark, "other")
    spark.range(2).write.parquet(other)
    assert kept.count() == 3 and os.path.isdir(other.removeprefix("file:"))
    remove(spark, other)
    assert not os.path.exists(other.removeprefix("file:"))


def test_profile_holds_one_column_a_task(spark, tmp_path):
    """Cells are neither copied next to each other nor sorted to be counted."""
    spark.range(100).selectExpr("id AS a", "concat('v', id % 7) AS b", "if(id % 2 = 0, 'x', null) AS c").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    profile = warehouse.column_profile(df)
    plan = profile._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Generate explode") == 1 and "sha2" not in plan  # the facts, a row per column
    assert [(r.column_name, r.distinct_values, r.sample_values) for r in profile.orderBy("ordinal").collect()] == [
        ("a", 100, "0, 1, 10"), ("b", 7, "v0, v1, v2"), ("c", 1, "x"),
    ]


def test_files_with_line_breaks_are_written_by_the_tasks_that_read(spark, tmp_path, sf_dir, monkeypatch):
    """The number of files follows the table, so no task is handed a fixed share of it."""
    from storelens.catalog import io

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    documents.repartition(7).write.parquet(str(tmp_path / "documents.parquet"))
    files, load = [], csvload.load_csv

    def counted(spark, path, *rest, **more):
        files.append(len([f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".csv")]))
        return load(spark, path, *rest, **more)

    monkeypatch.setattr(csvload, "load_csv", counted)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = io._csv_multiline(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert files[0] >= 7 and rows.count() == documents.count()
