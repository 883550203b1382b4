"""Registered loads, table maintenance and streams.

Files are written to new folders under the shared scratch folder first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.catalog.entry import Entry, with_ctes
from storelens.catalog.logs import CTES, STEPS_SQL
from storelens.plans import evaluation
from storelens.session import scratch_path
from storelens.sources import csvload, jsonio, warehouse
from storelens.sources.retail_schemas import TableFile
from storelens.sources.tables import TABLES, table
from storelens.streaming import csv_ledger, monitor
from storelens.streaming.sources import closable, close, run_available, stream_table

CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_acctbal decimal(12,2), c_mktsegment string"
EVENT_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double, props string"

# A customer line has a column too many, or text in a number column.
EXTRA_COLUMN = "c_custkey % 50 = 7"
NOT_A_NUMBER = "c_custkey % 77 = 3"
GOOD = f"NOT ({EXTRA_COLUMN}) AND NOT ({NOT_A_NUMBER})"


def _write_customers(spark, sf_dir) -> str:
    """Customers as delimited files with a header, some lines broken."""
    path = scratch_path(spark, "customers-csv")
    name = f"CASE WHEN {EXTRA_COLUMN} THEN concat(c_name, ',extra') ELSE c_name END AS c_name"
    balance = f"CASE WHEN {NOT_A_NUMBER} THEN 'n/a' ELSE cast(cast(c_acctbal AS decimal(12,2)) AS string) END AS c_acctbal"
    lines = table(spark, sf_dir, "customer").selectExpr("c_custkey", name, balance, "c_mktsegment")
    # Without quoting, a comma in a value makes a further column.
    lines.write.option("header", True).option("quote", "\u0000").csv(path)
    return path


def _load_customers(spark, sf_dir) -> csvload.Loaded:
    path = _write_customers(spark, sf_dir)
    return csvload.load_csv(spark, path, CUSTOMER_SCHEMA, scratch_path(spark, "customers"), "*.csv")


def _load_report(spark, sf_dir) -> DataFrame:
    return _load_customers(spark, sf_dir).report.agg(
        F.sum("rows_loaded").alias("rows_loaded"), F.sum("errors_seen").alias("errors_seen")
    )


def _load_report_per_file(spark, sf_dir) -> DataFrame:
    """Customers in a folder per segment, and a table that cannot be loaded."""
    path = scratch_path(spark, "customers-by-segment")
    lines = table(spark, sf_dir, "customer").select(
        "c_custkey", F.expr("CASE WHEN c_custkey % 77 = 3 THEN 'n/a' ELSE '1.5' END").alias("c_acctbal"), "c_mktsegment"
    )
    lines.repartition("c_mktsegment").write.partitionBy("c_mktsegment").option("header", True).csv(path)
    files = (
        TableFile("*.csv", "CUSTOMER", "c_custkey bigint, c_acctbal decimal(12,2)"),
        TableFile("*.csv", "BROKEN", "no schema !"),
    )
    report = csvload.load_all(spark, path, scratch_path(spark, "loaded"), files, recursive=True)
    return report.select(
        "table_name", F.nullif(F.regexp_extract("file", "c_mktsegment=([^/]*)/", 1), F.lit("")).alias("segment"),
        "rows_loaded", "errors_seen", F.col("failure").isNotNull().alias("failed"),
    )


DOCUMENT_LINES = """concat('"', lang, '", "', source, '"', chr(10), text, chr(10), chr(10), '", ""', chr(10))"""


def _csv_multiline(spark, sf_dir) -> DataFrame:
    """Texts with line breaks, commas and quotes through delimited files."""
    path = scratch_path(spark, "documents-csv")
    texts = table(spark, sf_dir, "documents").select("doc_id", F.expr(DOCUMENT_LINES).alias("text"), "lang")
    plain = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    # a file for each task that reads the table, so none of them grows with it
    texts.write.options(**plain).csv(path)
    loaded = csvload.load_csv(
        spark, path, "doc_id bigint, text string, lang string", scratch_path(spark, "documents"), "*.csv", multi_line=True
    )
    good = loaded.rows.select("doc_id", F.md5("text").alias("text_md5"), "lang")
    return good.unionByName(loaded.quarantine.select(F.lit(None).cast("long").alias("doc_id"), F.col("line").alias("text_md5"), F.col("file").alias("lang")))


def _json_array(spark, sf_dir) -> DataFrame:
    """Files with one array of records each, as curated question sets come."""
    path = scratch_path(spark, "records-json")
    rows = table(spark, sf_dir, "benchmark").select(
        F.floor(F.col("item_id") / 100).alias("page"),
        F.to_json(F.struct(F.col("item_id").alias("id"), F.col("text").alias("question"), (F.col("item_id") % 2 == 0).alias("verified"))).alias("r")
    )
    arrays = rows.groupBy("page").agg(F.concat(F.lit("["), F.array_join(F.collect_list("r"), ",\n"), F.lit("]")).alias("value"))
    arrays.repartition("page").write.partitionBy("page").text(path)
    return jsonio.read_records(spark, path, "id bigint, question string, verified boolean", "question")


def _by_segment(rows: DataFrame) -> DataFrame:
    return rows.groupBy("c_mktsegment").agg(
        F.count("*").alias("customers"), F.sum("c_acctbal").cast("double").alias("balance")
    )


BY_SEGMENT_SQL = f"""SELECT c_mktsegment, COUNT(*) AS customers,
        CAST(SUM(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS balance
    FROM customer WHERE {GOOD} GROUP BY c_mktsegment"""


def _quarantined(spark, sf_dir) -> DataFrame:
    return _load_customers(spark, sf_dir).quarantine.select(
        F.split("line", ",")[0].cast("long").alias("c_custkey"), F.size(F.split("line", ",")).alias("columns")
    )


def _stream_customers(spark, sf_dir) -> DataFrame:
    """Two calls over the same folder; the second finds nothing new."""
    path = _write_customers(spark, sf_dir)
    target, checkpoint = scratch_path(spark, "ledger"), scratch_path(spark, "ledger-checkpoint")
    csv_ledger.load_new_files(spark, path, CUSTOMER_SCHEMA, target, checkpoint)
    return _by_segment(csv_ledger.load_new_files(spark, path, CUSTOMER_SCHEMA, target, checkpoint).rows)


def _overwrite_twice(spark, sf_dir) -> DataFrame:
    """Replaced twice, appended once: every order is there two times."""
    statuses = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = scratch_path(spark, "orders")
    warehouse.replace_table(statuses, path)
    warehouse.replace_table(statuses, path)
    return (
        warehouse.append_rows(statuses, path)
        .groupBy("o_orderstatus")
        .agg(F.count("*").alias("rows"), F.countDistinct("o_orderkey").alias("orders"))
    )


def _versioned_twice(spark, sf_dir) -> DataFrame:
    """A catalog table pointed at a first and a second version; what it shows then."""
    path = scratch_path(spark, "orders-versions")
    name = f"orders_{path[-32:]}"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    try:
        warehouse.replace_versioned(orders.filter("o_orderkey % 2 = 0"), name, path)
        warehouse.replace_versioned(orders, name, path)
        where = warehouse.table_location(spark, name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the versions go with the scratch folder
    return spark.read.schema(orders.schema).parquet(where).groupBy("o_orderstatus").agg(F.count("*").alias("rows"))


def _json_round_trip(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "events-json")
    jsonio.write_lines(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props"), path)
    return jsonio.read_lines(spark, path, EVENT_SCHEMA)


def _report_round_trip(spark, sf_dir) -> DataFrame:
    """Metrics and failed rows through the report sink; counts of what is read."""
    results = spark.sql(CTES["w_results"].replace("FROM events", "FROM {events}"), events=table(spark, sf_dir, "events"))
    path = scratch_path(spark, "report")
    jsonio.write_report(evaluation.metrics(results), evaluation.failed_queries(results), path)
    details = spark.read.schema("id long, difficulty string").json(f"{path}/details")
    total = spark.read.text(f"{path}/summary").select(
        F.lit("all").alias("difficulty"),
        F.get_json_object("value", "$.metadata.total_questions").cast("long").alias("rows"),
    )
    return details.groupBy("difficulty").agg(F.count("*").alias("rows")).unionByName(total)


def _profile(name: str):
    return lambda spark, sf_dir: warehouse.column_profile(table(spark, sf_dir, name))


def _profile_sql(name: str, columns: tuple[tuple[str, str], ...]) -> str:
    """The profile of ``columns`` (name, type), one SELECT per column."""
    numeric = ("int", "bigint", "double")
    parts = []
    for ordinal, (column, data_type) in enumerate(columns, 1):
        number = f"CAST({column} AS DOUBLE)" if data_type in numeric else "CAST(NULL AS DOUBLE)"
        text = "CAST(NULL AS VARCHAR)" if data_type in numeric else f"CAST({column} AS VARCHAR)"
        parts.append(
            f"""SELECT {ordinal} AS ordinal, '{column}' AS column_name, '{data_type}' AS data_type, COUNT(*) AS row_count,
                COUNT({column}) AS non_null, COUNT(DISTINCT {column}) AS distinct_values,
                MIN({number}) AS min_number, MAX({number}) AS max_number, MIN({text}) AS min_text, MAX({text}) AS max_text,
                (SELECT string_agg(v, ', ' ORDER BY n DESC, v) FROM (
                    SELECT CAST({column} AS VARCHAR) AS v, COUNT(*) AS n FROM {name} WHERE {column} IS NOT NULL GROUP BY 1
                    ORDER BY n DESC, v LIMIT 3)) AS sample_values
                FROM {name}"""
        )
    return " UNION ALL ".join(parts)


def _stream_results(spark, sf_dir) -> DataFrame:
    return stream_table(spark, sf_dir, "events").select(
        "ts", (F.col("event_type") != "error").alias("success"), F.col("value").alias("latency")
    )


def _run_and_close(stream: DataFrame, folder: str, result: DataFrame, out: str, checkpoint: str) -> None:
    for closing in (False, True):
        if closing:
            close(stream, folder)
        run_available(result.writeStream.format("parquet").outputMode("append").option("path", out), checkpoint)


def _stream_monitor(spark, sf_dir) -> DataFrame:
    out = scratch_path(spark, "hourly")
    folder = scratch_path(spark, "closing")
    results = closable(_stream_results(spark, sf_dir), folder)
    hourly = monitor.hourly_summary(results)
    _run_and_close(results, folder, hourly, out, scratch_path(spark, "hourly-checkpoint"))
    return spark.read.schema(hourly.schema).parquet(out).select(
        F.col("window_start").cast("timestamp_ntz"), F.col("window_end").cast("timestamp_ntz"),
        "total", "success_rate", "avg_latency",
    )


def _stream_late(spark, sf_dir) -> DataFrame:
    """The log in two runs, the second one of users whose rows are behind by then: rows
    counted and rows rejected per hour."""
    path, folder, checkpoint = (scratch_path(spark, f"late-{name}") for name in ("in", "out", "checkpoint"))
    log = table(spark, sf_dir, "events").select(
        "ts", (F.col("event_type") != "error").alias("success"), F.col("value").alias("latency"), "user_id"
    )
    for user in (0, 1):
        log.filter(F.col("user_id") % 2 == user).write.mode("append").parquet(path)
        stream = spark.readStream.schema(log.schema).parquet(path)
        run_available(stream.writeStream.foreachBatch(lambda batch, n: monitor.add_totals(batch, n, folder)), checkpoint)
    counted = monitor.totals(spark, folder).select(F.col("window_start").cast("timestamp_ntz"), "total", F.lit(0).alias("late"))
    behind = monitor.rejects(spark, folder, log.schema.toDDL()).groupBy(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start")
    ).agg(F.lit(0).alias("total"), F.count("*").alias("late"))
    return counted.unionByName(behind).groupBy("window_start").agg(F.sum("total").alias("total"), F.sum("late").alias("late"))


def _stream_steps(spark, sf_dir) -> DataFrame:
    # A micro-batch bounds what one query can bring into one task.
    marks = stream_table(spark, sf_dir, "events", bytes_per_trigger=256 << 20).filter(F.col("event_type").isin("view", "purchase")).select(
        F.col("user_id").alias("query_id"),
        F.col("event_id").alias("mark_id"),
        "ts",
        F.when(F.col("event_type") == "view", "start").otherwise("end").alias("kind"),
        F.concat(F.lit("agent "), (F.col("event_id") % 3).cast("string")).alias("agent"),
        F.when(F.col("value") > 45, "error").otherwise("success").alias("status"),
    )
    out = scratch_path(spark, "steps")
    folder = scratch_path(spark, "closing")
    marks = closable(marks, folder)
    # The closing row needs a query of its own, or it would be left out as a bad mark.
    steps = monitor.streamed_steps(marks.withColumn("query_id", F.coalesce("query_id", F.lit(-1).cast("long"))))
    _run_and_close(marks, folder, steps, out, scratch_path(spark, "steps-checkpoint"))
    return spark.read.schema(steps.schema).parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


ENTRIES: dict[str, Entry] = {
    "row_count_audit": Entry(
        lambda s, d: warehouse.row_count_audit({name: table(s, d, name) for name in TABLES}),
        f"""SELECT coalesce(name, 'TOTAL') AS table_name, CAST(SUM(n) AS BIGINT) AS row_count
            FROM ({" UNION ALL ".join(f"SELECT '{t}' AS name, COUNT(*) AS n FROM {t}" for t in TABLES)})
            GROUP BY ROLLUP (name)""",
    ),
    "csv_load_report": Entry(
        _load_report,
        f"""SELECT COUNT(*) FILTER ({GOOD}) AS rows_loaded, COUNT(*) FILTER (NOT ({GOOD})) AS errors_seen
            FROM customer""",
    ),
    "load_report_per_file": Entry(
        _load_report_per_file,
        """SELECT 'CUSTOMER' AS table_name, c_mktsegment AS segment, COUNT(*) FILTER (c_custkey % 77 <> 3) AS rows_loaded,
                  COUNT(*) FILTER (c_custkey % 77 = 3) AS errors_seen, false AS failed
           FROM customer GROUP BY c_mktsegment
           UNION ALL SELECT 'BROKEN', NULL, 0, 0, true""",
    ),
    "csv_multiline": Entry(
        _csv_multiline, f"SELECT doc_id, md5({DOCUMENT_LINES}) AS text_md5, lang FROM documents"
    ),
    "json_array_records": Entry(
        _json_array, "SELECT item_id AS id, text AS question, item_id % 2 = 0 AS verified FROM benchmark"
    ),
    "column_catalog": Entry(
        lambda s, d: warehouse.column_catalog(s, {name: table(s, d, name) for name in ("customer", "documents")}),
        """SELECT table_name, column_name,
                  CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                                 ELSE 'string' END AS data_type,
                  ordinal_position AS ordinal
           FROM information_schema.columns WHERE table_name IN ('customer', 'documents')""",
    ),
    "csv_loaded_rows": Entry(lambda s, d: _by_segment(_load_customers(s, d).rows), BY_SEGMENT_SQL),
    "csv_quarantine": Entry(
        _quarantined,
        f"""SELECT c_custkey, CASE WHEN {EXTRA_COLUMN} THEN 5 ELSE 4 END AS columns FROM customer
            WHERE NOT ({GOOD})""",
    ),
    "overwrite_twice": Entry(
        _overwrite_twice,
        """SELECT o_orderstatus, 2 * COUNT(*) AS rows, COUNT(DISTINCT o_orderkey) AS orders
           FROM orders GROUP BY o_orderstatus""",
    ),
    "versioned_twice": Entry(
        _versioned_twice, "SELECT o_orderstatus, COUNT(*) AS rows FROM orders GROUP BY o_orderstatus"
    ),
    "json_round_trip": Entry(
        _json_round_trip, "SELECT event_id, user_id, event_type, value, props FROM events"
    ),
    "report_round_trip": Entry(
        _report_round_trip,
        with_ctes(
            """SELECT difficulty, COUNT(*) AS rows FROM w_results WHERE NOT success GROUP BY difficulty
               UNION ALL SELECT 'all', COUNT(*) FROM w_results""",
            CTES,
        ),
    ),
    "column_profile": Entry(
        _profile("customer"),
        _profile_sql(
            "customer",
            (("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
             ("c_mktsegment", "string")),
        ),
    ),
    "column_profile_documents": Entry(
        _profile("documents"),
        _profile_sql(
            "documents",
            (("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")),
        ),
    ),
    "stream_csv": Entry(_stream_customers, BY_SEGMENT_SQL),
    "stream_late_rows": Entry(
        _stream_late,
        """SELECT date_trunc('hour', ts) AS window_start, COUNT(*) FILTER (NOT late) AS total, COUNT(*) FILTER (late) AS late
           FROM (SELECT ts, user_id % 2 = 1 AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= (
                     SELECT max(ts) - INTERVAL 10 MINUTE FROM events WHERE user_id % 2 = 0) AS late FROM events)
           GROUP BY 1""",
    ),
    "stream_monitor": Entry(
        _stream_monitor,
        """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, total,
                  CAST(ok AS DOUBLE) / total * 100 AS success_rate, latency / total AS avg_latency
           FROM (SELECT date_trunc('hour', ts) AS window_start, COUNT(*) AS total,
                        COUNT(*) FILTER (event_type <> 'error') AS ok,
                        CAST(SUM(CAST(value AS DECIMAL(12,3))) AS DOUBLE) AS latency
                 FROM events GROUP BY 1)""",
    ),
    "stream_steps": Entry(_stream_steps, with_ctes(STEPS_SQL, CTES)),
}
