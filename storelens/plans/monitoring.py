"""Step traces and the monitoring view over the query log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.functions.scalars import clock_text, ellipsis, ratio_or_zero
from storelens.operators.ranking import number_rows

UNKNOWN_AGENT = "Unknown"
BUCKET_SECONDS = 600
CHUNK_ROWS = 100_000
PAGE_ROWS = 1000


def _millis(start: Column, end: Column) -> Column:
    """Whole milliseconds between two timestamps without zone."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.floor(micros / 1000).cast("long")


def _bucket(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / seconds)


def trace_steps(marks: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Step records from marks (query_id, mark_id, ts, kind, agent, status).

    Each 'end' closes the 'start' right before it; a start replaces an open
    start, and an end without one gives 0 ms and an unknown agent.  So a mark
    needs only the mark before it.

    The marks are sorted over all tasks and numbered, and ``chunk_rows`` consecutive ones
    make a chunk, whatever queries they belong to.  Inside a chunk the mark before is
    looked up in order; the first mark of a chunk is handed the last one of the chunk
    before.  A query with very many marks, at one moment even, is thereby spread over many
    tasks.  Marks without a query or a time are left out (``rejected_marks``).
    """
    timed = marks.filter(F.col("query_id").isNotNull() & F.col("ts").isNotNull())
    chunk = F.floor((F.col("_number") - 1) / chunk_rows)
    placed = number_rows(timed, ["query_id", "ts", "mark_id"], "_number").withColumn("_chunk", chunk)
    mark = F.struct("query_id", "ts", "kind", "agent")
    # One row per chunk: its last mark, for the chunk that follows.
    lasts = placed.filter(F.col("_number") % chunk_rows == 0).select(
        (F.col("_chunk") + 1).alias("_next"), mark.alias("_carry")
    )
    in_chunk = F.lag(mark).over(Window.partitionBy("_chunk").orderBy("_number"))
    paired = placed.withColumn("_in_chunk", in_chunk).join(lasts, F.col("_chunk") == F.col("_next"), "left")
    before = F.coalesce("_in_chunk", "_carry")
    opened = (before["query_id"] == F.col("query_id")) & (before["kind"] == "start")
    opened = F.coalesce(opened, F.lit(False))
    return paired.filter(F.col("kind") == "end").select(
        "query_id",
        "mark_id",
        "ts",
        F.when(opened, before["agent"]).otherwise(F.lit(UNKNOWN_AGENT)).alias("agent"),
        "status",
        F.when(opened, _millis(before["ts"], F.col("ts"))).otherwise(F.lit(0)).cast("long").alias("duration_ms"),
    )


def rejected_marks(marks: DataFrame) -> DataFrame:
    """The marks that belong to no trace, with the reason."""
    reason = F.when(F.col("query_id").isNull(), "no query").when(F.col("ts").isNull(), "no time")
    return marks.withColumn("reason", reason).filter("reason IS NOT NULL")


def trace_records(marks: DataFrame, answers: DataFrame, step_rows: int = PAGE_ROWS) -> DataFrame:
    """One record per query: question, first mark, its steps in order, total time, final
    statement, rows, success and error.

    answers: query_id, question, final_sql, row_count, error.  ``steps`` holds the first
    ``step_rows`` steps and ``step_count`` their true number; ``step_pages`` has them all.
    A query without an answer has nulls in its fields.
    """
    steps = trace_steps(marks)
    first = Window.partitionBy("query_id").orderBy("ts", "mark_id")
    listed = (
        steps.withColumn("place", F.row_number().over(first))
        .filter(F.col("place") <= step_rows)
        .groupBy("query_id")
        .agg(F.sort_array(F.collect_list(F.struct("place", "agent", "status", "duration_ms"))).alias("_steps"))
    )
    no_steps = F.array().cast("array<struct<agent:string,status:string,duration_ms:bigint>>")
    return (
        _totals(marks)
        .join(listed, "query_id", "left")
        .join(answers.select("query_id", "question", "final_sql", "row_count", "error"), "query_id", "left")
        .withColumn(
            "steps",
            F.coalesce(
                F.transform("_steps", lambda s: F.struct(
                    s["agent"].alias("agent"), s["status"].alias("status"), s["duration_ms"].alias("duration_ms")
                )),
                no_steps,
            ),
        )
        .drop("_steps")
    )


def _totals(marks: DataFrame) -> DataFrame:
    ended = F.col("kind") == "end"
    known = marks.filter("query_id IS NOT NULL AND ts IS NOT NULL")
    return known.groupBy("query_id").agg(
        F.min("ts").alias("started"),
        F.count_if(ended).alias("step_count"),
        _millis(F.min("ts"), F.max("ts")).alias("total_duration_ms"),
        (F.count_if(ended & (F.col("status") == "error")) == 0).alias("success"),
    )


def step_pages(steps: DataFrame, page_rows: int = PAGE_ROWS, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Steps nested per query, in order, in pages of at most ``page_rows``, so
    that no list grows with the data: (query_id, bucket, page, steps)."""
    sliced = steps.withColumn("bucket", _bucket(F.col("ts"), bucket_seconds))
    place = F.row_number().over(Window.partitionBy("query_id", "bucket").orderBy("ts", "mark_id"))
    return (
        sliced.withColumn("place", place)
        .withColumn("page", F.floor((F.col("place") - 1) / page_rows))
        .groupBy("query_id", "bucket", "page")
        .agg(F.sort_array(F.collect_list(F.struct("place", "agent", "status", "duration_ms"))).alias("steps"))
    )


# -- query log: query_id, question, ts, steps, total_duration_ms, row_count, success


def _retries(steps: Column) -> Column:
    """Validator steps whose detail tells of retries."""
    return F.size(
        F.filter(steps, lambda s: (s["agent"] == "Validator") & F.lower(s["detail"]).contains("retries"))
    )


def summary(log: DataFrame) -> DataFrame:
    return log.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("success")).alias("_ok"),
        F.sum("total_duration_ms").alias("_ms"),
        F.coalesce(F.sum(_retries(F.col("steps"))), F.lit(0)).alias("retries"),
    ).select(
        "total",
        (ratio_or_zero(F.col("_ok"), F.col("total")) * 100).alias("success_rate"),
        ratio_or_zero(F.col("_ms"), F.col("total")).alias("avg_latency"),
        "retries",
    )


def _status(success: Column) -> Column:
    return F.when(success, "Success").otherwise("Error")


def history(log: DataFrame) -> DataFrame:
    return log.select(
        "query_id",
        clock_text(F.col("ts")).alias("time"),
        "question",
        ellipsis(F.col("question"), 60).alias("short_question"),
        _status(F.col("success")).alias("status"),
        F.col("total_duration_ms").alias("latency_ms"),
        F.coalesce("row_count", F.lit(0)).alias("rows"),
    )


def labelled(log: DataFrame) -> DataFrame:
    """The log with its running labels Q1, Q2, .. in time order."""
    numbered = number_rows(log, ["ts", "query_id"], "_n")
    return numbered.withColumn("label", F.concat(F.lit("Q"), F.col("_n").cast("string"))).drop("_n")


def latency_series(log: DataFrame) -> DataFrame:
    wanted = log.select("ts", "query_id", "total_duration_ms", "success")
    return labelled(wanted).select(
        "label", F.col("total_duration_ms").alias("latency_ms"), _status(F.col("success")).alias("status")
    )


def step_breakdown(log: DataFrame) -> DataFrame:
    """Time per query label and agent."""
    steps = labelled(log.select("ts", "query_id", "steps")).select("label", F.explode("steps").alias("step"))
    return steps.groupBy("label", F.col("step.agent").alias("agent")).agg(
        F.sum("step.duration_ms").alias("duration_ms")
    )
