import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from storelens.plans import evaluation, monitoring, presentation
from storelens.streaming import monitor
from storelens.streaming.sources import closable, close, run_available

MARKS = "query_id long, mark_id long, ts timestamp_ntz, kind string, agent string, status string"


def made_marks(n=900):
    """Marks of 12 queries, one of which has a third; ties in time included."""
    rng = random.Random(5)
    at = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        at += timedelta(microseconds=rng.choice([0, 999, 1_000, 2_500_000, 400_000_000]))
        query = 0 if i % 3 == 0 else rng.randrange(12)
        rows.append((query, i, at, rng.choice(["start", "end"]), f"a{rng.randrange(3)}", rng.choice(["success", "error"])))
    return rows


def reference_steps(rows):
    steps, opened = [], {}
    for query, mark, at, kind, agent, status in sorted(rows, key=lambda r: (r[2], r[1])):
        if kind == "start":
            opened[query] = (at, agent)
            continue
        start = opened.pop(query, None)
        millis = (at - start[0]) // timedelta(milliseconds=1) if start else 0
        steps.append((query, mark, start[1] if start else "Unknown", status, millis))
    return sorted(steps)


def as_tuples(df):
    return sorted((r.query_id, r.mark_id, r.agent, r.status, r.duration_ms) for r in df.collect())


@pytest.mark.parametrize("chunk_rows", [1, 7, 10**6])
def test_steps_equal_a_state_machine(spark, chunk_rows):
    rows = made_marks()
    odd = [(None, 5000, rows[0][2], "end", "a", "success"), (3, 5001, None, "end", "a", "success")]
    marks = spark.createDataFrame(rows + odd, MARKS).repartition(5)
    assert as_tuples(monitoring.trace_steps(marks, chunk_rows)) == reference_steps(rows)
    assert {r.mark_id for r in monitoring.rejected_marks(marks).collect()} == {5000, 5001}


def test_marks_of_one_moment_are_spread(spark):
    """All marks belong to one query and one minute; no task takes more than some chunks."""
    at = datetime(2024, 1, 1)
    rows = [(1, i, at + timedelta(microseconds=i % 997), "end" if i % 3 else "start", f"a{i % 5}", "success") for i in range(4000)]
    steps = monitoring.trace_steps(spark.createDataFrame(rows, MARKS).repartition(4), chunk_rows=50)
    assert as_tuples(steps) == reference_steps(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in monitoring.trace_steps(spark.createDataFrame(rows, MARKS), chunk_rows=50)
                 .groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 0.3 * sum(sizes)


def test_pages_hold_every_step_once(spark):
    rows = made_marks()
    steps = monitoring.trace_steps(spark.createDataFrame(rows, MARKS))
    pages = monitoring.step_pages(steps, page_rows=4).collect()
    assert max(len(p.steps) for p in pages) <= 4
    assert sum(len(p.steps) for p in pages) == len(reference_steps(rows))


def test_streamed_steps_equal_batch(spark, tmp_path):
    rows = made_marks()
    marks = spark.createDataFrame(rows, MARKS)
    for part in range(3):  # three files in time order, each its own micro-batch
        chunk = marks.filter(F.col("mark_id").between(part * 300, part * 300 + 299))
        chunk.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert streamed(spark, marks.schema, tmp_path) == reference_steps(rows)


def streamed(spark, schema, tmp_path, lateness="10 minutes"):
    """The steps of the files under ``in``, one file at a time, and then of a closing row."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream = closable(stream, str(tmp_path / "closing"))
    steps = monitor.streamed_steps(stream.withColumn("query_id", F.coalesce("query_id", F.lit(-1).cast("long"))), lateness)
    for closing in (False, True):
        if closing:
            close(stream, str(tmp_path / "closing"))
        run_available(steps.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "checkpoint"))
    return as_tuples(spark.read.parquet(str(tmp_path / "out")))


def test_streamed_steps_of_files_out_of_order(spark, tmp_path):
    at = datetime(2024, 1, 1, 10)
    rows = [
        (1, 1, at, "start", "a", "success"), (1, 2, at + timedelta(minutes=5), "end", "a", "success"),
        (1, 3, at + timedelta(minutes=2), "start", "b", "success"), (2, 4, at, "end", "c", "error"),
        (2, 5, at + timedelta(minutes=8), "start", "d", "success"), (1, 6, at + timedelta(minutes=30), "start", "e", "success"),
        (2, 7, at + timedelta(minutes=31), "end", "d", "success"), (1, 8, at + timedelta(minutes=29), "end", "f", "success"),
    ]
    for part in range(0, 8, 2):
        spark.createDataFrame(rows[part : part + 2], MARKS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    marks = spark.createDataFrame(rows, MARKS)
    assert reference_steps(rows)[0] == (1, 2, "b", "success", 180_000)
    assert as_tuples(monitoring.trace_steps(marks)) == reference_steps(rows)
    assert streamed(spark, marks.schema, tmp_path) == reference_steps(rows)


def test_queries_share_a_state():
    """Their marks mix in one batch, and a start waits for its end in the next one."""
    import pandas as pd

    class State:
        exists, hasTimedOut, get, now = False, False, None, 0

        def update(self, value):
            self.exists, self.get = True, value

        def remove(self):
            self.exists = False

        def getCurrentWatermarkMs(self):
            return self.now

        def setTimeoutTimestamp(self, at):
            self.at = at

    at = [pd.Timestamp(2024, 1, 1, 0, 0, s) for s in range(6)]
    columns = ["query_id", "mark_id", "ts", "kind", "agent", "status"]
    first = pd.DataFrame([
        (8, 4, at[3], "end", "x", "error"), (7, 1, at[0], "start", "a", "success"), (8, 2, at[1], "start", "b", "success"),
        (9, 3, at[2], "end", "c", "success"), (7, 6, at[5], "end", "d", "success"),
    ], columns=columns)
    state, run = State(), monitor._ordered_steps()
    state.now = int(at[4].timestamp() * 1000)
    out = pd.concat(run((0,), iter([first]), state))
    assert [tuple(r) for r in out.drop(columns="ts").itertuples(index=False)] == [
        (8, 4, "b", "error", 2000), (9, 3, monitor.UNKNOWN_AGENT, "success", 0),
    ]
    state.now, state.hasTimedOut = int(at[5].timestamp() * 1000), True
    out = pd.concat(run((0,), iter([]), state))
    assert [tuple(r) for r in out.drop(columns="ts").itertuples(index=False)] == [(7, 6, "a", "success", 5000)]
    assert not state.exists


def test_whole_trace_records(spark):
    at = datetime(2024, 1, 1)
    rows = [(1, 1, at, "start", "a", "success"), (1, 2, at + timedelta(seconds=2), "end", "a", "success"),
            (1, 3, at + timedelta(seconds=3), "end", "b", "error"), (2, 4, at, "start", "c", "success"),
            (None, 5, at, "end", "lost", "success"), (3, 6, None, "end", "lost", "success")]
    marks = spark.createDataFrame(rows, MARKS)
    answers = spark.createDataFrame([(1, "q?", "SELECT 1", 7, "e")], "query_id long, question string, final_sql string, row_count long, error string")
    got = {r.query_id: r for r in monitoring.trace_records(marks, answers).collect()}
    assert set(got) == {1, 2}
    one = got[1]
    assert (one.question, one.final_sql, one.row_count, one.error, one.success) == ("q?", "SELECT 1", 7, "e", False)
    assert [tuple(s) for s in one.steps] == [("a", "success", 2000), ("Unknown", "error", 0)]
    assert (one.step_count, one.total_duration_ms, got[2].steps, got[2].question) == (2, 3000, [], None)
    rejected = {(r.mark_id, r.reason) for r in monitoring.rejected_marks(marks).collect()}
    assert rejected == {(5, "no query"), (6, "no time")}


def test_streamed_totals_equal_batch(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "ts", (F.col("event_type") != "error").alias("success"), F.col("value").alias("latency")
    )
    events.repartitionByRange(3, "ts").sortWithinPartitions("ts").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    writer = monitor.hourly_summary(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
    run_available(writer, str(tmp_path / "checkpoint"))
    streamed = {r.window_start: r.total for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = {r.window_start: r.total for r in monitor.hourly_summary(events).collect()}
    assert set(batch) - set(streamed) == {max(batch)}  # the newest window is still open
    assert all(batch[w] == n for w, n in streamed.items())


def test_late_rows_are_kept_apart(spark, tmp_path):
    """Totals and rejects add up to the input, also when a batch runs twice."""
    at = datetime(2024, 1, 1, 10)
    early = [(at + timedelta(minutes=m), True, 1.0) for m in (0, 5, 70, 200)] + [(None, True, 1.0)]
    later = [(at + timedelta(minutes=m), False, 2.0) for m in (10, 59, 61, 185, 199, 300)]
    schema = "ts timestamp, success boolean, latency double"
    for rows in (early, later):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    folder = str(tmp_path / "out")
    writer = stream.writeStream.foreachBatch(lambda batch, n: [monitor.add_totals(batch, n, folder) for _ in range(2)] and None)
    run_available(writer, str(tmp_path / "checkpoint"))
    counted = {r.window_start: (r.total, r.success_rate, r.avg_latency) for r in monitor.totals(spark, folder).collect()}
    assert counted == {at: (2, 100.0, 1.0), at + timedelta(hours=1): (1, 100.0, 1.0), at + timedelta(hours=3): (3, pytest.approx(100 / 3), pytest.approx(5 / 3)),
                       at + timedelta(hours=5): (1, 0.0, 2.0)}
    apart = sorted((r.reason, r.ts) for r in monitor.rejects(spark, folder, schema).collect() if r.ts)
    assert apart == [("late", at + timedelta(minutes=m)) for m in (10, 59, 61)]
    assert sum(n for n, *_ in counted.values()) + monitor.rejects(spark, folder, schema).count() == len(early) + len(later)


def test_log_views(spark):
    log = spark.sql(
        """SELECT * FROM VALUES
           (1L, timestamp_ntz'2024-01-01 00:00:02.9', repeat('x', 61), true, 5L, 30L),
           (2L, timestamp_ntz'2024-01-01 00:00:01', 'q', false, CAST(NULL AS LONG), 10L)
           AS t(query_id, ts, question, success, row_count, total_duration_ms)"""
    ).withColumn(
        "steps",
        F.expr(
            """array(named_struct('agent', 'Validator', 'status', 'success', 'duration_ms', total_duration_ms,
                     'detail', if(success, '5 rows (after Retries)', 'ok')),
                     named_struct('agent', 'Validator', 'status', 'success', 'duration_ms', 1L, 'detail', 'x'))"""
        ),
    )
    row = monitoring.summary(log).first()
    assert (row.total, row.success_rate, row.avg_latency, row.retries) == (2, 50.0, 20.0, 1)
    history = {r.query_id: r for r in monitoring.history(log).collect()}
    assert history[1].question.startswith("x" * 61) and history[1].short_question == "x" * 60 + "..." and history[1].time == "2024-01-01 00:00:02"
    assert (history[2].status, history[2].rows) == ("Error", 0)
    assert {(r.label, r.latency_ms) for r in monitoring.latency_series(log).collect()} == {("Q1", 10), ("Q2", 30)}
    assert {(r.label, r.agent, r.duration_ms) for r in monitoring.step_breakdown(log).collect()} == {
        ("Q1", "Validator", 11), ("Q2", "Validator", 31),
    }
    assert monitoring.summary(log.filter("false")).first().success_rate == 0.0


RESULTS = "id int, question string, difficulty string, model string, success boolean, latency double, sql string, error string"


def test_metrics_of_nothing(spark):
    rows = evaluation.metrics(spark.createDataFrame([], RESULTS)).collect()
    assert [tuple(r) for r in rows] == [("overall", "all", 0, 0, 0, 0.0, 0.0)]


def test_metrics_leave_out_empty_groups(spark):
    rows = [(1, "q", "easy", "m", True, 2.0, "s", None), (2, "q", "hard", "m", False, 1.0, "s", "e"), (3, "q", "easy", "m", False, 0.0, "s", "e")]
    got = {r.difficulty: (r.total, r.successful, r.failed, r.accuracy, r.average_latency) for r in evaluation.metrics(spark.createDataFrame(rows, RESULTS)).collect()}
    assert got == {"all": (3, 1, 2, 1 / 3 * 100, 1.0), "easy": (2, 1, 1, 50.0, 1.0), "hard": (1, 0, 1, 0.0, 1.0)}


def test_models_side_by_side_and_grid(spark):
    rows = [
        (1, "q" * 60, "easy", "baseline", False, 1.0, "s", "e"),
        (2, "q" * 60, "easy", "baseline", True, 1.0, "s", None),
        (3, "q" * 60, "easy", "finetuned", True, 1.0, "s", None),
        (4, "r", "easy", "baseline", True, 1.0, "s", None),
    ]
    results = spark.createDataFrame(rows, RESULTS)
    sides = {r.question: (r.baseline, r.finetuned) for r in evaluation.side_by_side(results, ["baseline", "finetuned"]).collect()}
    assert sides == {"q" * 60: ("FAIL", "PASS"), "r": ("PASS", "FAIL")}
    asked = spark.createDataFrame([("q" * 60, "easy"), ("r", "easy"), ("z", "hard")], "question string, difficulty string")
    grid = evaluation.model_grid(asked, results, ["baseline", "finetuned"]).collect()
    assert len(grid) == 7
    missing = {(r.question, r.model) for r in grid if r.error == evaluation.FOUND_NOTHING}
    assert missing == {("r", "finetuned"), ("z", "baseline"), ("z", "finetuned")}


def test_retried_is_null_safe(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b"), (None, None)], "first_sql string, sql string")
    assert [r.retried for r in evaluation.retried(df).collect()] == [False, True, True, False]


@pytest.mark.parametrize(
    "schema,expected",
    [
        ("x int", None),
        ("category string, value int", ("bar", "category", "value")),
        ("n int, at timestamp, m double", ("line", "at", "n")),
        ("a_id string, name string, x int, order_count long, y int", ("bar", "name", "order_count")),
        ("a_id string, x int, y int", ("bar", "a_id", "y")),
        ("flag boolean, n int", ("bar", "flag", "n")),
        ("x int, y double", ("scatter", "x", "y")),
        ("a string, b string", None),
    ],
)
def test_chart_choice(spark, schema, expected):
    chart = presentation.choose_chart(spark.createDataFrame([], schema).schema)
    assert (chart and (chart.kind, chart.x, chart.y)) == expected


def test_bars_keep_the_tallest(spark):
    df = spark.range(600).selectExpr("concat('c', id) AS name", "id AS value")
    rows = presentation.chart_frame(df).collect()
    assert len(rows) == 500 and min(r.y for r in rows) == 100 and all(r.horizontal for r in rows)
    few = presentation.chart_frame(df.limit(3)).collect()
    assert not any(r.horizontal for r in few)
    assert presentation.chart_frame(df.limit(0)).count() == 0


def test_lines_and_scatters_show_the_whole_range(spark):
    line = spark.range(5000).selectExpr("timestamp_seconds(id * 60) AS at", "id AS value")
    rows = presentation.chart_frame(line).orderBy("x").collect()
    assert len(rows) == 500 and sum(r.points for r in rows) == 5000 and rows[-1].y > 4900
    peak = line.withColumn("value", F.when(F.col("value") == 2503, 10**6).when(F.col("value") == 77, -5).otherwise(F.col("value")))
    rows = presentation.chart_frame(peak).orderBy("x").collect()
    assert max(r.high for r in rows) == 10**6 and min(r.low for r in rows) == -5
    assert rows[0]["first"] == 0 and rows[-1]["last"] == 4999 and all(r.low <= r.y <= r.high for r in rows)
    scatter = spark.range(5000).selectExpr("id AS x", "id * id AS y")
    rows = presentation.chart_frame(scatter).collect()
    assert len(rows) <= 500 and sum(r.points for r in rows) == 5000 and max(r.x for r in rows) > 4700
    assert presentation.chart_frame(scatter.limit(0)).count() == 0


def test_metrics_keep_odd_labels(spark):
    rows = [(1, "q", "all", "m", True, 2.0, "s", None), (2, "q", None, "m", False, 1.0, "s", "e"), (3, "q", "odd", "m", True, 0.0, "s", None)]
    got = {(r.level, r.difficulty): r.total for r in evaluation.metrics(spark.createDataFrame(rows, RESULTS)).collect()}
    assert got == {("overall", "all"): 3, ("difficulty", "all"): 1, ("difficulty", None): 1, ("difficulty", "odd"): 1}


def test_model_summary_keeps_odd_labels(spark):
    rows = [(1, "q", "all", "m", True, 2.0, "s", None), (2, "q", None, "m", False, 1.0, "s", "e"), (3, "q", "odd", "m", True, 0.0, "s", None)]
    results = spark.createDataFrame(rows, RESULTS).withColumn("uses_qualified_names", F.col("success"))
    got = {(r.model, r.level, r.difficulty): (r.total, r.passed) for r in evaluation.model_summary(results).collect()}
    assert got == {("m", "overall", "all"): (3, 2), ("m", "difficulty", "all"): (1, 1), ("m", "difficulty", None): (1, 0),
                   ("m", "difficulty", "odd"): (1, 1)}


def test_display_cap(spark):
    rows = presentation.display_frame(spark.range(30), ["id"], rows=10).collect()
    assert [r.id for r in rows] == list(range(10)) and {r.total_rows for r in rows} == {30}
