"""The query log as a stream: totals per hour, steps per query."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from storelens.functions.scalars import ratio_or_zero
from storelens.plans.monitoring import UNKNOWN_AGENT

STEP_SCHEMA = "query_id long, mark_id long, ts timestamp, agent string, status string, duration_ms long"
STATE_SCHEMA = (
    "opened array<long>, opened_us array<long>, opened_agent array<string>, query_id array<long>, at array<long>, "
    "mark_id array<long>, kind array<string>, agent array<string>, status array<string>"
)
# Queries share a state, as each state costs a call per micro-batch.
STATES = 4096


def hourly_summary(log: DataFrame, lateness: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Totals, success rate and mean latency per window, from rows (ts, success,
    latency).  A window is final once the watermark has passed its end."""
    zoned = log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    sums = zoned.groupBy(F.window("ts", window)).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("success")).alias("successful"),
        F.sum(F.col("latency").cast("decimal(12,3)")).alias("latency_sum"),
    )
    return sums.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "total",
        (ratio_or_zero(F.col("successful"), F.col("total")) * 100).alias("success_rate"),
        ratio_or_zero(F.col("latency_sum"), F.col("total")).alias("avg_latency"),
    )


def _ordered_steps():
    """The state function for the queries that share a state: marks wait until the watermark
    has passed them, and are then taken query by query in order of time, whatever the order
    and the files in which they came."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting, opened = [], {}
        if state.exists:
            queries, since, agents, *columns = state.get
            opened = {query: (at, agent) for query, at, agent in zip(queries, since, agents)}
            waiting = list(zip(*columns))
        if not state.hasTimedOut:
            for batch in batches:
                at = batch["ts"].to_numpy("datetime64[us]").astype("int64").tolist()
                names = ("mark_id", "kind", "agent", "status")
                waiting += zip(batch["query_id"].tolist(), at, *(batch[name].tolist() for name in names))
        until = state.getCurrentWatermarkMs() * 1000
        ready = sorted((m for m in waiting if m[1] <= until), key=lambda m: m[:3])
        waiting = [m for m in waiting if m[1] > until]
        rows = []
        for query, at, mark_id, kind, agent, status in ready:
            if kind == "start":
                opened[query] = (at, agent)
                continue
            before = opened.pop(query, None)
            if kind == "end":
                started, who = before or (at, UNKNOWN_AGENT)
                rows.append((query, mark_id, pd.Timestamp(at, unit="us"), who, status, (at - started) // 1000))
        if waiting or opened:
            columns = [list(c) for c in zip(*waiting)] or [[], [], [], [], [], []]
            since, agents = [at for at, _ in opened.values()], [agent for _, agent in opened.values()]
            state.update((list(opened), since, agents, *columns))
            if waiting:
                state.setTimeoutTimestamp(max(min(columns[1]) // 1000, until // 1000) + 1)
        elif state.exists:
            state.remove()
        if rows:
            yield pd.DataFrame(rows, columns=["query_id", "mark_id", "ts", "agent", "status", "duration_ms"])

    return run


def streamed_steps(marks: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Step records from a stream of marks, equal to those of the batch job
    ``trace_steps`` for marks that come at most ``lateness`` out of order.

    A step comes out once the watermark has passed its end.  Queries are dealt to ``STATES``
    states by a hash; for each query a state holds the marks of the last ``lateness`` and a
    start not ended yet.  Marks without a query
    or a time are left out; ``monitoring.rejected_marks`` lists them.
    """
    known = marks.filter("query_id IS NOT NULL AND ts IS NOT NULL")
    zoned = known.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    shared = zoned.withColumn("_state", F.pmod(F.xxhash64("query_id"), F.lit(STATES)))
    return shared.groupBy("_state").applyInPandasWithState(
        _ordered_steps(), STEP_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout
    )


PARTIAL = "window_start timestamp, window_end timestamp, total long, successful long, latency_sum decimal(38,3), newest timestamp"


def add_totals(batch: DataFrame, number: int, folder: str, lateness: str = "10 minutes", window: str = "1 hour") -> None:
    """Add a micro-batch of rows (ts, success, latency, others) to the totals in ``folder``.

    A window is closed once rows ``lateness`` after its end came in an earlier batch.  Rows
    of closed windows, and rows without a time, go to ``rejects`` with the reason; all others
    are summed per window into ``partials``.  So totals and rejects add up to the input.
    A batch writes folders of its own, so a batch that runs again replaces what it wrote.
    """
    spark = batch.sparkSession
    zoned = batch.withColumn("_ts", F.col("ts").cast("timestamp"))
    passed = watermark(spark, folder, lateness, number)
    closed = F.lit(False) if passed is None else F.col("_window.end") <= F.lit(passed)
    # window() leaves rows without a time out, so they are taken apart before
    judged = zoned.filter("_ts IS NOT NULL").withColumn("_window", F.window("_ts", window)).withColumn("reason", F.when(closed, "late"))
    timeless = zoned.filter("_ts IS NULL").drop("_ts").withColumn("reason", F.lit("no time"))
    late = judged.filter("reason IS NOT NULL").drop("_ts", "_window")
    late.unionByName(timeless).write.mode("overwrite").parquet(f"{folder}/rejects/batch={number}")
    sums = judged.filter("reason IS NULL").groupBy(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end")).agg(
        F.count("*").alias("total"), F.count_if(F.col("success")).alias("successful"),
        F.sum(F.col("latency").cast("decimal(12,3)")).cast("decimal(38,3)").alias("latency_sum"), F.max("_ts").alias("newest"),
    )
    sums.write.mode("overwrite").parquet(f"{folder}/partials/batch={number}")


def _partials(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{PARTIAL}, batch int").parquet(f"{folder}/partials")


def watermark(spark: SparkSession, folder: str, lateness: str, before: int | None = None) -> datetime | None:
    """The time up to which windows are closed by the batches (those ``before`` a number)."""
    if before == 0:
        return None
    batches = _partials(spark, folder)
    if before is not None:
        batches = batches.filter(F.col("batch") < before)
    return batches.agg((F.max("newest") - F.expr(f"INTERVAL {lateness}")).alias("t")).first().t


def totals(spark: SparkSession, folder: str) -> DataFrame:
    """What :func:`add_totals` has counted so far per window, open windows included."""
    sums = _partials(spark, folder).groupBy("window_start", "window_end").agg(
        *(F.sum(c).alias(c) for c in ("total", "successful", "latency_sum"))
    )
    return sums.select(
        "window_start", "window_end", "total",
        (ratio_or_zero(F.col("successful"), F.col("total")) * 100).alias("success_rate"),
        ratio_or_zero(F.col("latency_sum"), F.col("total")).alias("avg_latency"),
    )


def rejects(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows that came too late or have no time, with the ``reason``."""
    return spark.read.schema(f"{schema}, reason string, batch int").parquet(f"{folder}/rejects").drop("batch")
