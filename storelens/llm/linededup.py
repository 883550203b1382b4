"""Line dedup: levelled sorted runs of line hashes.

A run is a table of (hash, number of documents), bucketed and sorted by the hash.  A
new batch is anti-joined with the runs' known common lines, its other hashes become a
run of level 0, and ``fanout`` runs of one level are merged into one of the next.  All
runs share one bucketing, so merges and anti-joins move no run over the network.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm.scratch import drop, new_folder, stored
from storelens.llm.text import SPACES, ascii_lower, content_key, whole

HASH = ["_h1", "_h2"]
ROW = ["_r1", "_r2"]
LAST = 2**63 - 1


def line_key(line: Column) -> Column:
    """Stripped of ASCII white space at both ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


class LineRuns:
    """How many documents hold a line, over all batches added so far.

    ``add`` takes a batch as rows (``_h1``, ``_h2``, ``n``, ``first``): a line hash, the
    number of the batch's documents with it, the smallest of their ids.  Lines known to
    be in ``min_docs`` documents are common and need no more counting, so a batch is
    freed of them before it is stored; batches therefore come in order of document id.
    """

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        # as many as shuffle partitions, so that a batch's counts lie like a run's
        self.buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 100_000)
        self.levels: list[list[tuple[str, str]]] = []

    def add(self, batch: DataFrame) -> None:
        for table, _ in self._runs():
            known = self.spark.table(table).filter("common").select(*HASH)
            batch = batch.join(known, HASH, "left_anti")
        self._put(0, batch)

    def common(self) -> DataFrame:
        """Merge all runs into one and return its common lines."""
        if len(self._runs()) > 1:
            runs, self.levels = self._runs(), []
            self._put(0, self._merged(runs))
            self._forget(runs)
        (_, path), = self._runs()
        # read without the buckets, so that a join may split a line that very many documents hold
        rows = self.spark.read.schema("_h1 long, _h2 long, n long, first long, common boolean").parquet(path)
        return rows.filter("common").drop("common")

    def _runs(self) -> list[tuple[str, str]]:
        return [run for level in self.levels for run in level]

    def _merged(self, runs: list[tuple[str, str]]) -> DataFrame:
        rows = self.spark.table(runs[0][0])
        for table, _ in runs[1:]:
            rows = rows.unionByName(self.spark.table(table))
        return rows.groupBy(*HASH).agg(F.sum("n").alias("n"), F.min("first").alias("first"))

    def _put(self, level: int, rows: DataFrame) -> None:
        table, path = f"line_run_{uuid.uuid4().hex}", new_folder(self.spark, "line-run")
        (
            rows.withColumn("common", F.col("n") >= self.min_docs)
            .write.partitionBy("common")
            .bucketBy(self.buckets, *HASH)
            .sortBy(*HASH)
            .option("path", path)
            .saveAsTable(table)
        )
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((table, path))
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._merged(full))
            self._forget(full)

    def _forget(self, runs: list[tuple[str, str]]) -> None:
        for table, path in runs:
            self.spark.sql(f"DROP TABLE {table}")
            drop(self.spark, path)


def _batch_number(docs: DataFrame, batches: int) -> Column:
    """Which of ``batches`` ranges of document ids a row is in; null ids come last."""
    shares = [i / batches for i in range(1, batches)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 1000).alias("b")).first()["b"] if shares else None
    number = F.lit(0)
    for bound in sorted(set(bounds or [])):
        number = number + F.when(F.col("doc_id") <= bound, 0).otherwise(1)
    return number.cast("int")


def dedupe_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none", batches: int = 4, fanout: int = 2
) -> DataFrame:
    """Drop lines whose key occurs in at least ``min_docs`` documents.

    ``docs`` has ``doc_id`` and ``text``; all its columns are returned, ``text`` freed of
    the dropped lines, plus ``n_lines`` (before) and ``n_dropped``.  Keys shorter than
    ``min_chars`` code points never count.  ``keep="first"`` leaves a common line in the
    document with the smallest id among those that hold it.

    Null or empty text is one empty line.  Rows equal in id and text are one document
    when lines are counted, and each of them is returned.  A null id sorts last.  An
    empty table gives an empty table.  Input columns named like the two added ones are
    replaced; names that start with ``_h``, ``_r`` or ``_pos`` are reserved.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep is 'none' or 'first'")
    spark = docs.sparkSession
    rows = docs.select(
        *(k.alias(n) for k, n in zip(content_key(F.col("doc_id"), whole("text")), ROW)),
        _batch_number(docs, batches).alias("_batch"), F.coalesce("doc_id", F.lit(LAST)).alias("_doc"),
        F.split(whole("text"), "\n", -1).alias("_lines"),
    )
    keyed = rows.select("_batch", "_doc", *ROW, F.posexplode("_lines").alias("_pos", "_line"))
    keyed = keyed.withColumn("_key", line_key(F.col("_line"))).filter(F.char_length("_key") >= min_chars)
    hashed = keyed.select(
        "_batch", "_doc", *ROW, "_pos", *(k.alias(n) for k, n in zip(content_key(F.col("_key")), HASH))
    )
    once = hashed.groupBy("_batch", "_doc", *ROW, *HASH).agg(F.collect_set("_pos").alias("_pos"))
    lines_path = new_folder(spark, "lines")
    once = stored(once, lines_path, "_batch")

    runs = LineRuns(spark, min_docs, fanout)
    for number in range(batches):
        batch = once.filter(F.col("_batch") == number)
        runs.add(batch.groupBy(*HASH).agg(F.count("*").alias("n"), F.min("_doc").alias("first")))
    common = runs.common()

    hits = once.join(common, HASH)
    if keep == "first":
        hits = hits.filter(F.col("_doc") != F.col("first"))
    gone = hits.groupBy(*ROW).agg(F.array_sort(F.flatten(F.collect_list("_pos"))).alias("_gone"))
    return _without(docs, gone)


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the lines at the sorted positions ``_gone``."""
    keys = content_key(F.col("doc_id"), whole("text"))
    docs = docs.withColumns(dict(zip(ROW, keys)))
    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "text", *ROW)]
    split = docs.join(gone, ROW, "left").withColumns({
        "_lines": F.split(whole("text"), "\n", -1),
        "_ends": F.concat(
            F.coalesce("_gone", F.array().cast("array<int>")),
            F.array(F.size(F.split(whole("text"), "\n", -1))),
        ),
    })
    # what stays are the stretches between neighbouring dropped lines
    starts = F.concat(F.array(F.lit(0)), F.transform("_ends", lambda e: e + 1))
    stretches = F.transform(
        F.arrays_zip(starts.alias("a"), F.col("_ends").alias("b")),
        lambda s: F.when(s["b"] > s["a"], F.slice("_lines", s["a"] + 1, s["b"] - s["a"])),
    )
    kept = F.array_join(F.flatten(F.filter(stretches, lambda s: s.isNotNull())), "\n")
    return split.select(
        *(F.col(c) for c in rest),
        F.when(F.col("_gone").isNull(), whole("text")).otherwise(kept).alias("text"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_ends") - 1).cast("long").alias("n_dropped"),
    ).select(*[c for c in docs.columns if c not in ("n_lines", "n_dropped", *ROW)], "n_lines", "n_dropped")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = dedupe_lines(docs, min_docs=10, min_chars=1, keep="none")
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH line AS (
    SELECT doc_id, pos, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
          FROM documents)),
common AS (
    SELECT key FROM line WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM line LEFT JOIN common c USING (key) GROUP BY doc_id
"""
