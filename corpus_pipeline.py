"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import linededup, mixing, packing, quality, simhash
from storelens.llm.catalog import Entry
from storelens.llm.scratch import new_folder, stored


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base test and that no learned rule rejects."""
    rules = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judged(docs, rules).filter("kept").select(docs.columns)


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A line found in ten documents or more stays in the first of them alone, so that a
    text with many copies is not lost altogether."""
    out = linededup.dedupe_lines(docs, min_docs=10, min_chars=1, keep="first")
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return simhash.keep_one_per_group(docs, size=5, similarity=0.8)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mix; those of small sources come more than once."""
    return mixing.in_order(mixing.mixed(docs)).select(docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("quality_rules", good),
    ("line_dedup", without_common_lines),
    ("simhash_near_dedup", without_copies),
    ("mix_sources", mixed_sources),
    ("best_fit_packing", packed_sequences),
]

#: Similarity groups and best-fit packing have no SQL; the tests check run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), new_folder(spark, f"pipeline-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)


ENTRY = Entry(run, ORACLE_SQL)
