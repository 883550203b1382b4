"""Connected components by alternating star contractions.

Every step is a group-by and a join on edges; no node's neighbours are gathered in one
place, and the edges of each step are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.scratch import drop, new_folder, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of node and neighbours."""
    both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u")
    return linked.select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").union(
        least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (two columns of one type); the root
    is the component's smallest node.  Loops and repeated edges do no harm; an edge with
    a null end is left out.  The number of steps grows with the logarithm of the nodes.
    """
    spark = edges.sparkSession
    a, b = edges.columns
    plain = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a > b").distinct()
    path = new_folder(spark, "edges")
    now = stored(plain, path)
    mark = _mark(now)
    while True:
        next_path = new_folder(spark, "edges")
        following = stored(_small_star(_large_star(now).distinct()).distinct(), next_path)
        following_mark = _mark(following)
        drop(spark, path)
        now, path = following, next_path
        if following_mark == mark:
            break
        mark = following_mark
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())
