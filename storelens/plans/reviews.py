"""Questions about review scores.

Joined to items, a review counts once per item of its order; these measures are
named item-weighted.  Items are counted per (order, key) before the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.scalars import month_of, ratio
from storelens.operators.ranking import top_k
from storelens.sources.star import Star


def score_extremes(star: Star) -> DataFrame:
    return star.reviews.agg(
        F.max("score").alias("max_score"), F.min("score").alias("min_score"), F.avg("score").alias("avg_score")
    )


def max_score(star: Star) -> DataFrame:
    return star.reviews.agg(F.max("score").alias("max_score"))


def min_score(star: Star) -> DataFrame:
    return star.reviews.agg(F.min("score").alias("min_score"))


def avg_score(star: Star) -> DataFrame:
    return star.reviews.agg(F.avg("score").alias("avg_score"))


def avg_score_by_status(star: Star) -> DataFrame:
    return (
        star.orders.select("order_id", "status")
        .join(star.reviews, "order_id")
        .groupBy("status")
        .agg(F.avg("score").alias("avg_review"))
        .orderBy(F.desc("avg_review"), "status")
    )


def _item_weighted(star: Star, key: str) -> DataFrame:
    """Sum of scores and number of scored items per product or seller."""
    counted = star.items.groupBy("order_id", key).agg(F.count("*").alias("n"))
    return (
        counted.join(star.reviews, "order_id")
        .groupBy(key)
        .agg(
            F.sum(F.col("score") * F.col("n")).alias("s"),
            F.sum(F.when(F.col("score").isNotNull(), F.col("n"))).alias("n"),
        )
    )


def avg_score_by_category(star: Star) -> DataFrame:
    return (
        _item_weighted(star, "product_id")
        .join(star.products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(ratio(F.sum("s"), F.sum("n")).alias("avg_score"))
        .orderBy(F.desc("avg_score"), "category")
    )


def best_reviewed_categories(star: Star, k: int = 10) -> DataFrame:
    return top_k(avg_score_by_category(star), [F.desc("avg_score"), F.col("category")], k)


def avg_score_by_seller_state(star: Star) -> DataFrame:
    return (
        _item_weighted(star, "seller_id")
        .join(star.sellers.select("seller_id", "state"), "seller_id")
        .groupBy("state")
        .agg(ratio(F.sum("s"), F.sum("n")).alias("avg_score"))
        .orderBy(F.desc("avg_score"), "state")
    )


def sellers_with_avg_score_below(star: Star, threshold: float = 3.0) -> DataFrame:
    return (
        _item_weighted(star, "seller_id")
        .select("seller_id", ratio(F.col("s"), F.col("n")).alias("avg_score"))
        .filter(F.col("avg_score") < threshold)
        .orderBy("avg_score", "seller_id")
    )


def monthly_orders_and_score(star: Star) -> DataFrame:
    return (
        star.orders.select("order_id", "purchase_ts")
        .join(star.reviews, "order_id")
        .groupBy(month_of(F.col("purchase_ts")).alias("month"), "order_id")
        .agg(F.sum("score").alias("s"), F.count("score").alias("n"))
        .groupBy("month")
        .agg(F.count("*").alias("order_count"), ratio(F.sum("s"), F.sum("n")).alias("avg_review"))
        .orderBy("month")
    )
