"""Questions about order items: revenue, freight, products, sellers.

Items are summed per foreign key before a dimension is looked up, so a product
or seller with a very large share of the items is reduced in the map tasks and
the join sees one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.scalars import month_of, quarter_of, ratio, total, year_range
from storelens.operators.ranking import top_k, top_n_per_group
from storelens.operators.trend import always_growing, running_total
from storelens.sources.star import Star


def _gross() -> Column:
    return F.col("price") + F.col("freight")


def total_revenue(star: Star) -> DataFrame:
    return star.items.agg(total(F.col("price")).alias("total_revenue"))


def avg_freight(star: Star) -> DataFrame:
    return star.items.agg(ratio(F.sum("freight"), F.count("freight")).alias("avg_freight"))


def avg_price_in_category(star: Star, category: str) -> DataFrame:
    wanted = star.products.filter(F.col("category") == category).select("product_id")
    per_product = star.items.groupBy("product_id").agg(F.sum("price").alias("v"), F.count("price").alias("n"))
    return per_product.join(wanted, "product_id", "left_semi").agg(
        ratio(F.sum("v"), F.sum("n")).alias("avg_price")
    )


def _freight_of(star: Star, chosen: DataFrame) -> DataFrame:
    per_order = star.items.groupBy("order_id").agg(F.sum("freight").alias("v"))
    return per_order.join(chosen.select("order_id"), "order_id", "left_semi").agg(
        total(F.col("v")).alias("total_freight")
    )


def freight_of_orders_placed_in(star: Star, year: int) -> DataFrame:
    return _freight_of(star, star.orders.filter(year_range(F.col("purchase_ts"), year)))


def freight_of_orders_delivered_in(star: Star, year: int) -> DataFrame:
    freight = star.freight_per_order(lambda delivered: year_range(delivered, year))
    return freight.agg(total(F.col("v")).alias("total_freight"))


def _per_customer(star: Star, value: Column) -> DataFrame:
    """Sum and count of an item value per customer, via its orders."""
    per_order = star.items.groupBy("order_id").agg(F.sum(value).alias("v"), F.count(value).alias("n"))
    return (
        per_order.join(star.orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    )


def avg_order_value_by_city(star: Star) -> DataFrame:
    return (
        _per_customer(star, _gross())
        .join(star.customers, "customer_id")
        .groupBy("city", "state")
        .agg(ratio(F.sum("v"), F.sum("n")).alias("avg_order_value"))
        .orderBy(F.desc("avg_order_value"), "city", "state")
    )


def revenue_by_customer_state(star: Star) -> DataFrame:
    return (
        _per_customer(star, F.col("price"))
        .join(star.customers, "customer_id")
        .groupBy("state")
        .agg(total(F.col("v")).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "state")
    )


def states_with_avg_order_value_above(star: Star, threshold: float) -> DataFrame:
    return (
        _per_customer(star, _gross())
        .join(star.customers, "customer_id")
        .groupBy("state")
        .agg(ratio(F.sum("v"), F.sum("n")).alias("avg_order_value"))
        .filter(F.col("avg_order_value") > threshold)
        .orderBy(F.desc("avg_order_value"), "state")
    )


def running_monthly_revenue(star: Star) -> DataFrame:
    return (
        running_total(_monthly_revenue(star), "month", "revenue")
        .select("month", F.col("revenue").cast("double"), F.col("running_total").cast("double"))
        .orderBy("month")
    )


def _monthly_revenue(star: Star) -> DataFrame:
    per_order = star.items.groupBy("order_id").agg(F.sum("price").alias("v"))
    return (
        per_order.join(star.orders.select("order_id", "purchase_ts"), "order_id")
        .groupBy(month_of(F.col("purchase_ts")).alias("month"))
        .agg(F.sum("v").alias("revenue"))
    )


# -- sellers ---------------------------------------------------------------


def _per_seller(star: Star, value: Column) -> DataFrame:
    return star.items.groupBy("seller_id").agg(F.sum(value).alias("v"), F.count(value).alias("n"))


def revenue_by_seller_city(star: Star) -> DataFrame:
    return (
        _per_seller(star, _gross())
        .join(star.sellers, "seller_id")
        .groupBy("city", "state")
        .agg(total(F.col("v")).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "city", "state")
    )


def top_sellers_per_state(star: Star, n: int = 3, with_freight: bool = True) -> DataFrame:
    value = _gross() if with_freight else F.col("price")
    revenue = _per_seller(star, value).join(star.sellers, "seller_id").select("state", "seller_id", "v")
    best = top_n_per_group(revenue, ["state"], [F.desc("v"), F.col("seller_id")], n)
    return best.select("state", "seller_id", F.col("v").cast("double").alias("total_revenue")).orderBy(
        "state", F.desc("total_revenue"), "seller_id"
    )


def best_seller(star: Star) -> DataFrame:
    revenue = star.items.groupBy("seller_id").agg(F.sum("price").alias("v"))
    return top_k(revenue, [F.desc("v"), F.col("seller_id")], 1).select(
        "seller_id", F.col("v").cast("double").alias("total_revenue")
    )


def avg_items_per_seller(star: Star) -> DataFrame:
    counts = star.items.groupBy("seller_id").agg(F.count("*").alias("n"))
    return counts.agg(F.avg("n").alias("avg_items_per_seller"))


def freight_by_seller_state(star: Star) -> DataFrame:
    return (
        _per_seller(star, F.col("freight"))
        .join(star.sellers, "seller_id")
        .groupBy("state")
        .agg(total(F.col("v")).alias("total_freight"), ratio(F.sum("v"), F.sum("n")).alias("avg_freight"))
        .orderBy(F.desc("total_freight"), "state")
    )


def seller_running_total_by_state(star: Star) -> DataFrame:
    """Monthly sales of each seller state with its running total."""
    per_key = star.items.groupBy("order_id", "seller_id").agg(F.sum("price").alias("v"))
    monthly = (
        per_key.join(star.orders.select("order_id", "purchase_ts"), "order_id")
        .groupBy("seller_id", month_of(F.col("purchase_ts")).alias("month"))
        .agg(F.sum("v").alias("v"))
        .join(star.sellers.select("seller_id", "state"), "seller_id")
        .groupBy("state", "month")
        .agg(F.sum("v").alias("sales"))
    )
    return (
        running_total(monthly, "month", "sales", ("state",))
        .select("state", "month", F.col("sales").cast("double"), F.col("running_total").cast("double"))
        .orderBy("state", "month")
    )


# -- orders by their items -------------------------------------------------


def orders_with_more_items_than(star: Star, n: int = 3) -> DataFrame:
    sizes = star.items.groupBy("order_id").agg(F.count("*").alias("item_count"))
    return sizes.filter(F.col("item_count") > n).agg(F.count("*").alias("multi_item_orders"))


# -- products --------------------------------------------------------------


def _per_category(star: Star) -> DataFrame:
    per_product = star.items.groupBy("product_id").agg(F.sum("price").alias("v"), F.count("*").alias("n"))
    return (
        per_product.join(star.products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    )


def top_categories_by_sales(star: Star, k: int = 10) -> DataFrame:
    return top_k(_per_category(star), [F.desc("v"), F.col("category")], k).select(
        "category", F.col("v").cast("double").alias("total_sales")
    )


def revenue_by_translated_category(star: Star) -> DataFrame:
    return (
        _per_category(star)
        .join(star.translation, "category")
        .groupBy("category_english")
        .agg(total(F.col("v")).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "category_english")
    )


def categories_with_more_items_than(star: Star, n: int = 1000) -> DataFrame:
    return (
        _per_category(star)
        .filter(F.col("n") > n)
        .select("category", F.col("n").alias("order_count"))
        .orderBy(F.desc("order_count"), "category")
    )


def top_products_per_category(star: Star, n: int = 3) -> DataFrame:
    counts = star.items.groupBy("product_id").agg(F.count("order_item_id").alias("order_count"))
    named = counts.join(star.products.select("product_id", "category"), "product_id")
    best = top_n_per_group(named, ["category"], [F.desc("order_count"), F.col("product_id")], n)
    return best.select("category", "product_id", "order_count").orderBy(
        "category", F.desc("order_count"), "product_id"
    )


def weight_freight_correlation(star: Star) -> DataFrame:
    """Pearson correlation over items, from sums per product: a product has one weight,
    so its items count as a number, a sum and a sum of squares of their freight."""
    # Exact sums, so that the order of addition does not show in the result.
    per_product = star.items.filter("freight IS NOT NULL").groupBy("product_id").agg(
        F.count("*").alias("n"), F.sum("freight").alias("y"), F.sum(F.col("freight") * F.col("freight")).alias("yy")
    )
    x = F.col("weight_g").cast("long")
    parts = {"n": F.col("n"), "x": x * F.col("n"), "xx": x * x * F.col("n"), "xy": x * F.col("y"), "y": F.col("y"), "yy": F.col("yy")}
    sums = per_product.join(star.products.select("product_id", "weight_g"), "product_id").filter(
        "weight_g IS NOT NULL"
    ).agg(*(F.sum(c).cast("double").alias(k) for k, c in parts.items()))
    n, x, xx, xy, y, yy = (F.col(c) for c in ("n", "x", "xx", "xy", "y", "yy"))
    spread = (n * xx - x * x) * (n * yy - y * y)
    return sums.select(F.when(spread > 0, (n * xy - x * y) / F.sqrt(spread)).alias("weight_freight_correlation"))


def max_weight(star: Star) -> DataFrame:
    return star.products.agg(F.max("weight_g").alias("max_weight_g"))


def category_count(star: Star) -> DataFrame:
    return star.products.agg(F.countDistinct("category").alias("category_count"))


def products_heavier_than(star: Star, grams: int = 5000) -> DataFrame:
    return star.products.filter(F.col("weight_g") > grams).agg(F.count("*").alias("heavy_products"))


def products_with_more_photos_than(star: Star, n: int = 3) -> DataFrame:
    return star.products.filter(F.col("photos") > n).agg(F.count("*").alias("products_with_many_photos"))


def avg_weight_by_category(star: Star) -> DataFrame:
    return (
        star.products.groupBy("category")
        .agg(F.avg("weight_g").alias("avg_weight"))
        .orderBy(F.desc("avg_weight"), "category")
    )


def avg_description_length_by_category(star: Star) -> DataFrame:
    return (
        star.products.groupBy("category")
        .agg(F.avg("description_length").alias("avg_desc_length"))
        .orderBy(F.desc("avg_desc_length"), "category")
    )


def products_growing_every_quarter(star: Star, year: int) -> DataFrame:
    """Products whose number of items sold rose from quarter to quarter of a year."""
    placed = star.orders.filter(year_range(F.col("purchase_ts"), year)).select("order_id", "purchase_ts")
    per_key = star.items.groupBy("order_id", "product_id").agg(F.count("*").alias("n"))
    quarterly = (
        per_key.join(placed, "order_id")
        .groupBy("product_id", quarter_of(F.col("purchase_ts")).alias("quarter"))
        .agg(F.sum("n").alias("sold"))
    )
    return always_growing(quarterly, "product_id", "quarter", "sold").orderBy("product_id")
