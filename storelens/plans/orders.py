"""Questions about orders: counts, status, months, delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.scalars import (
    between_dates, days_between, month_of, quarter_of, ratio, year_range,
)
from storelens.operators.ranking import rank_small, top_k
from storelens.operators.trend import growth
from storelens.sources.star import Star


def total_orders(star: Star) -> DataFrame:
    return star.orders.agg(F.count("*").alias("total_orders"))


def orders_with_status(star: Star, status: str) -> DataFrame:
    return star.orders.filter(F.col("status") == status).agg(F.count("*").alias("order_count"))


def orders_placed_in_year(star: Star, year: int) -> DataFrame:
    return star.orders.filter(year_range(F.col("purchase_ts"), year)).agg(
        F.count("order_id").alias("order_count")
    )


def orders_delivered_in_year(star: Star, year: int) -> DataFrame:
    return star.tracked_orders.filter(year_range(F.col("delivered_ts"), year)).agg(
        F.count("order_id").alias("order_count")
    )


def orders_between(star: Star, start: str, end: str) -> DataFrame:
    return star.orders.filter(between_dates(F.col("purchase_ts"), start, end)).agg(
        F.count("*").alias("order_count")
    )


def orders_from_state(star: Star, state: str) -> DataFrame:
    people = star.customers.filter(F.col("state") == state).select("customer_id")
    return star.orders.join(people, "customer_id", "left_semi").agg(F.count("order_id").alias("order_count"))


def distinct_statuses(star: Star) -> DataFrame:
    return star.orders.select("status").distinct().orderBy("status")


def orders_by_status(star: Star) -> DataFrame:
    return star.orders.groupBy("status").agg(F.count("*").alias("order_count")).orderBy(
        F.desc("order_count"), "status"
    )


def known_status_share(star: Star, unknown: str) -> DataFrame:
    """COUNT(column) against COUNT(*) where one status stands for 'not known'."""
    status = F.nullif(F.col("status"), F.lit(unknown))
    return star.orders.agg(
        F.count("*").alias("all_rows"),
        F.count(status).alias("known_rows"),
        F.countDistinct(status).alias("known_statuses"),
    )


def orders_per_month(star: Star, year: int) -> DataFrame:
    return (
        star.orders.filter(year_range(F.col("purchase_ts"), year))
        .groupBy(month_of(F.col("purchase_ts")).alias("order_month"))
        .agg(F.count("*").alias("order_count"))
        .orderBy("order_month")
    )


def orders_per_quarter(star: Star, year: int) -> DataFrame:
    return (
        star.orders.filter(year_range(F.col("purchase_ts"), year))
        .groupBy(quarter_of(F.col("purchase_ts")).alias("quarter"))
        .agg(F.count("*").alias("order_count"))
        .orderBy("quarter")
    )


def date_parts(star: Star, due_days: int = 7) -> DataFrame:
    """Calendar parts of each order's purchase time, and a due date after it."""
    bought = F.to_date("purchase_ts")
    return star.orders.select(
        "order_id",
        F.year("purchase_ts").alias("order_year"),
        F.month("purchase_ts").alias("order_month"),
        bought.alias("order_date"),
        F.date_add(bought, due_days).alias("due_date"),
    )


def busiest_month(star: Star) -> DataFrame:
    months = star.orders.groupBy(month_of(F.col("purchase_ts")).alias("month")).agg(
        F.count("*").alias("order_count")
    )
    return top_k(months, [F.desc("order_count"), F.col("month")], 1)


def monthly_order_growth(star: Star) -> DataFrame:
    months = star.orders.groupBy(month_of(F.col("purchase_ts")).alias("month")).agg(
        F.count("order_id").alias("total_orders")
    )
    return growth(months, "month", "total_orders", "prev_month_orders").orderBy("month")


def customers_with_most_orders(star: Star, k: int = 10) -> DataFrame:
    """People by number of orders; one person may have many customer rows."""
    counts = star.orders.groupBy("customer_id").agg(F.count("order_id").alias("n"))
    people = (
        counts.join(star.customers.select("customer_id", "person_id"), "customer_id")
        .groupBy("person_id")
        .agg(F.sum("n").alias("order_count"))
    )
    return top_k(people, [F.desc("order_count"), F.col("person_id")], k)


def customers_active_in_months(star: Star, months: int = 4) -> DataFrame:
    """People with orders in at least ``months`` distinct months.

    Orders are reduced to (customer, month) first; a person has no more months
    than the calendar.
    """
    month = month_of(F.col("purchase_ts")).alias("order_month")
    active = (
        star.orders.select("customer_id", month)
        .distinct()
        .join(star.customers.select("customer_id", "person_id"), "customer_id")
        .select("person_id", "order_month")
        .distinct()
    )
    counted = active.groupBy("person_id").agg(F.count("order_month").alias("months_with_orders"))
    return counted.filter(F.col("months_with_orders") >= months).orderBy(F.desc("months_with_orders"), "person_id")


def on_time_by_month(star: Star) -> DataFrame:
    """Share of orders delivered on time per delivery month; orders never
    delivered form the NULL month and count in its denominator."""
    on_time = F.count_if(F.col("delivered_ts") <= F.col("estimated_ts"))
    return (
        star.tracked_orders.groupBy(F.month("delivered_ts").alias("month"))
        .agg((ratio(on_time, F.count("*")) * 100).alias("on_time_delivery_rate"))
        .orderBy(F.col("month").asc_nulls_last())
    )


def late_delivery_pct(star: Star) -> DataFrame:
    done = star.tracked_orders.filter(F.col("delivered_ts").isNotNull() & F.col("estimated_ts").isNotNull())
    late = F.count_if(F.col("delivered_ts") > F.col("estimated_ts"))
    return done.agg(ratio(late * 100, F.count("*")).alias("late_delivery_pct"))


def avg_delivery_days(star: Star) -> DataFrame:
    done = star.tracked_orders.filter(F.col("delivered_ts").isNotNull())
    return done.agg(F.avg(days_between(F.col("purchase_ts"), F.col("delivered_ts"))).alias("avg_delivery_days"))


def _days_by_state(star: Star, start: str, name: str) -> DataFrame:
    """Mean days from ``start`` to delivery per customer state, summed per
    customer before customers are looked up."""
    done = star.tracked_orders.filter(F.col(start).isNotNull() & F.col("delivered_ts").isNotNull())
    days = days_between(F.col(start), F.col("delivered_ts"))
    per_customer = done.groupBy("customer_id").agg(F.sum(days).alias("days"), F.count(days).alias("n"))
    return (
        per_customer.join(star.customers, "customer_id")
        .groupBy("state")
        .agg(ratio(F.sum("days"), F.sum("n")).alias(name))
        .orderBy(F.col(name).asc_nulls_last(), "state")
    )


def delivery_days_by_state(star: Star) -> DataFrame:
    return _days_by_state(star, "purchase_ts", "avg_delivery_days")


def approval_to_delivery_by_state(star: Star) -> DataFrame:
    return _days_by_state(star, "approved_at", "avg_approval_to_delivery_days")


def state_order_rank(star: Star) -> DataFrame:
    per_customer = star.orders.groupBy("customer_id").agg(F.count("order_id").alias("n"))
    states = (
        per_customer.join(star.customers, "customer_id").groupBy("state").agg(F.sum("n").alias("order_count"))
    )
    return rank_small(states, "order_count", "state_rank").orderBy("state_rank", "state")
