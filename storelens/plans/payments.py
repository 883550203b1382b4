"""Questions about payments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.scalars import month_of, ratio, total
from storelens.operators.median import exact_median
from storelens.operators.ranking import rank_small, top_ranked
from storelens.operators.trend import growth
from storelens.sources.star import Star


def total_payments(star: Star) -> DataFrame:
    return star.payments.agg(total(F.col("payment_value")).alias("total_payments"))


def payments_of_type(star: Star, payment_type: str) -> DataFrame:
    return star.payments.filter(F.col("payment_type") == payment_type).agg(
        total(F.col("payment_value")).alias("total_payments")
    )


def payments_with_more_installments_than(star: Star, n: int = 1) -> DataFrame:
    return star.payments.filter(F.col("installments") > n).agg(
        total(F.col("payment_value")).alias("total_payments")
    )


def orders_paid_by(star: Star, payment_type: str) -> DataFrame:
    return star.payments.filter(F.col("payment_type") == payment_type).agg(
        F.countDistinct("order_id").alias("order_count")
    )


def distinct_payment_types(star: Star) -> DataFrame:
    return star.payments.select("payment_type").distinct().orderBy("payment_type")


def revenue_by_payment_type(star: Star) -> DataFrame:
    return (
        star.payments.groupBy("payment_type")
        .agg(total(F.col("payment_value")).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "payment_type")
    )


def avg_installments_by_type(star: Star) -> DataFrame:
    return (
        star.payments.groupBy("payment_type")
        .agg(F.avg("installments").alias("avg_installments"))
        .orderBy(F.desc("avg_installments"), "payment_type")
    )


def payment_type_pct(star: Star, payment_type: str) -> DataFrame:
    matching = F.count_if(F.col("payment_type") == payment_type)
    return star.payments.agg(ratio(matching * 100, F.count("*")).alias("pct"))


def median_payment(star: Star) -> DataFrame:
    return exact_median(star.payments, "payment_value", "median_payment")


def _per_customer(star: Star) -> DataFrame:
    """Paid total, number of payments and of distinct orders per customer."""
    per_order = star.payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("v"), F.count("payment_value").alias("n")
    )
    return (
        per_order.join(star.orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        # one row per order after the first aggregate, so a count is a distinct count
        .agg(F.sum("v").alias("v"), F.sum("n").alias("n"), F.count("*").alias("orders"))
    )


def state_payment_rank(star: Star) -> DataFrame:
    states = (
        _per_customer(star)
        .join(star.customers, "customer_id")
        .groupBy("state")
        .agg(total(F.col("v")).alias("total_payments"))
    )
    return rank_small(states, "total_payments").orderBy("rank", "state")


def customer_lifetime_value(star: Star, k: int = 20) -> DataFrame:
    paid = (
        _per_customer(star)
        .join(star.customers.select("customer_id", "person_id"), "customer_id")
        .groupBy("person_id")
        .agg(total(F.col("v")).alias("total_paid"), F.sum("orders").alias("order_count"))
    )
    return top_ranked(paid, "total_paid", "person_id", k)


def orders_and_avg_payment_by_state(star: Star) -> DataFrame:
    return (
        _per_customer(star)
        .join(star.customers, "customer_id")
        .groupBy("state")
        .agg(F.sum("orders").alias("order_count"), ratio(F.sum("v"), F.sum("n")).alias("avg_payment"))
        .orderBy(F.desc("order_count"), "state")
    )


def monthly_payment_growth(star: Star) -> DataFrame:
    per_order = star.payments.groupBy("order_id").agg(F.sum("payment_value").alias("v"))
    months = (
        per_order.join(star.orders.select("order_id", "purchase_ts"), "order_id")
        .groupBy(month_of(F.col("purchase_ts")).alias("month"))
        .agg(total(F.col("v")).alias("total_payments"))
    )
    return growth(months, "month", "total_payments", "prev_month_payments").orderBy("month")
