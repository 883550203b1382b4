"""Questions about customers and sellers by place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.operators.ranking import top_k
from storelens.sources.star import Star


def customers_in_state(star: Star, state: str) -> DataFrame:
    return star.customers.filter(F.col("state") == state).agg(F.count("customer_id").alias("customer_count"))


def customers_in_city(star: Star, city: str) -> DataFrame:
    return star.customers.filter(F.col("city") == city).agg(F.count("customer_id").alias("customer_count"))


def unique_customers(star: Star) -> DataFrame:
    return star.customers.agg(F.countDistinct("person_id").alias("unique_customers"))


def seller_count(star: Star) -> DataFrame:
    return star.sellers.agg(F.count("seller_id").alias("seller_count"))


def sellers_in_state(star: Star, state: str) -> DataFrame:
    return star.sellers.filter(F.col("state") == state).agg(F.count("seller_id").alias("seller_count"))


def sellers_in_city(star: Star, city: str) -> DataFrame:
    return star.sellers.filter(F.col("city") == city).agg(F.count("seller_id").alias("seller_count"))


def sellers_per_state(star: Star) -> DataFrame:
    return star.sellers.groupBy("state").agg(F.count("*").alias("seller_count")).orderBy(
        F.desc("seller_count"), "state"
    )


def cities_with_most_sellers(star: Star, k: int = 5) -> DataFrame:
    cities = star.sellers.groupBy("city").agg(F.count("*").alias("seller_count"))
    return top_k(cities, [F.desc("seller_count"), F.col("city")], k)
