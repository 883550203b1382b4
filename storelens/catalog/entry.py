"""What a registered query is made of."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from storelens.sources.star import Star, WarehouseStar

# The star roles as SQL, in the order in which they may refer to each other.
ROLES = {
    "w_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
               o_orderdate AS purchase_ts FROM orders""",
    "w_tracked": """
        SELECT o.*, d.approved_at, d.delivered_ts, o.purchase_ts + INTERVAL 60 DAY AS estimated_ts
        FROM w_orders o LEFT JOIN (
            SELECT l_orderkey, min(l_shipdate) AS approved_at, max(l_shipdate) AS delivered_ts
            FROM lineitem GROUP BY l_orderkey) d ON o.order_id = d.l_orderkey""",
    "w_customers": """
        SELECT c_custkey AS customer_id, c_custkey AS person_id, n_name AS state, c_mktsegment AS city
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "w_sellers": """
        SELECT s_suppkey AS seller_id, n_name AS state, r_name AS city
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "w_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS freight
        FROM lineitem""",
    "w_payments": """
        SELECT o_orderkey AS order_id, o_orderpriority AS payment_type, 1 + o_orderkey % 6 AS installments,
               CAST(o_totalprice AS DECIMAL(12,2)) AS payment_value FROM orders""",
    "w_reviews": """
        SELECT l_orderkey AS order_id, 1 + CAST(max(l_quantity) AS INTEGER) % 5 AS score
        FROM lineitem GROUP BY l_orderkey""",
    "w_products": """
        SELECT p_partkey AS product_id, p_type AS category, p_size * 200 AS weight_g, p_size % 7 AS photos,
               length(p_name) AS description_length FROM part""",
    "w_translation": """
        SELECT DISTINCT p_type AS category, lower(p_type) AS category_english FROM part""",
}


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    on_star: Callable[[Star | WarehouseStar], DataFrame] | None = None
    star_sql: str | None = None


def with_ctes(body: str, ctes: dict[str, str]) -> str:
    """Prefix ``body`` with those CTEs it uses, directly or through another."""
    used: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name, definition in ctes.items():
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                pending.append(definition)
    if not used:
        return body
    clauses = ", ".join(f"{name} AS ({ctes[name]})" for name in ctes if name in used)
    return f"WITH {clauses} {body}"


def star_entry(job: Callable[..., DataFrame], sql: str, **arguments) -> Entry:
    """A question over the star roles, with its SQL over the same roles."""

    def on_star(star: Star | WarehouseStar) -> DataFrame:
        return job(star, **arguments)

    return Entry(lambda spark, sf_dir: on_star(Star(spark, sf_dir)), with_ctes(sql, ROLES), on_star, sql)
