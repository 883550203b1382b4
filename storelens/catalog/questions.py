"""The business questions, one entry each, with the SQL they must agree with.

Names of places, categories and payment types are those of the test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.catalog.entry import Entry, star_entry
from storelens.plans import orders, payments, people, reviews, sales

def _date_texts(star) -> DataFrame:
    dates = {name: F.col(name).cast("string") for name in ("order_date", "due_date")}
    return orders.date_parts(star).withColumns(dates)


ORDERS: dict[str, Entry] = {
    "total_orders": star_entry(orders.total_orders, "SELECT COUNT(*) AS total_orders FROM w_orders"),
    "completed_orders": star_entry(
        orders.orders_with_status, "SELECT COUNT(*) AS order_count FROM w_orders WHERE status = 'F'", status="F"
    ),
    "pending_orders": star_entry(
        orders.orders_with_status, "SELECT COUNT(*) AS order_count FROM w_orders WHERE status = 'P'", status="P"
    ),
    "orders_placed_in_year": star_entry(
        orders.orders_placed_in_year,
        "SELECT COUNT(order_id) AS order_count FROM w_orders WHERE EXTRACT(YEAR FROM purchase_ts) = 1997",
        year=1997,
    ),
    "orders_delivered_in_year": star_entry(
        orders.orders_delivered_in_year,
        "SELECT COUNT(order_id) AS order_count FROM w_tracked WHERE EXTRACT(YEAR FROM delivered_ts) = 1998",
        year=1998,
    ),
    "orders_between_dates": star_entry(
        orders.orders_between,
        """SELECT COUNT(*) AS order_count FROM w_orders
           WHERE purchase_ts >= TIMESTAMP '1998-01-01' AND purchase_ts < TIMESTAMP '1998-07-01'""",
        start="1998-01-01", end="1998-07-01",
    ),
    "orders_from_state": star_entry(
        orders.orders_from_state,
        """SELECT COUNT(order_id) AS order_count FROM w_orders
           WHERE customer_id IN (SELECT customer_id FROM w_customers WHERE state = 'NATION_7')""",
        state="NATION_7",
    ),
    "distinct_statuses": star_entry(orders.distinct_statuses, "SELECT DISTINCT status FROM w_orders"),
    "orders_by_status": star_entry(
        orders.orders_by_status, "SELECT status, COUNT(*) AS order_count FROM w_orders GROUP BY status"
    ),
    "known_status_share": star_entry(
        orders.known_status_share,
        """SELECT COUNT(*) AS all_rows, COUNT(NULLIF(status, 'P')) AS known_rows,
                  COUNT(DISTINCT NULLIF(status, 'P')) AS known_statuses FROM w_orders""",
        unknown="P",
    ),
    "orders_per_month": star_entry(
        orders.orders_per_month,
        """SELECT DATE_TRUNC('month', purchase_ts) AS order_month, COUNT(*) AS order_count FROM w_orders
           WHERE EXTRACT(YEAR FROM purchase_ts) = 1998 GROUP BY 1""",
        year=1998,
    ),
    "orders_per_quarter": star_entry(
        orders.orders_per_quarter,
        """SELECT DATE_TRUNC('quarter', purchase_ts) AS quarter, COUNT(*) AS order_count FROM w_orders
           WHERE EXTRACT(YEAR FROM purchase_ts) = 1998 GROUP BY 1""",
        year=1998,
    ),
    "date_parts": star_entry(
        _date_texts,
        """SELECT order_id, CAST(EXTRACT(YEAR FROM purchase_ts) AS INTEGER) AS order_year,
                  CAST(EXTRACT(MONTH FROM purchase_ts) AS INTEGER) AS order_month,
                  CAST(CAST(purchase_ts AS DATE) AS VARCHAR) AS order_date,
                  CAST(CAST(purchase_ts AS DATE) + 7 AS VARCHAR) AS due_date
           FROM w_orders""",
    ),
    "busiest_month": star_entry(
        orders.busiest_month,
        """SELECT DATE_TRUNC('month', purchase_ts) AS month, COUNT(*) AS order_count FROM w_orders
           GROUP BY 1 ORDER BY order_count DESC, month LIMIT 1""",
    ),
    "monthly_order_growth": star_entry(
        orders.monthly_order_growth,
        """SELECT month, total_orders, prev_month_orders,
                  CAST(total_orders - prev_month_orders AS DOUBLE) / NULLIF(prev_month_orders, 0) AS growth_rate
           FROM (SELECT month, total_orders, LAG(total_orders) OVER (ORDER BY month) AS prev_month_orders
                 FROM (SELECT DATE_TRUNC('month', purchase_ts) AS month, COUNT(order_id) AS total_orders
                       FROM w_orders GROUP BY 1))""",
    ),
    "customers_with_most_orders": star_entry(
        orders.customers_with_most_orders,
        """SELECT c.person_id, COUNT(o.order_id) AS order_count
           FROM w_orders o JOIN w_customers c ON o.customer_id = c.customer_id GROUP BY c.person_id
           ORDER BY order_count DESC, c.person_id LIMIT 10""",
    ),
    "customers_active_in_four_months": star_entry(
        orders.customers_active_in_months,
        """SELECT c.person_id, COUNT(DISTINCT DATE_TRUNC('month', o.purchase_ts)) AS months_with_orders
           FROM w_orders o JOIN w_customers c ON o.customer_id = c.customer_id GROUP BY c.person_id
           HAVING COUNT(DISTINCT DATE_TRUNC('month', o.purchase_ts)) >= 4""",
    ),
    "on_time_by_month": star_entry(
        orders.on_time_by_month,
        """SELECT CAST(EXTRACT(MONTH FROM delivered_ts) AS INTEGER) AS month,
                  CAST(COUNT(CASE WHEN delivered_ts <= estimated_ts THEN 1 END) AS DOUBLE) / COUNT(*) * 100
                      AS on_time_delivery_rate
           FROM w_tracked GROUP BY 1""",
    ),
    "late_delivery_pct": star_entry(
        orders.late_delivery_pct,
        """SELECT CAST(COUNT(CASE WHEN delivered_ts > estimated_ts THEN 1 END) * 100 AS DOUBLE) / COUNT(*)
                      AS late_delivery_pct
           FROM w_tracked WHERE delivered_ts IS NOT NULL AND estimated_ts IS NOT NULL""",
    ),
    "avg_delivery_days": star_entry(
        orders.avg_delivery_days,
        """SELECT AVG(DATE_DIFF('day', purchase_ts, delivered_ts)) AS avg_delivery_days
           FROM w_tracked WHERE delivered_ts IS NOT NULL""",
    ),
    "delivery_days_by_state": star_entry(
        orders.delivery_days_by_state,
        """SELECT c.state, AVG(DATE_DIFF('day', purchase_ts, delivered_ts)) AS avg_delivery_days
           FROM w_tracked o JOIN w_customers c ON o.customer_id = c.customer_id
           WHERE delivered_ts IS NOT NULL GROUP BY c.state""",
    ),
    "approval_to_delivery_by_state": star_entry(
        orders.approval_to_delivery_by_state,
        """SELECT c.state, AVG(DATE_DIFF('day', approved_at, delivered_ts)) AS avg_approval_to_delivery_days
           FROM w_tracked o JOIN w_customers c ON o.customer_id = c.customer_id
           WHERE approved_at IS NOT NULL AND delivered_ts IS NOT NULL GROUP BY c.state""",
    ),
    "state_order_rank": star_entry(
        orders.state_order_rank,
        """SELECT c.state, COUNT(o.order_id) AS order_count,
                  RANK() OVER (ORDER BY COUNT(o.order_id) DESC) AS state_rank
           FROM w_orders o JOIN w_customers c ON o.customer_id = c.customer_id GROUP BY c.state""",
    ),
}

ITEMS_OF_YEAR = """SELECT CAST(SUM(freight) AS DOUBLE) AS total_freight FROM w_items
    WHERE order_id IN (SELECT order_id FROM {table} WHERE EXTRACT(YEAR FROM {column}) = {year})"""

ITEMS_TO_CUSTOMERS = """w_items i JOIN w_orders o ON i.order_id = o.order_id
    JOIN w_customers c ON o.customer_id = c.customer_id"""

TRANSLATED_REVENUE = """SELECT t.category_english, CAST(SUM(i.price) AS DOUBLE) AS total_revenue
    FROM w_items i JOIN w_products p ON i.product_id = p.product_id
    JOIN w_translation t ON p.category = t.category GROUP BY t.category_english"""


def _top_sellers_sql(value: str, n: int) -> str:
    return f"""SELECT state, seller_id, CAST(v AS DOUBLE) AS total_revenue FROM (
        SELECT s.state, s.seller_id, SUM({value}) AS v,
               ROW_NUMBER() OVER (PARTITION BY s.state ORDER BY SUM({value}) DESC, s.seller_id) AS rn
        FROM w_items i JOIN w_sellers s ON i.seller_id = s.seller_id GROUP BY s.state, s.seller_id)
        WHERE rn <= {n}"""


SALES: dict[str, Entry] = {
    "total_revenue": star_entry(
        sales.total_revenue, "SELECT CAST(SUM(price) AS DOUBLE) AS total_revenue FROM w_items"
    ),
    "avg_freight": star_entry(
        sales.avg_freight, "SELECT CAST(SUM(freight) AS DOUBLE) / COUNT(freight) AS avg_freight FROM w_items"
    ),
    "avg_price_in_category": star_entry(
        sales.avg_price_in_category,
        """SELECT CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_price FROM w_items
           WHERE product_id IN (SELECT product_id FROM w_products WHERE category = 'PROMO')""",
        category="PROMO",
    ),
    "freight_of_orders_placed_in_year": star_entry(
        sales.freight_of_orders_placed_in,
        ITEMS_OF_YEAR.format(table="w_orders", column="purchase_ts", year=1998), year=1998,
    ),
    "freight_of_orders_delivered_in_year": star_entry(
        sales.freight_of_orders_delivered_in,
        ITEMS_OF_YEAR.format(table="w_tracked", column="delivered_ts", year=1998), year=1998,
    ),
    "freight_of_orders_delivered_in_previous_year": star_entry(
        sales.freight_of_orders_delivered_in,
        ITEMS_OF_YEAR.format(table="w_tracked", column="delivered_ts", year=1997), year=1997,
    ),
    "avg_order_value_by_city": star_entry(
        sales.avg_order_value_by_city,
        f"""SELECT c.city, c.state, CAST(SUM(i.price + i.freight) AS DOUBLE) / COUNT(i.price + i.freight) AS avg_order_value
            FROM {ITEMS_TO_CUSTOMERS} GROUP BY c.city, c.state""",
    ),
    "revenue_by_customer_state": star_entry(
        sales.revenue_by_customer_state,
        f"""SELECT c.state, CAST(SUM(i.price) AS DOUBLE) AS total_revenue FROM {ITEMS_TO_CUSTOMERS}
            GROUP BY c.state""",
    ),
    "states_with_high_order_value": star_entry(
        sales.states_with_avg_order_value_above,
        f"""SELECT c.state, CAST(SUM(i.price + i.freight) AS DOUBLE) / COUNT(i.price + i.freight) AS avg_order_value
            FROM {ITEMS_TO_CUSTOMERS} GROUP BY c.state
            HAVING CAST(SUM(i.price + i.freight) AS DOUBLE) / COUNT(i.price + i.freight) > 55000""",
        threshold=55000.0,
    ),
    "running_monthly_revenue": star_entry(
        sales.running_monthly_revenue,
        """SELECT month, CAST(r AS DOUBLE) AS revenue, CAST(SUM(r) OVER (ORDER BY month) AS DOUBLE) AS running_total
           FROM (SELECT DATE_TRUNC('month', o.purchase_ts) AS month, SUM(i.price) AS r
                 FROM w_items i JOIN w_orders o ON i.order_id = o.order_id GROUP BY 1)""",
    ),
    "revenue_by_seller_city": star_entry(
        sales.revenue_by_seller_city,
        """SELECT s.city, s.state, CAST(SUM(i.price + i.freight) AS DOUBLE) AS total_revenue
           FROM w_items i JOIN w_sellers s ON i.seller_id = s.seller_id GROUP BY s.city, s.state""",
    ),
    "top_three_sellers_per_state": star_entry(
        sales.top_sellers_per_state, _top_sellers_sql("i.price + i.freight", 3)
    ),
    "top_two_sellers_per_state_by_price": star_entry(
        sales.top_sellers_per_state, _top_sellers_sql("i.price", 2), n=2, with_freight=False
    ),
    "best_seller": star_entry(
        sales.best_seller,
        """SELECT seller_id, CAST(SUM(price) AS DOUBLE) AS total_revenue FROM w_items GROUP BY seller_id
           ORDER BY SUM(price) DESC, seller_id LIMIT 1""",
    ),
    "avg_items_per_seller": star_entry(
        sales.avg_items_per_seller,
        """SELECT AVG(item_count) AS avg_items_per_seller
           FROM (SELECT seller_id, COUNT(*) AS item_count FROM w_items GROUP BY seller_id)""",
    ),
    "freight_by_seller_state": star_entry(
        sales.freight_by_seller_state,
        """SELECT s.state, CAST(SUM(i.freight) AS DOUBLE) AS total_freight,
                  CAST(SUM(i.freight) AS DOUBLE) / COUNT(i.freight) AS avg_freight
           FROM w_items i JOIN w_sellers s ON i.seller_id = s.seller_id GROUP BY s.state""",
    ),
    "seller_running_total_by_state": star_entry(
        sales.seller_running_total_by_state,
        """SELECT state, month, CAST(v AS DOUBLE) AS sales,
                  CAST(SUM(v) OVER (PARTITION BY state ORDER BY month) AS DOUBLE) AS running_total
           FROM (SELECT s.state, DATE_TRUNC('month', o.purchase_ts) AS month, SUM(i.price) AS v
                 FROM w_items i JOIN w_orders o ON i.order_id = o.order_id
                 JOIN w_sellers s ON i.seller_id = s.seller_id GROUP BY 1, 2)""",
    ),
    "multi_item_orders": star_entry(
        sales.orders_with_more_items_than,
        """SELECT COUNT(*) AS multi_item_orders
           FROM (SELECT order_id FROM w_items GROUP BY order_id HAVING COUNT(*) > 3)""",
    ),
    "top_categories_by_sales": star_entry(
        sales.top_categories_by_sales,
        """SELECT p.category, CAST(SUM(i.price) AS DOUBLE) AS total_sales
           FROM w_items i JOIN w_products p ON i.product_id = p.product_id GROUP BY p.category
           ORDER BY SUM(i.price) DESC, p.category LIMIT 10""",
    ),
    "translated_category_revenue": star_entry(sales.revenue_by_translated_category, TRANSLATED_REVENUE),
    "busy_categories": star_entry(
        sales.categories_with_more_items_than,
        """SELECT p.category, COUNT(*) AS order_count FROM w_items i JOIN w_products p ON i.product_id = p.product_id
           GROUP BY p.category HAVING COUNT(*) > 10000""",
        n=10000,
    ),
    "top_products_per_category": star_entry(
        sales.top_products_per_category,
        """SELECT category, product_id, order_count FROM (
               SELECT p.category, p.product_id, COUNT(i.order_item_id) AS order_count,
                      ROW_NUMBER() OVER (PARTITION BY p.category
                                         ORDER BY COUNT(i.order_item_id) DESC, p.product_id) AS rn
               FROM w_items i JOIN w_products p ON i.product_id = p.product_id GROUP BY p.category, p.product_id)
           WHERE rn <= 3""",
    ),
    "weight_freight_correlation": star_entry(
        sales.weight_freight_correlation,
        """SELECT (n * xy - x * y) / sqrt((n * xx - x * x) * (n * yy - y * y)) AS weight_freight_correlation
           FROM (SELECT CAST(COUNT(*) AS DOUBLE) AS n, CAST(SUM(w) AS DOUBLE) AS x, CAST(SUM(w * w) AS DOUBLE) AS xx,
                        CAST(SUM(w * freight) AS DOUBLE) AS xy, CAST(SUM(freight) AS DOUBLE) AS y,
                        CAST(SUM(freight * freight) AS DOUBLE) AS yy
                 FROM (SELECT CAST(p.weight_g AS BIGINT) AS w, CAST(i.freight AS DECIMAL(17,4)) AS freight
                       FROM w_items i JOIN w_products p ON i.product_id = p.product_id
                       WHERE p.weight_g IS NOT NULL AND i.freight IS NOT NULL))""",
    ),
    "max_product_weight": star_entry(sales.max_weight, "SELECT MAX(weight_g) AS max_weight_g FROM w_products"),
    "category_count": star_entry(
        sales.category_count, "SELECT COUNT(DISTINCT category) AS category_count FROM w_products"
    ),
    "heavy_products": star_entry(
        sales.products_heavier_than, "SELECT COUNT(*) AS heavy_products FROM w_products WHERE weight_g > 5000"
    ),
    "products_with_many_photos": star_entry(
        sales.products_with_more_photos_than,
        "SELECT COUNT(*) AS products_with_many_photos FROM w_products WHERE photos > 3",
    ),
    "avg_weight_by_category": star_entry(
        sales.avg_weight_by_category,
        "SELECT category, AVG(weight_g) AS avg_weight FROM w_products GROUP BY category",
    ),
    "avg_description_length_by_category": star_entry(
        sales.avg_description_length_by_category,
        "SELECT category, AVG(description_length) AS avg_desc_length FROM w_products GROUP BY category",
    ),
    "products_growing_every_quarter": star_entry(
        sales.products_growing_every_quarter,
        """SELECT product_id, COUNT(*) AS periods FROM (
               SELECT product_id, n, LEAD(n) OVER (PARTITION BY product_id ORDER BY q) AS following
               FROM (SELECT i.product_id, DATE_TRUNC('quarter', o.purchase_ts) AS q, COUNT(*) AS n
                     FROM w_items i JOIN w_orders o ON i.order_id = o.order_id
                     WHERE EXTRACT(YEAR FROM o.purchase_ts) = 1998 GROUP BY 1, 2))
           GROUP BY product_id
           HAVING MIN(CASE WHEN following IS NULL OR following > n THEN 1 ELSE 0 END) = 1 AND COUNT(*) > 1""",
        year=1998,
    ),
}

PAYMENTS_TO_CUSTOMERS = """w_payments p JOIN w_orders o ON p.order_id = o.order_id
    JOIN w_customers c ON o.customer_id = c.customer_id"""

PAYMENTS: dict[str, Entry] = {
    "total_payments": star_entry(
        payments.total_payments, "SELECT CAST(SUM(payment_value) AS DOUBLE) AS total_payments FROM w_payments"
    ),
    "urgent_payments": star_entry(
        payments.payments_of_type,
        """SELECT CAST(SUM(payment_value) AS DOUBLE) AS total_payments FROM w_payments
           WHERE payment_type = '1-URGENT'""",
        payment_type="1-URGENT",
    ),
    "installment_payments": star_entry(
        payments.payments_with_more_installments_than,
        "SELECT CAST(SUM(payment_value) AS DOUBLE) AS total_payments FROM w_payments WHERE installments > 1",
    ),
    "orders_paid_by_type": star_entry(
        payments.orders_paid_by,
        "SELECT COUNT(DISTINCT order_id) AS order_count FROM w_payments WHERE payment_type = '2-HIGH'",
        payment_type="2-HIGH",
    ),
    "distinct_payment_types": star_entry(
        payments.distinct_payment_types, "SELECT DISTINCT payment_type FROM w_payments"
    ),
    "revenue_by_payment_type": star_entry(
        payments.revenue_by_payment_type,
        """SELECT payment_type, CAST(SUM(payment_value) AS DOUBLE) AS total_revenue FROM w_payments
           GROUP BY payment_type""",
    ),
    "avg_installments_by_type": star_entry(
        payments.avg_installments_by_type,
        "SELECT payment_type, AVG(installments) AS avg_installments FROM w_payments GROUP BY payment_type",
    ),
    "payment_type_pct": star_entry(
        payments.payment_type_pct,
        """SELECT CAST(COUNT(CASE WHEN payment_type = '5-LOW' THEN 1 END) * 100 AS DOUBLE) / COUNT(*) AS pct
           FROM w_payments""",
        payment_type="5-LOW",
    ),
    "median_payment": star_entry(
        payments.median_payment,
        "SELECT MEDIAN(CAST(payment_value AS DOUBLE)) AS median_payment FROM w_payments",
    ),
    "state_payment_rank": star_entry(
        payments.state_payment_rank,
        f"""SELECT state, total_payments, RANK() OVER (ORDER BY total_payments DESC) AS rank
            FROM (SELECT c.state, CAST(SUM(p.payment_value) AS DOUBLE) AS total_payments
                  FROM {PAYMENTS_TO_CUSTOMERS} GROUP BY c.state)""",
    ),
    "customer_lifetime_value": star_entry(
        payments.customer_lifetime_value,
        f"""SELECT person_id, total_paid, order_count, RANK() OVER (ORDER BY total_paid DESC) AS rank
            FROM (SELECT c.person_id, CAST(SUM(p.payment_value) AS DOUBLE) AS total_paid,
                         COUNT(DISTINCT o.order_id) AS order_count
                  FROM {PAYMENTS_TO_CUSTOMERS} GROUP BY c.person_id)
            ORDER BY rank, person_id LIMIT 20""",
    ),
    "orders_and_avg_payment_by_state": star_entry(
        payments.orders_and_avg_payment_by_state,
        f"""SELECT c.state, COUNT(DISTINCT o.order_id) AS order_count,
                   CAST(SUM(p.payment_value) AS DOUBLE) / COUNT(p.payment_value) AS avg_payment
            FROM {PAYMENTS_TO_CUSTOMERS} GROUP BY c.state""",
    ),
    "monthly_payment_growth": star_entry(
        payments.monthly_payment_growth,
        """SELECT month, total_payments, prev_month_payments,
                  (total_payments - prev_month_payments) / NULLIF(prev_month_payments, 0) AS growth_rate
           FROM (SELECT month, total_payments, LAG(total_payments) OVER (ORDER BY month) AS prev_month_payments
                 FROM (SELECT DATE_TRUNC('month', o.purchase_ts) AS month,
                              CAST(SUM(p.payment_value) AS DOUBLE) AS total_payments
                       FROM w_payments p JOIN w_orders o ON p.order_id = o.order_id GROUP BY 1))""",
    ),
}

REVIEWED_CATEGORIES = """SELECT p.category, AVG(r.score) AS avg_score
    FROM w_products p JOIN w_items i ON p.product_id = i.product_id JOIN w_reviews r ON i.order_id = r.order_id
    GROUP BY p.category"""

REVIEWS: dict[str, Entry] = {
    "max_review_score": star_entry(reviews.max_score, "SELECT MAX(score) AS max_score FROM w_reviews"),
    "min_review_score": star_entry(reviews.min_score, "SELECT MIN(score) AS min_score FROM w_reviews"),
    "avg_review_score": star_entry(reviews.avg_score, "SELECT AVG(score) AS avg_score FROM w_reviews"),
    "review_score_extremes": star_entry(
        reviews.score_extremes,
        "SELECT MAX(score) AS max_score, MIN(score) AS min_score, AVG(score) AS avg_score FROM w_reviews",
    ),
    "review_score_by_status": star_entry(
        reviews.avg_score_by_status,
        """SELECT o.status, AVG(r.score) AS avg_review FROM w_orders o JOIN w_reviews r ON o.order_id = r.order_id
           GROUP BY o.status""",
    ),
    "review_score_by_category": star_entry(reviews.avg_score_by_category, REVIEWED_CATEGORIES),
    "best_reviewed_categories": star_entry(
        reviews.best_reviewed_categories, f"{REVIEWED_CATEGORIES} ORDER BY avg_score DESC, p.category LIMIT 10"
    ),
    "review_score_by_seller_state": star_entry(
        reviews.avg_score_by_seller_state,
        """SELECT s.state, AVG(r.score) AS avg_score FROM w_sellers s JOIN w_items i ON s.seller_id = i.seller_id
           JOIN w_reviews r ON i.order_id = r.order_id GROUP BY s.state""",
    ),
    "poorly_reviewed_sellers": star_entry(
        reviews.sellers_with_avg_score_below,
        """SELECT i.seller_id, AVG(r.score) AS avg_score FROM w_items i JOIN w_reviews r ON i.order_id = r.order_id
           GROUP BY i.seller_id HAVING AVG(r.score) < 3""",
    ),
    "monthly_orders_and_review_score": star_entry(
        reviews.monthly_orders_and_score,
        """SELECT DATE_TRUNC('month', o.purchase_ts) AS month, COUNT(DISTINCT o.order_id) AS order_count,
                  AVG(r.score) AS avg_review
           FROM w_orders o JOIN w_reviews r ON o.order_id = r.order_id GROUP BY 1""",
    ),
}


def _count_sql(kind: str, where: str = "") -> str:
    return f"SELECT COUNT({kind}_id) AS {kind}_count FROM w_{kind}s {where}"


PEOPLE: dict[str, Entry] = {
    **{
        f"customers_in_{state.lower()}": star_entry(
            people.customers_in_state, _count_sql("customer", f"WHERE state = '{state}'"), state=state
        )
        for state in ("NATION_3", "NATION_12", "NATION_20")
    },
    "customers_in_city": star_entry(
        people.customers_in_city, _count_sql("customer", "WHERE city = 'BUILDING'"), city="BUILDING"
    ),
    "unique_customers": star_entry(
        people.unique_customers, "SELECT COUNT(DISTINCT person_id) AS unique_customers FROM w_customers"
    ),
    "seller_count": star_entry(people.seller_count, _count_sql("seller")),
    "sellers_in_state": star_entry(
        people.sellers_in_state, _count_sql("seller", "WHERE state = 'NATION_9'"), state="NATION_9"
    ),
    "sellers_in_city": star_entry(
        people.sellers_in_city, _count_sql("seller", "WHERE city = 'EUROPE'"), city="EUROPE"
    ),
    "sellers_per_state": star_entry(
        people.sellers_per_state, "SELECT state, COUNT(*) AS seller_count FROM w_sellers GROUP BY state"
    ),
    "cities_with_most_sellers": star_entry(
        people.cities_with_most_sellers,
        """SELECT city, COUNT(*) AS seller_count FROM w_sellers GROUP BY city
           ORDER BY seller_count DESC, city LIMIT 5""",
    ),
}

ENTRIES: dict[str, Entry] = {**ORDERS, **SALES, **PAYMENTS, **REVIEWS, **PEOPLE}
