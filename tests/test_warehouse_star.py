"""All business questions over a loaded warehouse with awkward data: missing
values, several reviews and payments per order, dangling keys, people with many
customer rows, and one product, seller and order with a third of the items."""

import random
from datetime import datetime, timedelta

import duckdb
import pytest

from check import canonical
from storelens.catalog.entry import with_ctes
from storelens.catalog.questions import ENTRIES
from storelens.sources.csvload import load_all, load_csv
from storelens.sources.retail_schemas import RETAIL_FILES
from storelens.sources.star import WarehouseStar

# The star roles in SQL, over the loaded tables.
ROLES = {
    "w_orders": """SELECT ORDER_ID AS order_id, CUSTOMER_ID AS customer_id, ORDER_STATUS AS status,
        ORDER_PURCHASE_TIMESTAMP AS purchase_ts FROM ORDERS""",
    "w_tracked": """SELECT ORDER_ID AS order_id, CUSTOMER_ID AS customer_id, ORDER_STATUS AS status,
        ORDER_PURCHASE_TIMESTAMP AS purchase_ts, ORDER_APPROVED_AT AS approved_at,
        ORDER_DELIVERED_CUSTOMER_DATE AS delivered_ts, ORDER_ESTIMATED_DELIVERY_DATE AS estimated_ts FROM ORDERS""",
    "w_customers": """SELECT CUSTOMER_ID AS customer_id, CUSTOMER_UNIQUE_ID AS person_id, CUSTOMER_STATE AS state,
        CUSTOMER_CITY AS city FROM CUSTOMERS""",
    "w_sellers": "SELECT SELLER_ID AS seller_id, SELLER_STATE AS state, SELLER_CITY AS city FROM SELLERS",
    "w_items": """SELECT ORDER_ID AS order_id, ORDER_ITEM_ID AS order_item_id, PRODUCT_ID AS product_id,
        SELLER_ID AS seller_id, PRICE AS price, FREIGHT_VALUE AS freight FROM ORDER_ITEMS""",
    "w_payments": """SELECT ORDER_ID AS order_id, PAYMENT_TYPE AS payment_type, PAYMENT_INSTALLMENTS AS installments,
        PAYMENT_VALUE AS payment_value FROM ORDER_PAYMENTS""",
    "w_reviews": "SELECT ORDER_ID AS order_id, REVIEW_SCORE AS score FROM ORDER_REVIEWS",
    "w_products": """SELECT PRODUCT_ID AS product_id, PRODUCT_CATEGORY_NAME AS category, PRODUCT_WEIGHT_G AS weight_g,
        PRODUCT_PHOTOS_QTY AS photos, PRODUCT_DESCRIPTION_LENGTH AS description_length FROM PRODUCTS""",
    "w_translation": """SELECT PRODUCT_CATEGORY_NAME AS category, PRODUCT_CATEGORY_NAME_ENGLISH AS category_english
        FROM PRODUCT_CATEGORY_TRANSLATION""",
}
FILE_NAMES = {
    "CUSTOMERS": "shop_customers.csv", "ORDERS": "shop_orders.csv", "ORDER_ITEMS": "shop_order_items.csv",
    "ORDER_PAYMENTS": "shop_order_payments.csv", "ORDER_REVIEWS": "shop_order_reviews.csv", "PRODUCTS": "shop_products.csv",
    "SELLERS": "shop_sellers.csv", "GEOLOCATION": "shop_geolocation.csv",
    "PRODUCT_CATEGORY_TRANSLATION": "product_category_name_translation.csv",
    "SUPERSTORE_SALES": "Sample - Superstore.csv",
}


def made_tables(n=400):
    rng = random.Random(11)

    def maybe(value, share=0.1):
        return None if rng.random() < share else value

    def hot(prefix, many):
        return f"{prefix}0" if rng.random() < 1 / 3 else f"{prefix}{rng.randrange(many)}"

    def place():
        return f"NATION_{rng.randrange(25)}", rng.choice(["BUILDING", "EUROPE", "x, y"])

    def day(start=0):
        return datetime(1997, 1, 1) + timedelta(days=start + rng.randrange(700), seconds=rng.randrange(86400))

    money = lambda high: f"{rng.randrange(high * 100) / 100:.2f}"
    customers = []
    for i in range(n):
        state, city = place()
        customers.append((f"c{i}", hot("p", 60), "0123", city, maybe(state)))
    orders = []
    for i in range(n):
        bought = day()
        delivered = maybe(bought + timedelta(hours=rng.randrange(2400)), 0.2)
        orders.append((f"o{i}", f"c{rng.randrange(n + 20)}", rng.choice(["F", "O", "P"]), maybe(bought, 0.05),
                       maybe(bought), None, delivered, maybe(bought + timedelta(days=60))))
    items = [(hot("o", n + 20), rng.randrange(5), hot("r", 90), hot("s", 30), day(), maybe(money(90000)), maybe(money(500)))
             for _ in range(3 * n)]
    payments = [(f"o{rng.randrange(n + 9)}", 1, rng.choice(["1-URGENT", "2-HIGH", "5-LOW"]), rng.randrange(4), maybe(money(900)))
                for _ in range(2 * n)]
    reviews = [(f"v{i}", f"o{rng.randrange(n + 9)}", maybe(rng.randrange(1, 6)), None, "a \"quoted\", text", day(), day()) for i in range(n)]
    products = [(f"r{i}", maybe(rng.choice(["PROMO", "SMALL", "LARGE"])), 1, maybe(rng.randrange(90)), maybe(rng.randrange(7)),
                 maybe(rng.randrange(9000)), 1, 1, 1) for i in range(80)]
    sellers = [(f"s{i}", "0", place()[1], maybe(place()[0])) for i in range(28)]
    return {
        "CUSTOMERS": customers, "ORDERS": orders, "ORDER_ITEMS": items, "ORDER_PAYMENTS": payments, "ORDER_REVIEWS": reviews,
        "PRODUCTS": products, "SELLERS": sellers, "GEOLOCATION": [("1", "2.5", "-3.5", "c", "s")],
        "PRODUCT_CATEGORY_TRANSLATION": [("PROMO", "promo"), ("SMALL", "small"), ("NEVER", "never")],
        "SUPERSTORE_SALES": [(1, "CA-1", "11/8/2016", "11/11/2016", *["x, \"y\""] * 13, "261.96", 2, "0.2", "-41.9136")],
    }


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    source, target = tmp_path_factory.mktemp("files"), str(tmp_path_factory.mktemp("warehouse"))
    con = duckdb.connect()
    data = made_tables()
    for item in RETAIL_FILES:
        names = [column.split(" ")[0] for column in item.schema.split(", ")]
        lines = [",".join(names)]
        for row in data[item.table]:
            cells = ["" if v is None else str(v).replace('"', '""') for v in row]
            lines.append(",".join(f'"{c}"' if "," in c or '"' in c else c for c in cells))
        (source / FILE_NAMES[item.table]).write_text("\n".join(lines))
    # Patterns of the reader: orders must not take the files of order items, and so on.
    report = load_all(spark, str(source), target, RETAIL_FILES)
    assert report.filter("failure IS NOT NULL OR errors_seen > 0").count() == 0
    tables = {}
    for item in RETAIL_FILES:
        tables[item.table] = load_csv(spark, str(source), item.schema, f"{target}/{item.table}", item.pattern).rows
        assert tables[item.table].count() == len(data[item.table])
        con.register("frame", tables[item.table].toArrow())
        con.execute(f"CREATE TABLE {item.table} AS SELECT * FROM frame")
    return WarehouseStar({name: df.cache() for name, df in tables.items()}), con


@pytest.mark.parametrize("name", list(ENTRIES))
def test_question_on_the_warehouse(warehouse, name):
    star, con = warehouse
    df = ENTRIES[name].on_star(star)
    cursor = con.execute(with_ctes(ENTRIES[name].star_sql, ROLES))
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, df.collect()) == canonical(names, cursor.fetchall())
