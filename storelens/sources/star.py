"""The retail star schema, over the test tables or over a loaded warehouse.

Keys: ``order_id``, ``product_id`` and ``seller_id`` identify a row of their
table; ``customer_id`` identifies a row of customers, ``person_id`` the person
behind it, who may have many.  Money is decimal, so sums do not depend on the order in which partitions
arrive and a re-run after a lost executor gives the same digits.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.sources.tables import table

MONEY = "decimal(12,2)"


@dataclass(frozen=True)
class Star:
    """Role tables over one data directory; each property is a lazy scan."""

    spark: SparkSession
    sf_dir: str

    def _t(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @property
    def orders(self) -> DataFrame:
        return self._t("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderdate").alias("purchase_ts"),
        )

    @property
    def deliveries(self) -> DataFrame:
        """Approval and delivery time per order, from its shipments."""
        return self._t("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
            F.min("l_shipdate").alias("approved_at"),
            F.max("l_shipdate").alias("delivered_ts"),
        )

    @property
    def tracked_orders(self) -> DataFrame:
        """Orders with delivery times; NULL where nothing has shipped."""
        return self.orders.join(self.deliveries, "order_id", "left").withColumn(
            "estimated_ts", F.col("purchase_ts") + F.expr("INTERVAL 60 DAYS")
        )

    @property
    def customers(self) -> DataFrame:
        nation = self._t("nation").select("n_nationkey", F.col("n_name").alias("state"))
        return (
            self._t("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_custkey").alias("person_id"),
                "state",
                F.col("c_mktsegment").alias("city"),
            )
        )

    @property
    def sellers(self) -> DataFrame:
        nation = self._t("nation").select("n_nationkey", "n_regionkey", F.col("n_name").alias("state"))
        region = self._t("region").select("r_regionkey", F.col("r_name").alias("city"))
        return (
            self._t("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("s_suppkey").alias("seller_id"), "state", "city")
        )

    @property
    def items(self) -> DataFrame:
        return self.items_with()

    def items_with(self, *others: str) -> DataFrame:
        price = F.col("l_extendedprice").cast(MONEY)
        return self._t("lineitem").select(
            *others,
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            price.alias("price"),
            (price * F.col("l_tax").cast("decimal(4,2)")).alias("freight"),
        )

    def freight_per_order(self, delivered: Callable[[Column], Column]) -> DataFrame:
        """Freight of the orders whose delivery time is ``delivered``; shipments and
        freight come from one pass over the line items."""
        shipped = self.items_with("l_shipdate").groupBy("order_id").agg(
            F.max("l_shipdate").alias("delivered_ts"), F.sum("freight").alias("v")
        )
        return shipped.filter(delivered(F.col("delivered_ts"))).join(self.orders, "order_id", "left_semi")

    @property
    def payments(self) -> DataFrame:
        return self._t("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderpriority").alias("payment_type"),
            (1 + F.col("o_orderkey") % 6).alias("installments"),
            F.col("o_totalprice").cast(MONEY).alias("payment_value"),
        )

    @property
    def reviews(self) -> DataFrame:
        """One review per order that has items."""
        return self._t("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
            (1 + F.max("l_quantity").cast("int") % 5).alias("score")
        )

    @property
    def products(self) -> DataFrame:
        return self._t("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("category"),
            (F.col("p_size") * 200).alias("weight_g"),
            (F.col("p_size") % 7).alias("photos"),
            F.length("p_name").alias("description_length"),
        )

    @property
    def translation(self) -> DataFrame:
        """Category names with their translated form."""
        return (
            self._t("part")
            .select(F.col("p_type").alias("category"))
            .distinct()
            .withColumn("category_english", F.lower("category"))
        )


@dataclass(frozen=True)
class WarehouseStar:
    """The same roles over loaded warehouse tables, by upper-case table name."""

    tables: Mapping[str, DataFrame]

    def _pick(self, table_name: str, **columns: str) -> DataFrame:
        return self.tables[table_name].select(*[F.col(source).alias(role) for role, source in columns.items()])

    @property
    def orders(self) -> DataFrame:
        return self._pick(
            "ORDERS", order_id="ORDER_ID", customer_id="CUSTOMER_ID", status="ORDER_STATUS",
            purchase_ts="ORDER_PURCHASE_TIMESTAMP",
        )

    @property
    def tracked_orders(self) -> DataFrame:
        return self._pick(
            "ORDERS", order_id="ORDER_ID", customer_id="CUSTOMER_ID", status="ORDER_STATUS",
            purchase_ts="ORDER_PURCHASE_TIMESTAMP", approved_at="ORDER_APPROVED_AT",
            delivered_ts="ORDER_DELIVERED_CUSTOMER_DATE", estimated_ts="ORDER_ESTIMATED_DELIVERY_DATE",
        )

    @property
    def customers(self) -> DataFrame:
        return self._pick(
            "CUSTOMERS", customer_id="CUSTOMER_ID", person_id="CUSTOMER_UNIQUE_ID", state="CUSTOMER_STATE",
            city="CUSTOMER_CITY",
        )

    @property
    def sellers(self) -> DataFrame:
        return self._pick("SELLERS", seller_id="SELLER_ID", state="SELLER_STATE", city="SELLER_CITY")

    @property
    def items(self) -> DataFrame:
        return self._pick(
            "ORDER_ITEMS", order_id="ORDER_ID", order_item_id="ORDER_ITEM_ID", product_id="PRODUCT_ID",
            seller_id="SELLER_ID", price="PRICE", freight="FREIGHT_VALUE",
        )

    def freight_per_order(self, delivered: Callable[[Column], Column]) -> DataFrame:
        per_order = self.items.groupBy("order_id").agg(F.sum("freight").alias("v"))
        chosen = self.tracked_orders.filter(delivered(F.col("delivered_ts"))).select("order_id")
        return per_order.join(chosen, "order_id", "left_semi")

    @property
    def payments(self) -> DataFrame:
        return self._pick(
            "ORDER_PAYMENTS", order_id="ORDER_ID", payment_type="PAYMENT_TYPE", installments="PAYMENT_INSTALLMENTS",
            payment_value="PAYMENT_VALUE",
        )

    @property
    def reviews(self) -> DataFrame:
        return self._pick("ORDER_REVIEWS", order_id="ORDER_ID", score="REVIEW_SCORE")

    @property
    def products(self) -> DataFrame:
        return self._pick(
            "PRODUCTS", product_id="PRODUCT_ID", category="PRODUCT_CATEGORY_NAME", weight_g="PRODUCT_WEIGHT_G",
            photos="PRODUCT_PHOTOS_QTY", description_length="PRODUCT_DESCRIPTION_LENGTH",
        )

    @property
    def translation(self) -> DataFrame:
        return self._pick(
            "PRODUCT_CATEGORY_TRANSLATION", category="PRODUCT_CATEGORY_NAME",
            category_english="PRODUCT_CATEGORY_NAME_ENGLISH",
        )
