"""Schemas of the delimited files of the retail warehouse.

Fixed values: table names, columns and types, and the file name pattern from
which each table is loaded.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableFile:
    pattern: str
    table: str
    schema: str
    multi_line: bool = False  # free text with line breaks


RETAIL_FILES = (
    TableFile(
        "*customers*.csv", "CUSTOMERS",
        "CUSTOMER_ID string, CUSTOMER_UNIQUE_ID string, CUSTOMER_ZIP_CODE_PREFIX string, CUSTOMER_CITY string, "
        "CUSTOMER_STATE string",
    ),
    TableFile(
        "*orders*.csv", "ORDERS",
        "ORDER_ID string, CUSTOMER_ID string, ORDER_STATUS string, ORDER_PURCHASE_TIMESTAMP timestamp_ntz, "
        "ORDER_APPROVED_AT timestamp_ntz, ORDER_DELIVERED_CARRIER_DATE timestamp_ntz, "
        "ORDER_DELIVERED_CUSTOMER_DATE timestamp_ntz, ORDER_ESTIMATED_DELIVERY_DATE timestamp_ntz",
    ),
    TableFile(
        "*order_items*.csv", "ORDER_ITEMS",
        "ORDER_ID string, ORDER_ITEM_ID int, PRODUCT_ID string, SELLER_ID string, "
        "SHIPPING_LIMIT_DATE timestamp_ntz, PRICE decimal(12,2), FREIGHT_VALUE decimal(12,2)",
    ),
    TableFile(
        "*order_payments*.csv", "ORDER_PAYMENTS",
        "ORDER_ID string, PAYMENT_SEQUENTIAL int, PAYMENT_TYPE string, PAYMENT_INSTALLMENTS int, "
        "PAYMENT_VALUE decimal(12,2)",
    ),
    TableFile(
        "*order_reviews*.csv", "ORDER_REVIEWS",
        "REVIEW_ID string, ORDER_ID string, REVIEW_SCORE int, REVIEW_COMMENT_TITLE string, "
        "REVIEW_COMMENT_MESSAGE string, REVIEW_CREATION_DATE timestamp_ntz, REVIEW_ANSWER_TIMESTAMP timestamp_ntz",
        multi_line=True,
    ),
    TableFile(
        "*products*.csv", "PRODUCTS",
        "PRODUCT_ID string, PRODUCT_CATEGORY_NAME string, PRODUCT_NAME_LENGTH int, PRODUCT_DESCRIPTION_LENGTH int, "
        "PRODUCT_PHOTOS_QTY int, PRODUCT_WEIGHT_G int, PRODUCT_LENGTH_CM int, PRODUCT_HEIGHT_CM int, "
        "PRODUCT_WIDTH_CM int",
    ),
    TableFile(
        "*sellers*.csv", "SELLERS",
        "SELLER_ID string, SELLER_ZIP_CODE_PREFIX string, SELLER_CITY string, SELLER_STATE string",
    ),
    TableFile(
        "*geolocation*.csv", "GEOLOCATION",
        "GEOLOCATION_ZIP_CODE_PREFIX string, GEOLOCATION_LAT double, GEOLOCATION_LNG double, "
        "GEOLOCATION_CITY string, GEOLOCATION_STATE string",
    ),
    TableFile(
        "*product_category_name_translation*.csv", "PRODUCT_CATEGORY_TRANSLATION",
        "PRODUCT_CATEGORY_NAME string, PRODUCT_CATEGORY_NAME_ENGLISH string",
    ),
    TableFile(
        "*Superstore*.csv", "SUPERSTORE_SALES",
        "ROW_ID int, ORDER_ID string, ORDER_DATE string, SHIP_DATE string, SHIP_MODE string, CUSTOMER_ID string, "
        "CUSTOMER_NAME string, SEGMENT string, COUNTRY string, CITY string, STATE string, POSTAL_CODE string, "
        "REGION string, PRODUCT_ID string, CATEGORY string, SUB_CATEGORY string, PRODUCT_NAME string, "
        "SALES decimal(12,4), QUANTITY int, DISCOUNT decimal(4,2), PROFIT decimal(12,4)",
    ),
)
