"""Staging: latest version of each raw record, then cleaned names, types and text.

``history`` and ``ingest`` are the raw table and its append-only companion.
With ``normalize_keys`` the keys are cleaned before versions are compared, so
that two spellings of one key that differ in outer white space cannot both
survive; the default keeps them apart and leaves it to the uniqueness checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake import schemas as S
from bazaarlake.functions.expr import clean_text, lower_text
from bazaarlake.operators.latest import latest_per_key


def _key(name: str, normalized: bool):
    """A cleaned key. One that was cleaned before the window stays a bare column, so
    that a join on it reuses the partitioning of the window."""
    return F.col(name) if normalized else clean_text(F.col(name)).alias(name)


def _latest(history, ingest, entity, normalize_keys):
    version = version_of(entity)
    return latest_per_key(history, ingest, S.ENTITY[entity].keys, S.RECORD[entity], version, normalize_keys)


def version_of(entity: str):
    """What orders the appended versions of a record."""
    if entity == "customers":
        return F.coalesce(F.col("updated_at").try_cast("timestamp"), F.col("_ingested_at"))
    return F.col("_ingested_at")


def stg_customers(history: DataFrame, ingest: DataFrame, normalize_keys: bool = False) -> DataFrame:
    return cleaned_customers(_latest(history, ingest, "customers", normalize_keys), normalize_keys)


def cleaned_customers(rows: DataFrame, normalize_keys: bool = False) -> DataFrame:
    text = ["customer_unique_id", "customer_zip_code_prefix", "customer_city"]
    return rows.select(
        _key("customer_id", normalize_keys),
        *[clean_text(F.col(c)).alias(c) for c in text],
        lower_text(F.col("customer_state")).alias("customer_state"),
    )


def stg_orders(history: DataFrame, ingest: DataFrame, normalize_keys: bool = False) -> DataFrame:
    return cleaned_orders(_latest(history, ingest, "orders", normalize_keys), normalize_keys)


def cleaned_orders(rows: DataFrame, normalize_keys: bool = False) -> DataFrame:
    return rows.select(
        _key("order_id", normalize_keys),
        clean_text(F.col("customer_id")).alias("customer_id"),
        lower_text(F.col("order_status")).alias("order_status"),
        F.col("order_purchase_timestamp").alias("purchased_at"),
        F.col("order_approved_at").alias("approved_at"),
        F.col("order_delivered_carrier_date").alias("delivered_to_carrier_at"),
        F.col("order_delivered_customer_date").alias("delivered_to_customer_at"),
        F.col("order_estimated_delivery_date").alias("estimated_delivery_at"),
    )


def stg_order_items(history: DataFrame, ingest: DataFrame, normalize_keys: bool = False) -> DataFrame:
    return cleaned_order_items(_latest(history, ingest, "order_items", normalize_keys), normalize_keys)


def cleaned_order_items(rows: DataFrame, normalize_keys: bool = False) -> DataFrame:
    return rows.select(
        _key("order_id", normalize_keys),
        "order_item_id",
        clean_text(F.col("product_id")).alias("product_id"),
        clean_text(F.col("seller_id")).alias("seller_id"),
        F.col("shipping_limit_date").alias("shipping_limit_at"),
        "price",
        "freight_value",
    )


def stg_payments(history: DataFrame, ingest: DataFrame, normalize_keys: bool = False) -> DataFrame:
    return cleaned_payments(_latest(history, ingest, "payments", normalize_keys), normalize_keys)


def cleaned_payments(rows: DataFrame, normalize_keys: bool = False) -> DataFrame:
    return rows.select(
        _key("order_id", normalize_keys),
        "payment_sequential",
        lower_text(F.col("payment_type")).alias("payment_type"),
        "payment_installments",
        "payment_value",
    )


def stg_products(history: DataFrame, ingest: DataFrame, normalize_keys: bool = False) -> DataFrame:
    return cleaned_products(_latest(history, ingest, "products", normalize_keys), normalize_keys)


def cleaned_products(rows: DataFrame, normalize_keys: bool = False) -> DataFrame:
    return rows.select(
        _key("product_id", normalize_keys),
        "product_category_name",
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def stg_reviews(history: DataFrame, ingest: DataFrame, normalize_keys: bool = False) -> DataFrame:
    return cleaned_reviews(_latest(history, ingest, "reviews", normalize_keys), normalize_keys)


def cleaned_reviews(rows: DataFrame, normalize_keys: bool = False) -> DataFrame:
    return rows.select(
        _key("review_id", normalize_keys),
        _key("order_id", normalize_keys),
        "review_score",
        clean_text(F.col("review_comment_title")).alias("review_comment_title"),
        clean_text(F.col("review_comment_message")).alias("review_comment_message"),
        F.col("review_creation_date").alias("review_created_at"),
        F.col("review_answer_timestamp").alias("review_answered_at"),
    )


def stg_sellers(history: DataFrame, ingest: DataFrame, normalize_keys: bool = False) -> DataFrame:
    return cleaned_sellers(_latest(history, ingest, "sellers", normalize_keys), normalize_keys)


def cleaned_sellers(rows: DataFrame, normalize_keys: bool = False) -> DataFrame:
    return rows.select(
        _key("seller_id", normalize_keys),
        "seller_zip_code_prefix",
        clean_text(F.col("seller_city")).alias("seller_city"),
        lower_text(F.col("seller_state")).alias("seller_state"),
    )


def stg_geolocation(history: DataFrame) -> DataFrame:
    return history.select(
        clean_text(F.col("geolocation_zip_code_prefix").cast("string")).alias("geolocation_zip_code_prefix"),
        clean_text(F.col("geolocation_city")).alias("geolocation_city"),
        lower_text(F.col("geolocation_state")).alias("geolocation_state"),
        F.col("geolocation_lat").try_cast("double").alias("latitude"),
        F.col("geolocation_lng").try_cast("double").alias("longitude"),
    )


#: From the latest raw records of an entity to its staged rows.
CLEANED = {
    "customers": cleaned_customers,
    "orders": cleaned_orders,
    "order_items": cleaned_order_items,
    "payments": cleaned_payments,
    "products": cleaned_products,
    "reviews": cleaned_reviews,
    "sellers": cleaned_sellers,
}
