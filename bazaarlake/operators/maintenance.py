"""Upkeep of the operational copy, as set-based jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: masters without a creation time date from before this instant.
HISTORY_CUTOFF = "2018-10-17 00:00:00"
REVIEW_HORIZON_DAYS = 7
REVIEW_DELAY_DAYS = 1


def add_column_if_missing(df: DataFrame, column: str, kind: T.DataType) -> DataFrame:
    return df if column in df.columns else df.withColumn(column, F.lit(None).cast(kind))


def add_lifecycle_columns(df: DataFrame) -> DataFrame:
    for column in ("created_at", "updated_at"):
        df = add_column_if_missing(df, column, T.StringType())
    return df


def backfill_timestamps(df: DataFrame, cutoff: str = HISTORY_CUTOFF) -> DataFrame:
    """Where the creation time is unknown, both times become the cutoff."""
    unknown = F.col("created_at").isNull()

    def filled(name: str):
        return F.when(unknown, F.lit(cutoff).cast(df.schema[name].dataType)).otherwise(F.col(name))

    return df.withColumns({"created_at": filled("created_at"), "updated_at": filled("updated_at")})


def historical_ids(df: DataFrame, column: str) -> DataFrame:
    """Distinct known ids of a historical export, as text."""
    return df.select(F.col(column).cast("string").alias(column)).dropna().distinct()


def _repaired(df: DataFrame, key: str, history: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows with a key outside history take the first and last purchase time, if any."""
    known = historical_ids(history, key).withColumn("_historical", F.lit(True))
    joined = df.join(known, key, "left").join(spans, key, "left")
    repair = F.col("_historical").isNull() & F.col("_first").isNotNull()

    def value(name: str, span: str):
        return F.when(repair, F.col(span).cast(df.schema[name].dataType)).otherwise(F.col(name)).alias(name)

    fixed = {"created_at": "_first", "updated_at": "_last"}
    return joined.select(*[value(c, fixed[c]) if c in fixed else F.col(c) for c in df.columns])


def _span(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(
        F.min("order_purchase_timestamp").alias("_first"), F.max("order_purchase_timestamp").alias("_last")
    )


def repair_customer_timestamps(customers: DataFrame, history: DataFrame, orders: DataFrame) -> DataFrame:
    return _repaired(customers, "customer_id", history, _span(orders, "customer_id"))


def _repair_through_items(df, key, history, items, orders):
    """Items are reduced to distinct (order, key) pairs before they meet the orders."""
    pairs = items.select("order_id", key).distinct()
    dated = pairs.join(orders.select("order_id", "order_purchase_timestamp"), "order_id")
    return _repaired(df, key, history, _span(dated, key))


def repair_product_timestamps(products, history, items, orders) -> DataFrame:
    return _repair_through_items(products, "product_id", history, items, orders)


def repair_seller_timestamps(sellers, history, items, orders) -> DataFrame:
    return _repair_through_items(sellers, "seller_id", history, items, orders)


def orders_awaiting_review(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Delivered orders with a known delivery time and no review."""
    delivered = orders.filter(
        (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNotNull()
    )
    reviewed = reviews.select("order_id").distinct()
    return delivered.join(reviewed, "order_id", "left_anti").select("order_id", "order_delivered_customer_date")


def reviewable_as_of(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Of those, the ones delivered a day or more before the last purchase plus a week."""
    last = orders.agg(F.max("order_purchase_timestamp")).scalar()
    today = last + F.make_dt_interval(F.lit(REVIEW_HORIZON_DAYS))
    waiting = orders_awaiting_review(orders, reviews)
    return waiting.filter(F.col("order_delivered_customer_date") + F.make_dt_interval(F.lit(REVIEW_DELAY_DAYS)) <= today)


