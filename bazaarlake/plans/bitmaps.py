"""Distinct orders and customers of days as bitmaps that add up: a month or the total needs the daily rows only.

Every order and every customer gets a number once. A day then has one bitmap per 32,768 numbers (``bitmap_construct_agg``), and the distinct count of
any set of days is the count of the bits of their union (``bitmap_or_agg``), exactly. New days are appended; no order is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER, CUSTOMER = "order", "customer"


def numbered(orders: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(kind, value, number) of the orders' ids and customers that ``known`` lacks; write it before it is used.

    Numbers are dense within a task, and those of a later call lie behind all known ones.
    """
    both = F.array(
        F.struct(F.lit(ORDER).alias("kind"), F.col("order_id").alias("value")),
        F.struct(F.lit(CUSTOMER).alias("kind"), F.col("customer_unique_id").alias("value")),
    )
    values = orders.select(F.inline(both)).where("value IS NOT NULL").distinct()
    number = F.monotonically_increasing_id()
    if known is not None:
        values = values.join(known.select("kind", "value"), ["kind", "value"], "left_anti")
        number = number + F.coalesce(known.agg(F.max("number") + 1).scalar(), F.lit(0))
    return values.select("kind", "value", number.alias("number"))


def daily_bitmaps(orders: DataFrame, numbers: DataFrame) -> DataFrame:
    """(sales_date, kind, bucket, bitmap) of the order fact; orders without a purchase time have no date."""
    both = F.array(
        F.struct(F.lit(ORDER).alias("kind"), F.col("order_id").alias("value")),
        F.struct(F.lit(CUSTOMER).alias("kind"), F.col("customer_unique_id").alias("value")),
    )
    # a customer with very many orders on a day is one row before it meets its number
    seen = orders.select(F.to_date("purchased_at").alias("sales_date"), F.inline(both)).where("value IS NOT NULL").distinct()
    placed = seen.join(numbers, ["kind", "value"]).select(
        "sales_date",
        "kind",
        F.bitmap_bucket_number("number").alias("bucket"),
        F.bitmap_bit_position("number").alias("position"),
    )
    return placed.groupBy("sales_date", "kind", "bucket").agg(F.bitmap_construct_agg("position").alias("bitmap"))


def distinct_counts(bitmaps: DataFrame, **period: Column) -> DataFrame:
    """total_orders and unique_customers of each period, columns made of ``sales_date``; of everything without one."""
    merged = bitmaps.groupBy(*[c.alias(name) for name, c in period.items()], "kind", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n")
    )

    def total(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))

    return merged.groupBy(*period).agg(total(ORDER).alias("total_orders"), total(CUSTOMER).alias("unique_customers"))
