"""Intermediate models: enriched orders, product sales, seller performance.

Every fan-out side is aggregated to the grain of the join key first, so no join
here multiplies rows and no join input is wider than it must be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.functions.expr import days_between, exact_avg
from bazaarlake.operators.latest import first_per_key


def order_item_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count("*").alias("item_count"),
        F.sum("price").alias("item_value"),
        F.sum("freight_value").alias("freight_value"),
    )


def order_payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("payment_value"),
        F.count("*").alias("payment_count"),
    )


def delivery_days() -> Column:
    return days_between(F.col("delivered_to_customer_at"), F.col("purchased_at"))


def estimated_delivery_days() -> Column:
    return days_between(F.col("estimated_delivery_at"), F.col("purchased_at"))


def delivered_late() -> Column:
    """NULL while either time is unknown; delivery exactly at the estimate is on time."""
    return F.col("delivered_to_customer_at") > F.col("estimated_delivery_at")


def _enriched_columns() -> list:
    return [
        "order_id",
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "order_status",
        "purchased_at",
        "approved_at",
        "delivered_to_carrier_at",
        "delivered_to_customer_at",
        "estimated_delivery_at",
        delivery_days().alias("delivery_days"),
        estimated_delivery_days().alias("estimated_delivery_days"),
        delivered_late().alias("delivered_late"),
        "item_count",
        "item_value",
        "freight_value",
        "payment_value",
        "payment_count",
    ]


def _people(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state")


def int_orders_enriched(
    orders: DataFrame, customers: DataFrame, items: DataFrame, payments: DataFrame
) -> DataFrame:
    """One row per order. Customers come first, while rows are narrow: a customer with
    very many orders skews only that join, which adaptive execution splits. The two
    order_id joins then share one even partitioning, which the result keeps."""
    return (
        orders.join(_people(customers), "customer_id", "left")
        .join(order_item_totals(items), "order_id", "left")
        .join(order_payment_totals(payments), "order_id", "left")
        .select(*_enriched_columns())
    )


def int_orders_enriched_by_order(
    orders: DataFrame, customers: DataFrame, items: DataFrame, payments: DataFrame
) -> DataFrame:
    """The same rows from inputs that are laid out by the order, one row per order id: orders, items and payments meet
    without an exchange. Only (order, customer) goes to the customers and comes back with their columns."""
    known, lost = orders.where("order_id IS NOT NULL"), orders.where("order_id IS NULL")
    buyers = known.select("order_id", "customer_id").join(_people(customers), "customer_id", "left").drop("customer_id")
    joined = (
        known.join(order_item_totals(items), "order_id", "left")
        .join(order_payment_totals(payments), "order_id", "left")
        .join(buyers, "order_id", "left")
        .select(*_enriched_columns())
    )
    none = [F.lit(None).cast(t).alias(c) for c, t in joined.select("item_count", "item_value", "freight_value", "payment_value", "payment_count").dtypes]
    without_id = lost.join(_people(customers), "customer_id", "left").select("*", *none).select(*_enriched_columns())
    return joined.unionByName(without_id)


def int_customer_orders(enriched: DataFrame) -> DataFrame:
    return enriched.select(
        "customer_unique_id",
        "customer_id",
        "order_id",
        "order_status",
        "customer_city",
        "customer_state",
        "purchased_at",
        "delivered_to_customer_at",
        "delivery_days",
        "estimated_delivery_days",
        "item_count",
        "item_value",
        "freight_value",
        "payment_value",
        "delivered_late",
    )


def int_product_sales(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(
        F.count("*").alias("units_sold"),
        F.count_distinct("order_id").alias("order_count"),
        F.sum("price").alias("total_revenue"),
        F.sum("freight_value").alias("total_freight"),
        exact_avg(F.col("price")).alias("average_item_price"),
    )


def _lines(items: DataFrame) -> DataFrame:
    """What an item adds to its seller's sums."""
    return items.select(
        "order_id",
        "seller_id",
        "product_id",
        F.lit(1).cast("long").alias("units"),
        F.col("price").alias("revenue"),
        F.col("price").isNotNull().cast("long").alias("priced"),
        F.col("freight_value").alias("freight"),
    )


def _first_of_basket() -> Column:
    """True for one item of each order and seller: what is known per order counts there, once."""
    return F.row_number().over(Window.partitionBy("order_id", "seller_id").orderBy("product_id")) == 1


def _sales_measures() -> list[Column]:
    return [
        F.sum("units").alias("units_sold"),
        F.count(F.when(F.col("first"), F.col("order_id"))).alias("order_count"),
        F.count_distinct("product_id").alias("product_count"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("freight").alias("total_freight"),
        F.try_divide(F.sum("revenue").cast("double"), F.sum("priced")).alias("average_item_price"),
    ]


def seller_sales(items: DataFrame) -> DataFrame:
    return _lines(items).withColumn("first", _first_of_basket()).groupBy("seller_id").agg(*_sales_measures())


def _first_order_rows(orders: DataFrame) -> DataFrame:
    """One row per order_id, earliest purchase first; a no-op unless untrimmed key
    spellings collided in staging. Same partitioning as the join that follows."""
    columns = ["purchased_at", "delivered_to_customer_at", "delivery_days", "delivered_late"]
    order = [F.col(c).asc_nulls_first() for c in columns]
    return first_per_key(orders.select("order_id", *columns), ["order_id"], *order)


def seller_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    pairs = items.select("seller_id", "order_id").distinct()
    return pairs.join(_first_order_rows(orders), "order_id").select(
        "seller_id",
        "order_id",
        "purchased_at",
        "delivered_to_customer_at",
        "delivery_days",
        "delivered_late",
    )


def seller_delivery(items: DataFrame, orders: DataFrame) -> DataFrame:
    return (
        seller_orders(items, orders)
        .groupBy("seller_id")
        .agg(
            F.avg("delivery_days").alias("average_delivery_days"),
            F.count_if("delivered_late").alias("late_orders"),
            F.count("*").alias("total_orders"),
        )
    )


def _first_review_rows(reviews: DataFrame) -> DataFrame:
    """One row per (order, review), earliest creation first."""
    order = [F.col(c).asc_nulls_first() for c in ("review_created_at", "review_score")]
    columns = ["order_id", "review_id", "review_score", "review_created_at"]
    return first_per_key(reviews.select(*columns), ["order_id", "review_id"], *order)


def seller_reviews(items: DataFrame, reviews: DataFrame) -> DataFrame:
    pairs = items.select("seller_id", "order_id").distinct()
    return pairs.join(_first_review_rows(reviews), "order_id").select(
        "seller_id", "order_id", "review_id", "review_score"
    )


def _order_review_totals(reviews: DataFrame) -> DataFrame:
    """Review sums per order, so that a seller never meets single reviews in a join."""
    return (
        _first_review_rows(reviews)
        .groupBy("order_id")
        .agg(
            F.sum("review_score").alias("score_sum"),
            F.count("review_score").alias("score_count"),
            F.count("*").alias("reviews"),
        )
    )


def seller_review_metrics(items: DataFrame, reviews: DataFrame) -> DataFrame:
    pairs = items.select("seller_id", "order_id").distinct()
    return (
        pairs.join(_order_review_totals(reviews), "order_id")
        .groupBy("seller_id")
        .agg(
            F.try_divide(F.sum("score_sum"), F.sum("score_count")).alias("average_review_score"),
            F.sum("reviews").alias("review_count"),
        )
    )


def seller_lines(items: DataFrame, orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Items with what is known of their order; inputs laid out by the order meet without an exchange."""
    delivery = _first_order_rows(orders).select(
        "order_id", "delivery_days", "delivered_late", F.lit(True).alias("has_order")
    )
    return (
        _lines(items)
        .join(delivery, "order_id", "left")
        .join(_order_review_totals(reviews), "order_id", "left")
        .withColumn("first", _first_of_basket())
    )


def int_seller_performance(items: DataFrame, orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Sales, delivery and reviews per seller from one scan of the items.

    Items meet narrow rows of their order, one each. All measures but the distinct product count add up per
    seller; the count is the only distinct one, so no row is copied for it. A seller with a third of all items is spread
    over its orders until the last, already partially aggregated step.
    """

    def once(name: str) -> Column:
        return F.when(F.col("first"), F.col(name))

    sellers = seller_lines(items, orders, reviews).groupBy("seller_id").agg(
        *_sales_measures(),
        F.avg(once("delivery_days")).alias("average_delivery_days"),
        F.count_if(F.col("first") & F.col("delivered_late")).alias("late"),
        F.nullif(F.count(once("has_order")), F.lit(0)).alias("total_orders"),
        F.try_divide(F.sum(once("score_sum")), F.sum(once("score_count"))).alias("average_review_score"),
        F.sum(once("reviews")).alias("review_count"),
    )
    known = F.col("seller_id").isNotNull()  # items without a seller have sales figures only
    return sellers.select(
        "seller_id",
        "units_sold",
        "order_count",
        "product_count",
        "total_revenue",
        "total_freight",
        "average_item_price",
        F.when(known, F.col("average_delivery_days")).alias("average_delivery_days"),
        F.when(known & F.col("total_orders").isNotNull(), F.col("late")).alias("late_orders"),
        F.when(known, F.col("total_orders")).alias("total_orders"),
        F.when(known, F.col("average_review_score")).alias("average_review_score"),
        F.when(known, F.col("review_count")).alias("review_count"),
    )
