"""Report queries over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.expr import exact_avg, safe_ratio


def sales_trend(daily: DataFrame) -> DataFrame:
    columns = ["sales_date", "total_sales", "total_orders", "recorded_payment_value", "average_order_value"]
    return daily.select(*columns).orderBy("sales_date")


def segment_summary(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("customer_segment").agg(
        F.count("*").alias("customers"),
        F.sum("monetary").alias("revenue"),
        exact_avg(F.col("monetary")).alias("average_revenue"),
    )


def one_time_vs_repeat(customer_orders: DataFrame) -> DataFrame:
    per_customer = (
        customer_orders.filter(F.col("customer_unique_id").isNotNull())
        .groupBy("customer_unique_id")
        .agg(F.count_distinct("order_id").alias("orders"))
    )
    kind = F.when(F.col("orders") > 1, "repeat").otherwise("one-time")
    return per_customer.groupBy(kind.alias("customer_type")).agg(
        F.count("*").alias("customers"), F.sum("orders").alias("orders")
    )


def orders_by_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(F.count("*").alias("orders"))


def delivered_orders(orders: DataFrame) -> DataFrame:
    return orders.agg(F.count_if(F.col("order_status") == "delivered").alias("delivered_orders"))


def delivery_time_by_month(orders: DataFrame) -> DataFrame:
    dated = orders.filter(F.col("purchased_at").isNotNull())
    return dated.groupBy(F.trunc("purchased_at", "month").alias("purchase_month")).agg(
        F.avg("delivery_days").alias("actual_days"),
        F.avg("estimated_delivery_days").alias("estimated_days"),
        F.count("delivery_days").alias("delivered"),
    )


def late_deliveries_over_time(orders: DataFrame) -> DataFrame:
    dated = orders.filter(F.col("purchased_at").isNotNull())
    daily = dated.groupBy(F.to_date("purchased_at").alias("sales_date")).agg(
        F.count_if("delivered_late").alias("late_deliveries"),
        F.count("delivered_late").alias("deliveries"),
    )
    return daily.withColumn("late_rate", safe_ratio(F.col("late_deliveries"), F.col("deliveries")))


def top_products(products: DataFrame, measure: str = "total_revenue", n: int = 10) -> DataFrame:
    """Top n by revenue or by units; the key settles ties."""
    columns = ["product_id", "product_category_name", "units_sold", "total_revenue"]
    return products.select(*columns).orderBy(F.col(measure).desc(), "product_id").limit(n)


def top_sellers(sellers: DataFrame, n: int = 10) -> DataFrame:
    columns = ["seller_id", "seller_city", "units_sold", "total_revenue", "average_review_score"]
    return sellers.select(*columns).orderBy(F.col("total_revenue").desc(), "seller_id").limit(n)


def seller_delivery_performance(sellers: DataFrame) -> DataFrame:
    columns = ["seller_id", "total_orders", "late_orders", "late_order_rate", "average_delivery_days"]
    return sellers.select(*columns).filter(F.col("total_orders") > 0)


def category_performance(products: DataFrame) -> DataFrame:
    return products.groupBy("product_category_name").agg(
        F.count("*").alias("products"),
        F.sum("units_sold").alias("units_sold"),
        F.sum("order_count").alias("order_count"),
        F.sum("total_revenue").alias("total_revenue"),
        safe_ratio(F.sum("total_revenue"), F.sum("units_sold")).alias("revenue_per_unit"),
    )


def unpaid_delivered_note(unpaid: DataFrame) -> DataFrame:
    """Size of the known data-quality gap, shown next to the sales figures."""
    return unpaid.agg(
        F.count("*").alias("delivered_without_payment"),
        F.min("purchased_at").alias("first_purchase_at"),
        F.max("purchased_at").alias("last_purchase_at"),
    )
