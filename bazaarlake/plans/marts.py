"""Marts: facts, dimensions, daily sales, executive KPIs, ingestion monitoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.expr import blank_to, exact_avg, safe_ratio, seconds_between

# Counts of an empty order table are 0, its sums stay NULL.
COUNTERS = ("total_orders", "late_deliveries", "delivered_orders", "orders_with_payment")


def _or_zero(name: str):
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def fct_orders(enriched: DataFrame) -> DataFrame:
    """Item measures default to 0, payments stay NULL; the difference needs both sides."""
    difference = F.col("payment_value") - F.col("item_value")
    defaults = {"item_count", "item_value", "freight_value"}
    return enriched.select(
        *[_or_zero(c) if c in defaults else F.col(c) for c in enriched.columns],
        difference.alias("payment_item_value_difference"),
    )


def fct_order_items(items: DataFrame, enriched: DataFrame) -> DataFrame:
    """Items with their order's facts; an order with very many items skews only the
    item side of this join, which adaptive execution splits."""
    facts = enriched.select("order_id", "customer_id", "customer_unique_id", "order_status", "purchased_at")
    return items.join(facts, "order_id", "left").select(
        "order_id",
        "order_item_id",
        "customer_id",
        "customer_unique_id",
        "product_id",
        "seller_id",
        "shipping_limit_at",
        "order_status",
        "purchased_at",
        "price",
        "freight_value",
        (F.col("price") + F.col("freight_value")).alias("item_total_value"),
    )


def dim_customers(customer_orders: DataFrame) -> DataFrame:
    """One row per person. City and state are the first known ones by purchase time;
    an unknown purchase time sorts first, the order id settles ties."""

    def first_known(name: str):
        when = F.when(F.col(name).isNotNull(), F.struct("purchased_at", "order_id", name))
        return F.min(when).getField(name).alias(name)

    return customer_orders.groupBy("customer_unique_id").agg(
        first_known("customer_city"),
        first_known("customer_state"),
        F.min("purchased_at").alias("first_order_at"),
        F.max("purchased_at").alias("last_order_at"),
        F.count_distinct("order_id").alias("total_orders"),
        F.sum(F.coalesce("item_count", F.lit(0))).alias("total_items"),
        F.sum(F.coalesce("payment_value", F.lit(0))).alias("total_spend"),
        exact_avg(F.col("payment_value")).alias("average_order_value"),
        F.count_if(F.col("order_status") == "delivered").alias("delivered_orders"),
        F.count_if(F.col("order_status") == "canceled").alias("cancelled_orders"),
        F.count_if("delivered_late").alias("late_orders"),
    )


def dim_products(products: DataFrame, sales: DataFrame) -> DataFrame:
    measures = ["units_sold", "order_count", "total_revenue", "total_freight", "average_item_price"]
    joined = products.join(sales, "product_id", "left")
    return joined.select(
        "product_id",
        blank_to(F.col("product_category_name"), "unknown").alias("product_category_name"),
        *[c for c in products.columns if c not in ("product_id", "product_category_name")],
        *[_or_zero(c) for c in measures],
    )


def dim_sellers(sellers: DataFrame, performance: DataFrame) -> DataFrame:
    """Sums and counts default to 0; averages and the late rate stay NULL without orders."""
    kept = {"average_item_price", "average_delivery_days", "average_review_score"}
    measures = [c for c in performance.columns if c != "seller_id"]
    return sellers.join(performance, "seller_id", "left").select(
        *sellers.columns,
        *[F.col(c) if c in kept else _or_zero(c) for c in measures],
        safe_ratio(F.col("late_orders"), F.col("total_orders")).alias("late_order_rate"),
    )


def _measures(late: Column) -> dict[str, Column]:
    """What one order row adds to the sums of sales, delivery and payment."""
    return {
        "total_sales": F.col("item_value"),
        "sales_known": F.col("item_value").isNotNull().cast("long"),
        "total_freight": F.col("freight_value"),
        "recorded_payment_value": F.col("payment_value"),
        "days_sum": F.col("delivery_days"),
        "days_known": F.col("delivery_days").isNotNull().cast("long"),
        "late_deliveries": F.coalesce(late, F.lit(False)).cast("long"),
        "delivered_orders": F.coalesce(F.col("order_status") == "delivered", F.lit(False)).cast("long"),
        "orders_with_payment": F.col("payment_count").isNotNull().cast("long"),
    }


def _orders_and_customers(orders: DataFrame, keys: dict[str, Column], late: Column, order_of_customer: bool) -> DataFrame:
    """Per key the distinct orders with their sums (``whole``) and, as narrow rows, the distinct customers.

    Counting two things distinctly would triple the wide rows. Here a row is copied once, and the copy
    carries the customer alone, with the order id only if it is asked for.
    """
    measures = _measures(late)
    rows = orders.select(
        *[value.alias(name) for name, value in keys.items()],
        "order_id",
        "customer_unique_id",
        *[value.alias(name) for name, value in measures.items()],
    )
    kinds = {f.name: f.dataType for f in rows.schema.fields}

    def nothing(name: str) -> Column:
        return F.lit(None).cast(kinds[name]).alias(name)

    whole = F.struct(F.lit(True).alias("whole"), "order_id", nothing("customer_unique_id"), *measures)
    order = F.col("order_id") if order_of_customer else nothing("order_id")
    alone = F.struct(
        F.lit(False).alias("whole"), order.alias("order_id"), "customer_unique_id", *[nothing(name) for name in measures]
    )
    copies = rows.select(*keys, F.explode(F.array(whole, alone)).alias("copy")).select(*keys, "copy.*")
    return copies.groupBy(*keys, "whole", "order_id", "customer_unique_id").agg(
        *[F.sum(name).alias(name) for name in measures]
    )


def _sales_totals() -> list[Column]:
    """Aggregates over the rows of ``_orders_and_customers``; the narrow rows add nothing to sums."""
    return [
        F.count_if(F.col("whole") & F.col("order_id").isNotNull()).alias("total_orders"),
        F.count_if(~F.col("whole") & F.col("customer_unique_id").isNotNull()).alias("customers"),
        *[F.sum(name).alias(name) for name in _measures(F.lit(False))],
    ]


def _sales_columns() -> list[Column]:
    return [
        F.col("total_sales"),
        F.col("total_freight"),
        F.col("recorded_payment_value"),
        F.try_divide(F.col("total_sales").cast("double"), F.col("sales_known")).alias("average_order_value"),
        F.try_divide(F.col("days_sum").cast("double"), F.col("days_known")).alias("average_delivery_days"),
        _or_zero("late_deliveries"),
        _or_zero("delivered_orders"),
        _or_zero("orders_with_payment"),
    ]


def mart_daily_sales(orders: DataFrame) -> DataFrame:
    """Per purchase date, from the order fact. Late counts every status here."""
    dated = orders.filter(F.col("purchased_at").isNotNull())
    date = {"sales_date": F.to_date("purchased_at")}
    daily = _orders_and_customers(dated, date, F.col("delivered_late"), False).groupBy("sales_date").agg(*_sales_totals())
    return daily.select(
        "sales_date",
        "total_orders",
        F.col("customers").alias("unique_customers"),
        *_sales_columns(),
        safe_ratio(F.col("orders_with_payment"), F.col("total_orders")).alias("payment_coverage_rate"),
    )


def customer_repeat_metrics(orders: DataFrame) -> DataFrame:
    per_customer = (
        orders.filter(F.col("customer_unique_id").isNotNull())
        .groupBy("customer_unique_id")
        .agg(F.count_distinct("order_id").alias("orders"))
    )
    return per_customer.agg(
        F.count("*").alias("total_customers"),
        F.count_if(F.col("orders") > 1).alias("repeat_customers"),
    )


def overall_metrics(orders: DataFrame) -> DataFrame:
    """One row. Late counts delivered orders only here."""
    late = F.col("delivered_late") & (F.col("order_status") == "delivered")
    total = _orders_and_customers(orders, {}, late, False).agg(*_sales_totals())
    return total.select("total_orders", F.col("customers").alias("total_customers_with_orders"), *_sales_columns())


def mart_executive_kpis(orders: DataFrame) -> DataFrame:
    """The overall row and the repeat-customer figures in one pass over the orders.

    The distinct orders carry every measure, the distinct pairs of customer and order
    nothing but themselves. Both are spread by order before anything is summed up.
    """
    late = F.col("delivered_late") & (F.col("order_status") == "delivered")
    measures = list(_measures(late))
    counted = (
        _orders_and_customers(orders, {}, late, True)
        .groupBy("whole", "customer_unique_id")
        .agg(F.count("order_id").alias("orders"), *[F.sum(name).alias(name) for name in measures])
    )
    customer = ~F.col("whole") & F.col("customer_unique_id").isNotNull()
    total = counted.agg(
        F.sum(F.when(F.col("whole"), F.col("orders"))).alias("total_orders"),
        F.count_if(customer).alias("total_customers"),
        F.count_if(customer & (F.col("orders") > 1)).alias("repeat_customers"),
        *[F.sum(name).alias(name) for name in measures],
    )

    def counter(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    total = total.withColumns({name: counter(name) for name in COUNTERS})
    return total.select(
        "total_orders",
        F.col("total_customers").alias("total_customers_with_orders"),
        "total_sales",
        "total_freight",
        "recorded_payment_value",
        safe_ratio(F.col("total_sales"), F.col("sales_known")).alias("average_order_value"),
        safe_ratio(F.col("days_sum"), F.col("days_known")).alias("average_delivery_days"),
        "late_deliveries",
        "delivered_orders",
        "orders_with_payment",
        safe_ratio(F.col("orders_with_payment"), F.col("total_orders")).alias("payment_coverage_rate"),
        safe_ratio(F.col("late_deliveries"), F.col("delivered_orders")).alias("late_delivery_rate"),
        "total_customers",
        "repeat_customers",
        safe_ratio(F.col("repeat_customers"), F.col("total_customers")).alias("repeat_customer_rate"),
    )


def mart_ingestion_monitoring(audit: DataFrame) -> DataFrame:
    succeeded = F.col("status") == "SUCCESS"
    result = (
        F.when(succeeded & (F.col("records_loaded") > 0), "SUCCESS_WITH_DATA")
        .when(succeeded & (F.col("records_loaded") == 0), "SUCCESS_NO_NEW_DATA")
        .when(F.col("status") == "FAILED", "FAILED")
        .otherwise("UNKNOWN")
    )
    return audit.select(
        "batch_id",
        "entity",
        "started_at",
        "completed_at",
        "records_fetched",
        "records_loaded",
        seconds_between(F.col("completed_at"), F.col("started_at")).alias("duration_seconds"),
        "watermark_before",
        "watermark_after",
        "status",
        "error_message",
        result.alias("ingestion_result"),
    )
