"""The declared checks of the shop model and the batch gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.operators.quality import WARN, Check, composite_unique, expression_check
from bazaarlake.schemas import ENTITIES

# The columns each model declares as never NULL.
NOT_NULL = {
    "stg_customers": "customer_id customer_unique_id",
    "stg_orders": "order_id customer_id order_status purchased_at",
    "stg_order_items": "order_id order_item_id product_id seller_id price freight_value",
    "stg_products": "product_id",
    "stg_payments": "order_id payment_sequential payment_type payment_value",
    "stg_reviews": "review_id order_id review_score",
    "stg_sellers": "seller_id",
    "stg_geolocation": "geolocation_zip_code_prefix",
    "int_orders_enriched": "order_id customer_id order_status purchased_at",
    "int_customer_orders": "order_id customer_unique_id customer_id purchased_at order_status",
    "int_product_sales": "product_id units_sold order_count total_revenue",
    "int_seller_performance": "seller_id units_sold order_count total_revenue",
    "fct_orders": "order_id customer_id customer_unique_id order_status purchased_at item_count",
    "dim_customers": "customer_unique_id total_orders total_spend",
    "dim_products": "product_id units_sold order_count total_revenue total_freight average_item_price",
    "fct_order_items": (
        "order_id order_item_id customer_id customer_unique_id product_id seller_id "
        "order_status purchased_at price freight_value item_total_value"
    ),
    "dim_sellers": "seller_id units_sold order_count product_count total_revenue total_freight",
    "mart_customer_rfm": (
        "customer_unique_id last_purchase_at analysis_date recency frequency monetary "
        "recency_score frequency_score monetary_score customer_segment"
    ),
    "mart_daily_sales": "sales_date total_orders unique_customers total_sales",
    "mart_ingestion_monitoring": (
        "batch_id entity started_at completed_at records_fetched records_loaded "
        "duration_seconds status ingestion_result"
    ),
}

# The single-column keys.
UNIQUE = {
    "stg_customers": "customer_id",
    "stg_orders": "order_id",
    "stg_products": "product_id",
    "stg_sellers": "seller_id",
    "int_orders_enriched": "order_id",
    "int_customer_orders": "order_id",
    "int_product_sales": "product_id",
    "int_seller_performance": "seller_id",
    "fct_orders": "order_id",
    "dim_customers": "customer_unique_id",
    "dim_products": "product_id",
    "dim_sellers": "seller_id",
    "mart_customer_rfm": "customer_unique_id",
    "mart_daily_sales": "sales_date",
}

# Fixed values: (child, column, parent); the parent column has the same name.
RELATIONSHIPS = (
    ("stg_orders", "customer_id", "stg_customers"),
    ("stg_order_items", "order_id", "stg_orders"),
    ("stg_order_items", "product_id", "stg_products"),
    ("stg_order_items", "seller_id", "stg_sellers"),
    ("stg_payments", "order_id", "stg_orders"),
    ("stg_reviews", "order_id", "stg_orders"),
    ("fct_orders", "customer_id", "stg_customers"),
    ("fct_order_items", "order_id", "stg_orders"),
    ("fct_order_items", "product_id", "stg_products"),
    ("fct_order_items", "seller_id", "stg_sellers"),
)

STATUSES = ("SUCCESS", "FAILED")
RESULTS = ("SUCCESS_WITH_DATA", "SUCCESS_NO_NEW_DATA", "FAILED", "UNKNOWN")

MONITORING = "mart_ingestion_monitoring"


def bad_counts():
    fetched, loaded = F.col("records_fetched"), F.col("records_loaded")
    return (fetched < 0) | (loaded < 0) | (loaded > fetched)


def bad_duration():
    return (F.col("completed_at") < F.col("started_at")) | (F.col("duration_seconds") < 0)


def unpaid_delivery():
    return (F.col("order_status") == "delivered") & F.col("payment_count").isNull()


def delivered_without_payment(orders: DataFrame) -> DataFrame:
    return expression_check(orders, unpaid_delivery()).select("order_id", "order_status", "purchased_at")


def suite() -> list[Check]:
    checks = [Check(m, "not_null", (c,)) for m, columns in NOT_NULL.items() for c in columns.split()]
    checks += [Check(m, "unique", (c,)) for m, c in UNIQUE.items()]
    checks += [Check(m, "relationships", (c,), parent=p, parent_field=c) for m, c, p in RELATIONSHIPS]
    checks += [
        Check(MONITORING, "accepted_values", ("status",), values=STATUSES),
        Check(MONITORING, "accepted_values", ("ingestion_result",), values=RESULTS),
        Check("stg_reviews", "composite_unique", ("review_id", "order_id")),
        Check(MONITORING, "composite_unique", ("batch_id", "entity")),
        Check(MONITORING, "expression", bad=bad_counts, name="valid_record_counts"),
        Check(MONITORING, "expression", bad=bad_duration, name="valid_duration"),
        Check("fct_orders", "expression", bad=unpaid_delivery, name="paid_when_delivered", severity=WARN),
    ]
    return checks


def batch_problems(monitoring: DataFrame, batch_id: str | None = None) -> DataFrame:
    """One row per batch and expected entity with its problem, NULL where it is fine.

    Without ``batch_id`` every batch in the log is judged; with it, a batch that has
    left no row at all is reported too. Entities come in ingest order by ``position``.
    """
    spark = monitoring.sparkSession
    names = [(i + 1, e.name) for i, e in enumerate(ENTITIES)]
    if batch_id is None:
        batches = monitoring.select("batch_id").distinct()
    else:
        monitoring = monitoring.filter(F.col("batch_id") == batch_id)
        batches = spark.createDataFrame([(batch_id,)], "batch_id string")
    slots = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("entity")) for i, n in names])
    expected = batches.select("batch_id", F.inline(slots))
    bad = F.when(F.col("status").isNull(), "missing entity")
    bad = bad.when(F.col("status") != "SUCCESS", "not successful")
    bad = bad.when((F.col("records_loaded") < 0) | (F.col("records_fetched") < 0), "negative count")
    bad = bad.when(F.col("records_loaded") > F.col("records_fetched"), "more loaded than fetched")
    found = monitoring.select("batch_id", "entity", "status", "records_fetched", "records_loaded")
    return expected.join(found, ["batch_id", "entity"], "left").select(
        "batch_id", "position", "entity", "status", "records_fetched", "records_loaded", bad.alias("problem")
    )


class BatchInvalid(RuntimeError):
    """A batch did not pass the gate."""


def validate_batch(monitoring: DataFrame, batch_id: str) -> list[str]:
    """Raise unless all expected entities of the batch are there and sound; otherwise one
    report line per entity, in ingest order. Repeated log rows are merged first, so that
    only one row per expected entity reaches the driver."""
    judged = batch_problems(monitoring, batch_id).groupBy("position", "entity")
    merged = judged.agg(*[F.max(c).alias(c) for c in ("status", "records_fetched", "records_loaded", "problem")])
    rows = merged.orderBy("position").collect()
    if all(row["status"] is None for row in rows):
        raise BatchInvalid(f"no monitoring records for batch {batch_id}")
    problems = [f"{row['entity']}: {row['problem']}" for row in rows if row["problem"]]
    if problems:
        raise BatchInvalid(f"batch {batch_id}: " + "; ".join(problems))
    return [f"{r['entity']}: {r['records_loaded']} of {r['records_fetched']} loaded" for r in rows]
