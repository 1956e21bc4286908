"""Recency, frequency, monetary segments of customers with delivered orders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from bazaarlake.functions.expr import days_between
from bazaarlake.operators.ntile import MAX_BAND_ROWS, Ordering, with_ntiles
from bazaarlake.sources.tables import written

BUCKETS = 5
SCORES = {
    "recency_score": Ordering("recency", descending=True),
    "frequency_score": Ordering("frequency"),
    "monetary_score": Ordering("monetary"),
}


def rfm_base(customer_orders: DataFrame) -> DataFrame:
    delivered = customer_orders.filter(F.col("order_status") == "delivered")
    return delivered.groupBy("customer_unique_id").agg(
        F.max("purchased_at").alias("last_purchase_at"),
        F.count_distinct("order_id").alias("frequency"),
        F.sum(F.coalesce("payment_value", F.lit(0))).alias("monetary"),
    )


def rfm_metrics(base: DataFrame, latest: datetime | None = None) -> DataFrame:
    """Recency in days against the last purchase of anyone: ``latest`` if it is known already, otherwise
    a one-value subquery over the base, which should then be a written table."""
    last = F.lit(latest).cast("timestamp") if latest else base.agg(F.max("last_purchase_at")).scalar()
    dated = base.withColumn("analysis_date", last)
    return dated.select(
        "customer_unique_id",
        days_between(F.col("analysis_date"), F.col("last_purchase_at")).alias("recency"),
        "frequency",
        "monetary",
        "last_purchase_at",
        "analysis_date",
    )


def written_base(customer_orders: DataFrame, path: str | None = None) -> tuple[DataFrame, int, datetime | None]:
    """The base as a written table, its rows and the last purchase, both observed by the write."""
    seen = Observation()
    base = rfm_base(customer_orders).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.max("last_purchase_at").alias("latest")
    )
    stored = written(base, "rfm-base", path)
    return stored, seen.get["rows"], seen.get["latest"]


def rfm_scores(customer_orders: DataFrame, max_band: int = MAX_BAND_ROWS, path: str | None = None) -> DataFrame:
    """Five buckets over all customers for each measure; ties go by customer id.

    The per-customer base is written once, because finding the bucket borders
    scans it a few times; the result reads it too. It lies in the shared scratch folder, at ``path`` if
    given, and may be removed once the result is stored.
    """
    base, rows, latest = written_base(customer_orders, path)
    return with_ntiles(rfm_metrics(base, latest), BUCKETS, SCORES, "customer_unique_id", rows, max_band)


def segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    """Segment names and their score limits; the first match wins."""
    return (
        F.when((recency >= 4) & (frequency >= 4) & (monetary >= 4), "Champions")
        .when((recency >= 3) & (frequency >= 4) & (monetary >= 3), "Loyal Customers")
        .when((recency >= 4) & (frequency <= 2), "New Customers")
        .when((recency <= 2) & (frequency >= 3), "At Risk")
        .when((recency <= 2) & (frequency <= 2), "Hibernating")
        .otherwise("Potential Loyalists")
    )


def mart_customer_rfm(customer_orders: DataFrame, path: str | None = None) -> DataFrame:
    scored = rfm_scores(customer_orders, path=path)
    return scored.select(
        "customer_unique_id",
        "last_purchase_at",
        "analysis_date",
        "recency",
        "frequency",
        "monetary",
        *SCORES,
        F.concat(*[F.col(c).cast("string") for c in SCORES]).alias("rfm_score"),
        segment(*[F.col(c) for c in SCORES]).alias("customer_segment"),
    )
