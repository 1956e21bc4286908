"""A third of all rows on one key: results stay whole, joins split, groups pre-aggregate."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from bazaarlake import schemas as S
from bazaarlake.operators import quality
from bazaarlake.plans import intermediate, marts

LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def eager_splits(spark):
    before = {k: spark.conf.get(k, None) for k in LIMITS}
    for key, value in LIMITS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


ORDERS = 60000


def orders(spark):
    """One customer has placed a third of all orders."""
    return spark.range(0, ORDERS, 1, 8).selectExpr(
        "CAST(id AS STRING) AS order_id",
        "IF(id % 3 = 0, 'hot', CAST(id % 5000 AS STRING)) AS customer_id",
        "'delivered' AS order_status",
        "TIMESTAMP '2020-01-01 00:00:00' + make_dt_interval(CAST(id % 90 AS INT)) AS purchased_at",
        "CAST(NULL AS TIMESTAMP) AS approved_at",
        "CAST(NULL AS TIMESTAMP) AS delivered_to_carrier_at",
        "TIMESTAMP '2020-06-01 00:00:00' AS delivered_to_customer_at",
        "TIMESTAMP '2020-05-01 00:00:00' AS estimated_delivery_at",
    )


def customers(spark):
    ids = spark.range(5000).selectExpr("CAST(id AS STRING) AS customer_id").union(spark.sql("SELECT 'hot'"))
    return ids.selectExpr("customer_id", "concat('U', customer_id) AS customer_unique_id", "'c' AS customer_city", "'s' AS customer_state")


def items(spark):
    """One order and one seller hold a third of all items."""
    return spark.range(0, ORDERS, 1, 8).selectExpr(
        "IF(id % 3 = 0, '7', CAST(id AS STRING)) AS order_id",
        "id AS order_item_id",
        "CAST(id % 50 AS STRING) AS product_id",
        "IF(id % 3 = 1, 'hot', CAST(id % 100 AS STRING)) AS seller_id",
        "TIMESTAMP '2020-01-01 00:00:00' AS shipping_limit_at",
        "CAST(2 AS DECIMAL(28,9)) AS price",
        "CAST(1 AS DECIMAL(28,9)) AS freight_value",
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    copy = df.select("*")
    copy.collect()
    return copy._jdf.queryExecution().executedPlan().toString()


def test_hot_customer_splits_the_join(eager_splits):
    spark = eager_splits
    people = customers(spark)
    joined = orders(spark).repartition(16, "order_id").join(people, "customer_id", "left")
    assert "skew=true" in final_plan(joined)
    payments = spark.createDataFrame([], S.PAYMENTS)
    enriched = intermediate.int_orders_enriched(orders(spark), people, items(spark), payments)
    assert enriched.count() == ORDERS
    assert enriched.filter("customer_unique_id = 'Uhot'").count() == ORDERS // 3


def test_hot_order_splits_the_item_join(eager_splits):
    spark = eager_splits
    facts = orders(spark).selectExpr("order_id", "customer_id", "customer_id AS customer_unique_id", "order_status", "purchased_at")
    out = marts.fct_order_items(items(spark).repartition(16, "order_item_id"), facts)
    assert "skew=true" in final_plan(out)
    assert out.count() == ORDERS and out.filter("order_id = '7'").count() == ORDERS // 3 + 1


def test_hot_seller_and_order_are_aggregated_exactly(spark):
    enriched = intermediate.int_orders_enriched(
        orders(spark), customers(spark), items(spark), spark.createDataFrame([], S.PAYMENTS)
    )
    reviews = spark.createDataFrame([("r", "7", 4, datetime(2020, 1, 1))], "review_id string, order_id string, review_score long, review_created_at timestamp")
    performance = intermediate.int_seller_performance(items(spark), enriched, reviews)
    hot = performance.filter("seller_id = 'hot'").first()
    assert (hot["units_sold"], hot["order_count"], hot["product_count"], hot["total_orders"]) == (20000, 20000, 50, 20000)
    assert performance.agg(F.sum("units_sold")).first()[0] == ORDERS


def test_group_measures_are_partially_aggregated(spark):
    enriched = orders(spark).selectExpr("customer_id AS customer_unique_id", "order_id")
    repeat = marts.customer_repeat_metrics(enriched)
    assert rows(repeat) == [(5001, 5001)]
    plan = repeat._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_hot_orphan_value_meets_the_join_as_one_row(spark):
    child = items(spark)
    bad = quality.relationships(child, "seller_id", spark.createDataFrame([("1",)], "seller_id string"), "seller_id")
    assert rows(bad.filter("seller_id = 'hot'")) == [("hot", 20000)]
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("HashAggregate")
