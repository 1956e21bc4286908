from datetime import datetime

from conftest import rows
from pyspark.sql import types as T

from bazaarlake.operators import maintenance
from bazaarlake.schemas import ORDERS

T1, T2, T9 = datetime(2020, 1, 1), datetime(2020, 1, 2), datetime(2020, 1, 9)
MASTER = "customer_id string, created_at string, updated_at string"


def orders(spark, *data):
    return spark.createDataFrame([(k, c, s, t, None, None, d, None) for k, c, s, t, d in data], ORDERS)


def test_columns_are_added_once(spark):
    df = spark.createDataFrame([("1", "x")], "id string, created_at string")
    out = maintenance.add_lifecycle_columns(df)
    assert rows(out) == [("1", "x", None)]
    assert maintenance.add_column_if_missing(out, "id", T.LongType()) is out


def test_backfill_touches_rows_without_a_creation_time_only(spark):
    df = spark.createDataFrame([("1", None, "later"), ("2", "c", None)], MASTER)
    cutoff = maintenance.HISTORY_CUTOFF
    assert rows(maintenance.backfill_timestamps(df)) == [("1", cutoff, cutoff), ("2", "c", None)]


def test_repair_skips_historical_rows_and_rows_without_orders(spark):
    df = spark.createDataFrame([("old", "a", "b"), ("new", "a", "b"), ("idle", "a", "b")], MASTER)
    history = spark.createDataFrame([("old",), ("old",), (None,)], "customer_id string")
    bought = orders(spark, ("1", "new", "x", T2, None), ("2", "new", "x", T1, None), ("3", "old", "x", T1, None))
    assert rows(maintenance.repair_customer_timestamps(df, history, bought)) == [
        ("idle", "a", "b"), ("new", "2020-01-01 00:00:00", "2020-01-02 00:00:00"), ("old", "a", "b"),
    ]


def test_repair_through_items(spark):
    df = spark.createDataFrame([("s", None, None)], "seller_id string, created_at string, updated_at string")
    none = spark.createDataFrame([], "seller_id string")
    items = spark.createDataFrame([("1", "s"), ("1", "s"), ("2", "s"), ("9", "s")], "order_id string, seller_id string")
    bought = orders(spark, ("1", "c", "x", T1, None), ("2", "c", "x", T2, None))
    got = maintenance.repair_seller_timestamps(df, none, items, bought)
    assert rows(got) == [("s", "2020-01-01 00:00:00", "2020-01-02 00:00:00")]


def test_reviewable_orders(spark):
    bought = orders(
        spark, ("1", "c", "delivered", T1, T1), ("2", "c", "delivered", T2, datetime(2020, 1, 8)),
        ("3", "c", "delivered", T2, datetime(2020, 1, 8, 0, 0, 1)), ("4", "c", "shipped", T1, T1),
        ("5", "c", "delivered", T1, None), ("6", "c", "delivered", T1, T1),
    )
    reviews = spark.createDataFrame([("6",)], "order_id string")
    assert rows(maintenance.orders_awaiting_review(bought, reviews), "order_id") == [("1",), ("2",), ("3",)]
    assert rows(maintenance.reviewable_as_of(bought, reviews), "order_id") == [("1",), ("2",)]
