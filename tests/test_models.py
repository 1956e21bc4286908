from datetime import datetime
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from bazaarlake.plans import dashboards, intermediate, marts, rfm

T0 = datetime(2020, 1, 1, 10)
ENRICHED = (
    "order_id string, customer_id string, customer_unique_id string, customer_city string, customer_state string, "
    "order_status string, purchased_at timestamp, approved_at timestamp, delivered_to_carrier_at timestamp, "
    "delivered_to_customer_at timestamp, estimated_delivery_at timestamp, delivery_days long, "
    "estimated_delivery_days long, delivered_late boolean, item_count long, item_value decimal(38,9), "
    "freight_value decimal(38,9), payment_value decimal(38,9), payment_count long"
)


def order(key, customer="u", status="delivered", bought=T0, city="c", late=False, value=None, paid=None, days=None):
    money = None if value is None else Decimal(value)
    pay = None if paid is None else Decimal(paid)
    return (key, f"id-{key}", customer, city, "s", status, bought, None, None, None, None, days, None, late,
            None if value is None else 1, money, money, pay, None if paid is None else 1)


def enriched(spark, *data):
    return spark.createDataFrame(list(data), ENRICHED)


def items(spark, *data):
    return spark.createDataFrame(
        [(o, n, p, s, None if v is None else Decimal(v), Decimal(1)) for o, n, p, s, v in data],
        "order_id string, order_item_id long, product_id string, seller_id string, price decimal(28,9), "
        "freight_value decimal(28,9)",
    )


def test_delivery_exactly_at_the_estimate_is_on_time(spark):
    times = [(T0, T0), (datetime(2020, 1, 1, 10, 0, 1), T0), (None, T0), (T0, None)]
    df = spark.createDataFrame(times, "delivered_to_customer_at timestamp, estimated_delivery_at timestamp")
    assert [r[0] for r in df.select(intermediate.delivered_late()).collect()] == [False, True, None, None]


def test_enriched_keeps_one_row_per_order_and_leaves_gaps_null(spark):
    orders = spark.createDataFrame(
        [("1", "a", "x", T0, None, None, None, None), ("2", "gone", "x", T0, None, None, None, None)],
        "order_id string, customer_id string, order_status string, purchased_at timestamp, approved_at timestamp, "
        "delivered_to_carrier_at timestamp, delivered_to_customer_at timestamp, estimated_delivery_at timestamp",
    )
    people = spark.createDataFrame(
        [("a", "U", "z", "c", "s")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, "
        "customer_state string",
    )
    bought = items(spark, ("1", 1, "p", "s", "5"), ("1", 2, "p", "s", "6"))
    paid = spark.createDataFrame(
        [("1", 1, Decimal(4)), ("1", 2, Decimal(7))], "order_id string, payment_sequential long, payment_value decimal(28,9)"
    )
    out = intermediate.int_orders_enriched(orders, people, bought, paid)
    got = rows(out, "order_id", "customer_unique_id", "item_count", "item_value", "payment_value", "payment_count")
    assert got == [("1", "U", 2, Decimal(11), Decimal(11), 2), ("2", None, None, None, None, None)]


def test_seller_performance_equals_its_parts(spark):
    bought = items(
        spark, ("1", 1, "p", "s", "5"), ("1", 2, "q", "s", "7"), ("2", 1, "p", "s", None), ("2", 2, "p", "t", "3"),
        ("9", 1, "p", "only-unknown-order", "2"), ("1", 3, "p", None, "1"),
    )
    orders = enriched(spark, order("1", days=4, late=True), order("2", days=6))
    reviews = spark.createDataFrame(
        [("r1", "1", 5, T0), ("r2", "1", 2, T0), ("r3", "2", None, T0)],
        "review_id string, order_id string, review_score long, review_created_at timestamp",
    )
    whole = intermediate.int_seller_performance(bought, orders, reviews)
    parts = (
        intermediate.seller_sales(bought)
        .join(intermediate.seller_delivery(bought, orders), "seller_id", "left")
        .join(intermediate.seller_review_metrics(bought, reviews), "seller_id", "left")
    )
    assert rows(whole) == rows(parts.select(*whole.columns))
    assert rows(whole.filter("seller_id = 's'"), "units_sold", "order_count", "average_review_score", "review_count") == [
        (3, 2, 3.5, 3)
    ]


def test_colliding_order_spellings_count_once_per_seller(spark):
    orders = enriched(
        spark, order("1", bought=datetime(2020, 1, 2), days=9), order("1", bought=T0, days=1), order("1", bought=None, days=5)
    )
    got = intermediate.seller_orders(items(spark, ("1", 1, "p", "s", "5")), orders)
    assert rows(got, "seller_id", "delivery_days") == [("s", 5)]


def test_order_fact_defaults_and_difference(spark):
    fact = marts.fct_orders(enriched(spark, order("1", value="5", paid="7"), order("2", paid="7"), order("3", value="5")))
    got = rows(fact, "order_id", "item_count", "item_value", "payment_value", "payment_item_value_difference")
    assert got == [
        ("1", 1, Decimal(5), Decimal(7), Decimal(2)),
        ("2", 0, Decimal(0), Decimal(7), None),
        ("3", 1, Decimal(5), None, None),
    ]


def test_customer_dimension(spark):
    data = enriched(
        spark,
        order("2", city="later", bought=datetime(2020, 2, 1), paid="4"),
        order("1", city=None),
        order("0", city="unknown time", bought=None, status="canceled", late=True),
        order("5", customer=None, city="x"),
    )
    got = rows(
        marts.dim_customers(data), "customer_unique_id", "customer_city", "first_order_at", "total_orders",
        "total_spend", "average_order_value", "cancelled_orders", "late_orders",
    )
    assert got == [
        (None, "x", T0, 1, Decimal(0), None, 0, 0),
        ("u", "unknown time", T0, 3, Decimal(4), 4.0, 1, 1),
    ]


def test_product_dimension_names_the_unknown_category(spark):
    products = spark.createDataFrame(
        [("1", " \t"), ("2", None), ("3", " toys ")], "product_id string, product_category_name string"
    )
    out = marts.dim_products(products, intermediate.int_product_sales(items(spark, ("1", 1, "3", "s", "5"))))
    assert rows(out, "product_id", "product_category_name", "units_sold", "average_item_price") == [
        ("1", "unknown", 0, 0.0), ("2", "unknown", 0, 0.0), ("3", "toys", 1, 5.0),
    ]


def test_seller_dimension_without_orders(spark):
    sellers = spark.createDataFrame([("s", "z", "c", "x")], "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string")
    reviews = spark.createDataFrame([], "review_id string, order_id string, review_score long, review_created_at timestamp")
    performance = intermediate.int_seller_performance(items(spark), enriched(spark), reviews)
    got = marts.dim_sellers(sellers, performance)
    assert rows(got, "units_sold", "total_orders", "average_item_price", "late_order_rate") == [(0, 0, None, None)]


def test_daily_and_executive_late_differ(spark):
    fact = marts.fct_orders(
        enriched(spark, order("1", late=True, status="shipped"), order("2", late=True), order("3", bought=None, value="9"))
    )
    assert rows(marts.mart_daily_sales(fact), "total_orders", "late_deliveries", "payment_coverage_rate") == [(2, 2, 0.0)]
    kpis = marts.mart_executive_kpis(fact)
    assert rows(kpis, "total_orders", "late_deliveries", "delivered_orders", "total_sales") == [(3, 1, 2, Decimal(9))]


def test_kpis_equal_their_parts_with_repeated_and_unknown_keys(spark):
    fact = marts.fct_orders(
        enriched(
            spark, order("1", value="5", paid="5", days=3), order("1", customer="v", value="2"), order("2", paid="1"),
            order("3", customer=None, late=True, days=1), order(None, customer="w"),
        )
    )
    kpis = marts.mart_executive_kpis(fact)
    overall, repeat = marts.overall_metrics(fact), marts.customer_repeat_metrics(fact)
    assert rows(kpis, *overall.columns) == rows(overall)
    assert rows(kpis, *repeat.columns) == rows(repeat) == [(3, 1)]


def test_kpis_of_no_orders(spark):
    fact = marts.fct_orders(enriched(spark))
    kpis = marts.mart_executive_kpis(fact)
    overall = marts.overall_metrics(fact)
    assert rows(kpis, *overall.columns) == rows(overall)
    assert rows(kpis, "payment_coverage_rate", "late_delivery_rate", "total_customers", "repeat_customer_rate") == [
        (None, None, 0, None)
    ]


def test_segments_follow_the_first_matching_rule(spark):
    scores = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = spark.createDataFrame(scores, "r int, f int, m int")
    named = {tuple(x)[:3]: x["s"] for x in df.select("*", rfm.segment(F.col("r"), F.col("f"), F.col("m")).alias("s")).collect()}
    assert named[5, 4, 4] == "Champions" and named[3, 4, 3] == "Loyal Customers"
    assert named[5, 2, 5] == "New Customers" and named[2, 3, 5] == "At Risk"
    assert named[1, 2, 5] == "Hibernating" and named[3, 3, 3] == "Potential Loyalists"
    assert named[2, 5, 5] == "At Risk" and named[5, 5, 3] == "Loyal Customers" and named[5, 5, 1] == "Potential Loyalists"


def test_rfm_counts_delivered_orders_only(spark):
    data = enriched(
        spark, order("1", paid="5"), order("2", status="canceled", bought=datetime(2021, 1, 1), paid="9"),
        order("3", customer="v", bought=datetime(2020, 1, 31, 1)),
    )
    got = rows(rfm.mart_customer_rfm(data), "customer_unique_id", "recency", "frequency", "monetary", "rfm_score")
    assert got == [("u", 30, 1, Decimal(5), "112"), ("v", 0, 1, Decimal(0), "221")]


def test_monitoring_labels(spark):
    audit = spark.createDataFrame(
        [("b", "orders", T0, datetime(2020, 1, 1, 10, 0, 5, 900000), 3, n, None, None, s, None)
         for s, n in (("SUCCESS", 3), ("SUCCESS", 0), ("FAILED", 0), ("ODD", 1), ("SUCCESS", -1), ("SUCCESS", None))],
        "batch_id string, entity string, started_at timestamp, completed_at timestamp, records_fetched long, "
        "records_loaded long, watermark_before timestamp, watermark_after timestamp, status string, error_message string",
    )
    got = [r[0] for r in marts.mart_ingestion_monitoring(audit).select("ingestion_result").collect()]
    assert got == ["SUCCESS_WITH_DATA", "SUCCESS_NO_NEW_DATA", "FAILED", "UNKNOWN", "UNKNOWN", "UNKNOWN"]
    assert marts.mart_ingestion_monitoring(audit).first()["duration_seconds"] == 5


def test_top_products_break_ties_by_key(spark):
    products = spark.createDataFrame(
        [("b", "x", 1, Decimal(5)), ("a", "x", 1, Decimal(5)), ("c", "x", 9, Decimal(1))],
        "product_id string, product_category_name string, units_sold long, total_revenue decimal(38,9)",
    )
    assert [r["product_id"] for r in dashboards.top_products(products, n=2).collect()] == ["a", "b"]
    assert [r["product_id"] for r in dashboards.top_products(products, "units_sold", 1).collect()] == ["c"]
