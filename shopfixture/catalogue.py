"""The registered queries: one per operator, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.operators import incremental, quality
from bazaarlake.operators.latest import latest_per_key
from bazaarlake.plans import checks, dashboards, intermediate, marts, rfm
from bazaarlake.schemas import ENTITIES, ENTITY
from bazaarlake import schemas as S
from shopfixture.models import Models
from shopfixture.oracle import cash, dbl, mean, ratio, statement

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Money as double, times and dates as zone-free timestamps: types that both
    engines hand over alike."""
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            columns.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.DateType)):
            columns.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None):
    def register(make: Callable[[Models], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: comparable(make(Models(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = statement(sql)
        return make

    return register


def replaced(view: str, money: str = "", dates: str = "") -> str:
    """SELECT * with money columns as doubles and dates as timestamps."""
    changes = [f"{dbl(c)} AS {c}" for c in money.split()]
    changes += [f"CAST({c} AS TIMESTAMP) AS {c}" for c in dates.split()]
    return f"SELECT * REPLACE ({', '.join(changes)}) FROM {view}" if changes else f"SELECT * FROM {view}"


ITEM_MONEY = "price freight_value"
ORDER_MONEY = "item_value freight_value payment_value"
SALES_MONEY = "total_revenue total_freight"
SIZES = "product_weight_g product_length_cm product_height_cm product_width_cm"

# ---------------------------------------------------------------- staging


@query("t00_latest_per_key", "SELECT * FROM latest_orders")
def _(m):
    version = F.col("_ingested_at")
    return latest_per_key(m.raw("orders"), m.ingest("orders"), ["order_id"], S.ORDERS, version)


@query("t01_stg_customers", "SELECT * FROM stg_customers")
def _(m):
    return m.staged("customers")


@query("t02_stg_orders", "SELECT * FROM stg_orders")
def _(m):
    return m.staged("orders")


@query("t03_stg_order_items", replaced("stg_order_items", ITEM_MONEY))
def _(m):
    return m.staged("order_items")


@query("t04_stg_payments", replaced("stg_payments", "payment_value"))
def _(m):
    return m.staged("payments")


@query("t05_stg_products", replaced("stg_products", SIZES))
def _(m):
    return m.staged("products")


@query("t06_stg_reviews", "SELECT * FROM stg_reviews")
def _(m):
    return m.staged("reviews")


@query("t07_stg_sellers", "SELECT * FROM stg_sellers")
def _(m):
    return m.staged("sellers")


@query("t08_stg_geolocation", "SELECT * FROM stg_geolocation")
def _(m):
    return m.staged("geolocation")


# ---------------------------------------------------------------- intermediate


@query("n01_order_item_totals", replaced("item_totals", "item_value freight_value"))
def _(m):
    return intermediate.order_item_totals(m.items)


@query("n02_order_payment_totals", replaced("payment_totals", "payment_value"))
def _(m):
    return intermediate.order_payment_totals(m.staged("payments"))


@query("n03_delivery_days", "SELECT order_id, delivery_days, estimated_delivery_days FROM enriched")
def _(m):
    return m.staged("orders").select(
        "order_id",
        intermediate.delivery_days().alias("delivery_days"),
        intermediate.estimated_delivery_days().alias("estimated_delivery_days"),
    )


@query("n04_delivered_late", "SELECT order_id, delivered_late FROM enriched")
def _(m):
    return m.staged("orders").select("order_id", intermediate.delivered_late().alias("delivered_late"))


@query("n05_int_orders_enriched", replaced("enriched", ORDER_MONEY))
def _(m):
    return m.enriched


@query(
    "n06_int_customer_orders",
    f"""SELECT customer_unique_id, customer_id, order_id, order_status, customer_city, customer_state, purchased_at,
    delivered_to_customer_at, delivery_days, estimated_delivery_days, item_count, {dbl('item_value')} AS item_value,
    {dbl('freight_value')} AS freight_value, {dbl('payment_value')} AS payment_value, delivered_late FROM enriched""",
)
def _(m):
    return m.customer_orders


@query("n07_int_product_sales", replaced("product_sales", SALES_MONEY))
def _(m):
    return m.product_sales


@query("n08_seller_sales", replaced("seller_sales", SALES_MONEY))
def _(m):
    return intermediate.seller_sales(m.items)


@query("n09_seller_orders", "SELECT * FROM seller_orders")
def _(m):
    return intermediate.seller_orders(m.items, m.enriched)


@query("n10_seller_delivery", "SELECT * FROM seller_delivery")
def _(m):
    return intermediate.seller_delivery(m.items, m.enriched)


@query("n11_seller_reviews", "SELECT * FROM seller_reviews")
def _(m):
    return intermediate.seller_reviews(m.items, m.staged("reviews"))


@query("n12_seller_review_metrics", "SELECT * FROM seller_review_metrics")
def _(m):
    return intermediate.seller_review_metrics(m.items, m.staged("reviews"))


@query("n13_int_seller_performance", replaced("performance", SALES_MONEY))
def _(m):
    return m.performance


# ---------------------------------------------------------------- marts


@query("m01_fct_orders", replaced("fct_orders", f"{ORDER_MONEY} payment_item_value_difference"))
def _(m):
    return m.fct_orders


@query("m02_fct_order_items", replaced("fct_order_items", f"{ITEM_MONEY} item_total_value"))
def _(m):
    return marts.fct_order_items(m.items, m.enriched)


@query("m03_dim_customers", replaced("dim_customers", "total_spend"))
def _(m):
    return marts.dim_customers(m.customer_orders)


@query("m04_dim_products", replaced("dim_products", f"{SIZES} {SALES_MONEY}"))
def _(m):
    return m.dim_products


@query("m05_dim_sellers", replaced("dim_sellers", SALES_MONEY))
def _(m):
    return m.dim_sellers


@query("m06_rfm_base", replaced("rfm_base", "monetary"))
def _(m):
    return rfm.rfm_base(m.customer_orders)


@query("m07_rfm_metrics", replaced("rfm_metrics", "monetary"))
def _(m):
    base, _, latest = rfm.written_base(m.customer_orders)
    return rfm.rfm_metrics(base, latest)


@query("m08_rfm_scores", replaced("rfm_scores", "monetary"))
def _(m):
    return rfm.rfm_scores(m.customer_orders)


@query("m08_rfm_scores_searched", replaced("rfm_scores", "monetary"))
def _(m):
    """Narrow bands, so that the borders are searched for as on a large table."""
    return rfm.rfm_scores(m.customer_orders, max_band=20)


@query("m09_mart_customer_rfm", replaced("rfm", "monetary"))
def _(m):
    return m.customer_rfm


DAILY_SQL = f"""SELECT CAST(sales_date AS TIMESTAMP) AS sales_date, total_orders, unique_customers,
    {dbl('total_sales')} AS total_sales, {dbl('total_freight')} AS total_freight,
    {dbl('recorded_payment_value')} AS recorded_payment_value, average_order_value, average_delivery_days,
    late_deliveries, delivered_orders, orders_with_payment,
    {ratio('orders_with_payment', 'total_orders')} AS payment_coverage_rate FROM daily_sales"""


@query("m10_daily_sales", DAILY_SQL)
def _(m):
    return m.daily_sales


@query("m11_customer_repeat_metrics", "SELECT * FROM repeat_metrics")
def _(m):
    return marts.customer_repeat_metrics(m.fct_orders)


OVERALL_SQL = f"""total_orders, unique_customers AS total_customers_with_orders, {dbl('total_sales')} AS total_sales,
    {dbl('total_freight')} AS total_freight, {dbl('recorded_payment_value')} AS recorded_payment_value,
    average_order_value, average_delivery_days, late_deliveries, delivered_orders, orders_with_payment"""


@query("m12_overall_metrics", f"SELECT {OVERALL_SQL} FROM overall_metrics")
def _(m):
    return marts.overall_metrics(m.fct_orders)


@query(
    "m13_mart_executive_kpis",
    f"""SELECT {OVERALL_SQL}, {ratio('orders_with_payment', 'total_orders')} AS payment_coverage_rate,
    {ratio('late_deliveries', 'delivered_orders')} AS late_delivery_rate, total_customers, repeat_customers,
    {ratio('repeat_customers', 'total_customers')} AS repeat_customer_rate FROM overall_metrics, repeat_metrics""",
)
def _(m):
    return marts.mart_executive_kpis(m.fct_orders)


@query("m14_mart_ingestion_monitoring", "SELECT * FROM monitoring")
def _(m):
    return m.monitoring


# ---------------------------------------------------------------- quality

NULL_COLUMNS = ["approved_at", "delivered_to_customer_at", "item_count", "payment_value", "order_id"]


@query(
    "q01_not_null",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS failures FROM enriched" for c in NULL_COLUMNS
    ),
)
def _(m):
    return quality.null_counts(m.enriched, NULL_COLUMNS)


@query("q02_unique", "SELECT review_id, COUNT(*) AS row_count FROM stg_reviews GROUP BY ALL HAVING COUNT(*) > 1")
def _(m):
    return quality.unique(m.staged("reviews"), "review_id")


@query(
    "q03_relationships",
    """SELECT order_id, COUNT(*) AS row_count FROM stg_order_items
    WHERE NOT EXISTS (SELECT 1 FROM stg_payments p WHERE p.order_id = stg_order_items.order_id) GROUP BY ALL""",
)
def _(m):
    return quality.relationships(m.items, "order_id", m.staged("payments"), "order_id")


@query(
    "q04_accepted_values",
    "SELECT batch_id, entity, ingestion_result FROM monitoring WHERE ingestion_result NOT IN ('SUCCESS_WITH_DATA', 'FAILED')",
)
def _(m):
    bad = quality.accepted_values(m.monitoring, "ingestion_result", ["SUCCESS_WITH_DATA", "FAILED"])
    return bad.select("batch_id", "entity", "ingestion_result")


@query(
    "q05_composite_unique",
    "SELECT order_id, order_item_id, COUNT(*) AS row_count FROM raw_order_items GROUP BY ALL HAVING COUNT(*) > 1",
)
def _(m):
    return quality.composite_unique(m.raw("order_items"), ["order_id", "order_item_id"])


@query(
    "q06_valid_record_counts",
    """SELECT batch_id, entity, records_fetched, records_loaded + 1 AS records_loaded FROM audit WHERE status = 'FAILED'""",
)
def _(m):
    """The log is sound, so one record too many is claimed for every failed entity."""
    extra = (F.col("status") == "FAILED").cast("long")
    damaged = m.monitoring.withColumn("records_loaded", F.col("records_loaded") + extra)
    bad = quality.expression_check(damaged, checks.bad_counts())
    return bad.select("batch_id", "entity", "records_fetched", "records_loaded")


@query(
    "q07_valid_duration",
    """SELECT batch_id, entity, completed_at AS started_at, started_at AS completed_at,
    -duration_seconds AS duration_seconds FROM monitoring WHERE completed_at > started_at""",
)
def _(m):
    """The log is sound, so every entry's start and end are swapped."""
    audit = m.audit()
    audit = audit.withColumns({"started_at": F.col("completed_at"), "completed_at": F.col("started_at")})
    bad = quality.expression_check(marts.mart_ingestion_monitoring(audit), checks.bad_duration())
    return bad.select("batch_id", "entity", "started_at", "completed_at", "duration_seconds")


@query("q08_delivered_without_payment", "SELECT * FROM unpaid")
def _(m):
    return m.unpaid


# ---------------------------------------------------------------- dashboards


@query(
    "d01_sales_trend",
    f"""SELECT CAST(sales_date AS TIMESTAMP) AS sales_date, {dbl('total_sales')} AS total_sales, total_orders,
    {dbl('recorded_payment_value')} AS recorded_payment_value, average_order_value FROM daily_sales""",
)
def _(m):
    return dashboards.sales_trend(m.daily_sales)


@query(
    "d02_segment_summary",
    f"""SELECT customer_segment, COUNT(*) AS customers, {dbl('SUM(monetary)')} AS revenue,
    {mean('monetary')} AS average_revenue FROM rfm GROUP BY ALL""",
)
def _(m):
    return dashboards.segment_summary(m.customer_rfm)


@query(
    "d03_one_time_vs_repeat",
    """SELECT if(n = 1, 'one-time', 'repeat') AS customer_type, COUNT(*) AS customers, CAST(SUM(n) AS BIGINT) AS orders
    FROM (SELECT COUNT(DISTINCT order_id) AS n FROM enriched WHERE customer_unique_id IS NOT NULL
    GROUP BY customer_unique_id) GROUP BY 1""",
)
def _(m):
    return dashboards.one_time_vs_repeat(m.customer_orders)


@query("d04_orders_by_status", "SELECT order_status, COUNT(*) AS orders FROM fct_orders GROUP BY ALL")
def _(m):
    return dashboards.orders_by_status(m.fct_orders)


@query(
    "d04_delivered_orders", "SELECT COUNT(*) AS delivered_orders FROM fct_orders WHERE order_status = 'delivered'"
)
def _(m):
    return dashboards.delivered_orders(m.fct_orders)


@query(
    "d05_delivery_time_by_month",
    """SELECT CAST(date_trunc('month', purchased_at) AS TIMESTAMP) AS purchase_month, AVG(delivery_days) AS actual_days,
    AVG(estimated_delivery_days) AS estimated_days, COUNT(delivery_days) AS delivered FROM fct_orders GROUP BY 1""",
)
def _(m):
    return dashboards.delivery_time_by_month(m.fct_orders)


@query(
    "d06_late_deliveries_over_time",
    f"""SELECT CAST(CAST(purchased_at AS DATE) AS TIMESTAMP) AS sales_date,
    COUNT(*) FILTER (WHERE delivered_late) AS late_deliveries, COUNT(delivered_late) AS deliveries,
    {ratio('COUNT(*) FILTER (WHERE delivered_late)', 'COUNT(delivered_late)')} AS late_rate FROM fct_orders GROUP BY 1""",
)
def _(m):
    return dashboards.late_deliveries_over_time(m.fct_orders)


TOP_SQL = f"""SELECT product_id, product_category_name, units_sold, {dbl('total_revenue')} AS total_revenue
    FROM dim_products ORDER BY %s DESC, product_id LIMIT 10"""


@query("d07_top_products_by_revenue", TOP_SQL % "dim_products.total_revenue")
def _(m):
    return dashboards.top_products(m.dim_products, "total_revenue")


@query("d07_top_products_by_units", TOP_SQL % "units_sold")
def _(m):
    return dashboards.top_products(m.dim_products, "units_sold")


@query(
    "d08_top_sellers",
    f"""SELECT seller_id, seller_city, units_sold, {dbl('total_revenue')} AS total_revenue, average_review_score
    FROM dim_sellers ORDER BY dim_sellers.total_revenue DESC, seller_id LIMIT 10""",
)
def _(m):
    return dashboards.top_sellers(m.dim_sellers)


@query(
    "d08_seller_delivery",
    """SELECT seller_id, total_orders, late_orders, late_order_rate, average_delivery_days FROM dim_sellers
    WHERE total_orders > 0""",
)
def _(m):
    return dashboards.seller_delivery_performance(m.dim_sellers)


@query(
    "d09_category_performance",
    f"""SELECT product_category_name, COUNT(*) AS products, CAST(SUM(units_sold) AS BIGINT) AS units_sold,
    CAST(SUM(order_count) AS BIGINT) AS order_count, {dbl('SUM(p.total_revenue)')} AS total_revenue,
    {dbl('SUM(p.total_revenue)')} / NULLIF(CAST(SUM(units_sold) AS DOUBLE), 0) AS revenue_per_unit
    FROM dim_products p GROUP BY ALL""",
)
def _(m):
    return dashboards.category_performance(m.dim_products)


@query(
    "d10_unpaid_delivered_note",
    """SELECT COUNT(*) AS delivered_without_payment, MIN(purchased_at) AS first_purchase_at,
    MAX(purchased_at) AS last_purchase_at FROM unpaid""",
)
def _(m):
    return dashboards.unpaid_delivered_note(m.unpaid)
