"""The same shop in DuckDB SQL, written independently of the Spark plans.

``VIEWS`` holds named select statements; ``statement`` turns a final select into
one statement with the views it needs, in order.
"""

from __future__ import annotations

import re

from bazaarlake.functions.expr import WHITE_SPACE
from bazaarlake.schemas import ENTITIES
from shopfixture.shop import FIRST_FEED, MESSAGE, SECOND_FEED, TITLE, UNPAID_BELOW


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def trimmed(column: str) -> str:
    return f"trim({column}, {quoted(WHITE_SPACE)})"


def dbl(expression: str) -> str:
    """Two-decimal money as a double."""
    return f"CAST(CAST({expression} AS DECIMAL(18,2)) AS DOUBLE)"


def cash(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(18,2))"


def mean(column: str) -> str:
    return f"{dbl(f'SUM({column})')} / NULLIF(COUNT({column}), 0)"


def ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


def d(expression: str) -> str:
    return f"to_days(CAST({expression} AS INTEGER))"


def m(expression: str) -> str:
    return f"to_minutes(CAST({expression} AS BIGINT))"


FIRST, SECOND = f"TIMESTAMP '{FIRST_FEED}'", f"TIMESTAMP '{SECOND_FEED}'"

CUSTOMER_COLUMNS = """CAST(c_custkey AS VARCHAR) AS customer_id, 'U' || (c_custkey // 2) AS customer_unique_id,
    lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix"""
ITEM_COLUMNS = f"""CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
    CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id, l_shipdate AS shipping_limit_date"""
PRODUCT_COLUMNS = f"""CAST(p_partkey AS VARCHAR) AS product_id,
    CASE WHEN p_partkey % 50 = 0 THEN 'bad' ELSE CAST(length(p_name) AS VARCHAR) END AS product_name_lenght,
    CAST(p_size * 10 AS VARCHAR) AS product_description_lenght, CAST(p_size % 8 + 1 AS BIGINT) AS product_photos_qty,
    {cash('p_size * 100')} AS product_weight_g, {cash('p_size')} AS product_length_cm,
    {cash('p_size')} AS product_height_cm, {cash('p_size')} AS product_width_cm"""
SELLER_COLUMNS = """CAST(s_suppkey AS VARCHAR) AS seller_id,
    lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix"""

PRODUCT_MEASURES = "product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm"

VIEWS: dict[str, str] = {}

# ---- raw entities
VIEWS["person"] = """SELECT * FROM customer JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey"""
VIEWS["shopkeeper"] = """SELECT * FROM supplier JOIN nation ON n_nationkey = s_nationkey
    JOIN region ON r_regionkey = n_regionkey"""
VIEWS["raw_customers"] = f"""SELECT {CUSTOMER_COLUMNS}, n_name AS customer_city,
    ' ' || r_name || ' ' AS customer_state FROM person"""
VIEWS["raw_orders"] = f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN ' Delivered ' WHEN 'O' THEN 'shipped'
        ELSE CASE o_orderkey % 2 WHEN 0 THEN 'canceled' ELSE 'processing' END END AS order_status,
    o_orderdate AS order_purchase_timestamp,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + {m('o_orderkey % 116 + 5')} END AS order_approved_at,
    CASE o_orderstatus WHEN 'F' THEN o_orderdate + {d('o_orderkey % 3 + 1')} END AS order_delivered_carrier_date,
    CASE o_orderstatus WHEN 'F' THEN o_orderdate + {d('(o_orderkey * 7) % 17 + 2')} END AS order_delivered_customer_date,
    o_orderdate + {d('(o_orderkey * 5) % 13 + 3')} AS order_estimated_delivery_date FROM orders"""
VIEWS["raw_order_items"] = f"""SELECT {ITEM_COLUMNS}, {cash('l_extendedprice')} AS price,
    {cash('l_quantity')} AS freight_value FROM lineitem"""
VIEWS["raw_payments"] = f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(1 AS BIGINT) AS payment_sequential,
        ['credit_card', 'BOLETO', 'voucher', 'debit_card'][o_orderkey % 4 + 1] AS payment_type,
        o_orderkey % 6 + 1 AS payment_installments, {cash('o_totalprice')} AS payment_value
    FROM orders WHERE o_totalprice >= {UNPAID_BELOW}
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), CAST(2 AS BIGINT), 'voucher', CAST(1 AS BIGINT), {cash('o_orderkey % 50')}
    FROM orders WHERE o_totalprice >= {UNPAID_BELOW} AND o_orderpriority = '1-URGENT'"""
VIEWS["raw_reviews"] = f"""SELECT 'R' || (o_orderkey // 2) AS review_id, CAST(o_orderkey AS VARCHAR) AS order_id,
    o_orderkey % 5 + 1 AS review_score, {quoted(TITLE)} AS review_comment_title,
    CASE WHEN o_orderkey % 4 <> 0 THEN {quoted(MESSAGE)} END AS review_comment_message,
    o_orderdate + {d('(o_orderkey * 7) % 17 + 3')} AS review_creation_date,
    o_orderdate + {d('(o_orderkey * 7) % 17 + 5')} AS review_answer_timestamp
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'"""
VIEWS["raw_products"] = f"""SELECT {PRODUCT_COLUMNS}, CASE p_partkey % 10 WHEN 0 THEN '  ' WHEN 1 THEN NULL
    ELSE p_type END AS product_category_name FROM part"""
VIEWS["raw_sellers"] = f"""SELECT {SELLER_COLUMNS}, ' ' || n_name AS seller_city, r_name AS seller_state FROM shopkeeper"""
VIEWS["raw_geolocation"] = """SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
    n_name || ' ' AS geolocation_city, r_name AS geolocation_state,
    CASE WHEN c_acctbal < 0 THEN 'n/a' ELSE (c_custkey % 90) || '.25' END AS geolocation_lat,
    '-' || (c_custkey % 180) || '.5' AS geolocation_lng FROM person"""

# ---- appended versions
VIEWS["feed_customers"] = f"""SELECT {CUSTOMER_COLUMNS}, 'moved' AS customer_city, 'SP' AS customer_state,
        '1999-01-01 00:00:00' AS created_at,
        CASE c_custkey % 2 WHEN 0 THEN 'not-a-date' ELSE '{FIRST_FEED}' END AS updated_at, {SECOND} AS _ingested_at
    FROM person WHERE c_mktsegment = 'BUILDING'
    UNION ALL
    SELECT {CUSTOMER_COLUMNS}, 'older', ' ' || r_name || ' ', '1999-01-01 00:00:00', '2001-12-01 00:00:00', {SECOND}
    FROM person WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000"""
VIEWS["feed_orders"] = f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
        'delivered' AS order_status, o_orderdate AS order_purchase_timestamp,
        o_orderdate + {m('30')} AS order_approved_at, o_orderdate + {d('1')} AS order_delivered_carrier_date,
        o_orderdate + {d('4')} AS order_delivered_customer_date,
        o_orderdate + {d('(o_orderkey * 5) % 13 + 3')} AS order_estimated_delivery_date, {FIRST} AS _ingested_at
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), 'canceled', o_orderdate, o_orderdate + {m('30')},
        NULL, NULL, o_orderdate + {d('5')}, {SECOND}
    FROM orders WHERE o_orderpriority = '1-URGENT'"""
VIEWS["feed_order_items"] = f"""SELECT {ITEM_COLUMNS}, {cash('l_extendedprice')} + 1 AS price,
    {cash('l_quantity')} AS freight_value, {FIRST} AS _ingested_at
    FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'"""
VIEWS["feed_payments"] = f"""SELECT * REPLACE (payment_value + 1 AS payment_value), {FIRST} AS _ingested_at
    FROM raw_payments WHERE payment_type = 'voucher'"""
VIEWS["feed_reviews"] = f"""SELECT * REPLACE (CAST(5 AS BIGINT) AS review_score), {FIRST} AS _ingested_at
    FROM raw_reviews WHERE review_score = 1"""
VIEWS["feed_products"] = f"""SELECT {PRODUCT_COLUMNS}, 'relabelled' AS product_category_name, {FIRST} AS _ingested_at
    FROM part WHERE p_size > 45"""
VIEWS["feed_sellers"] = f"""SELECT {SELLER_COLUMNS}, 'moved' AS seller_city, r_name AS seller_state,
    {FIRST} AS _ingested_at FROM shopkeeper WHERE s_acctbal > 8000"""

# ---- operational copy: masters with text times
for _name, _key in (("customers", "customer_id"), ("products", "product_id"), ("sellers", "seller_id")):
    _k = f"CAST({_key} AS BIGINT)"
    _created = f"(TIMESTAMP '1995-01-01 00:00:00' + {d(f'({_k} * 131) % 2000')})"
    VIEWS[f"op_{_name}"] = f"""SELECT *, CAST({_created} AS VARCHAR) AS created_at,
    CAST({_created} + {d(f'({_k} * 7) % 500')} AS VARCHAR) AS updated_at FROM raw_{_name}"""

VIEWS["op_orders"] = """SELECT * REPLACE (lower(trim(order_status)) AS order_status) FROM raw_orders"""
for _name in ("order_items", "payments", "reviews"):
    VIEWS[f"op_{_name}"] = f"SELECT * FROM raw_{_name}"

# ---- audit
_entities = ", ".join(quoted(e.name) for e in ENTITIES)
VIEWS["audit"] = f"""SELECT 'B' || lpad(CAST(event_id // 7 AS VARCHAR), 7, '0') AS batch_id,
    [{_entities}][event_id % 7 + 1] AS entity, ts AS started_at, ts + {m('user_id % 90')} AS completed_at,
    CASE WHEN event_type IN ('error', 'signup') THEN 0 ELSE user_id END AS records_fetched, records_fetched AS records_loaded,
    ts - {d('1')} AS watermark_before, CASE WHEN event_type <> 'error' THEN ts END AS watermark_after,
    CASE event_type WHEN 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CASE event_type WHEN 'error' THEN props END AS error_message FROM events"""


def latest(name: str, keys: str, columns: str, version: str = "_ingested_at") -> str:
    """One row per key of history plus feed; ties go to the remaining columns, descending."""
    rest = [c.strip() for c in columns.split(",") if c.strip() not in [k.strip() for k in keys.split(",")]]
    ties = ", ".join(f"{c} DESC NULLS LAST" for c in rest)
    return f"""SELECT DISTINCT ON ({keys}) {columns} FROM (
        SELECT {columns}, 0 AS p, TIMESTAMP '1970-01-01 00:00:00' AS v FROM raw_{name}
        UNION ALL SELECT {columns}, 1, {version} FROM feed_{name})
    ORDER BY {keys}, p DESC, v DESC NULLS LAST, {ties}"""


# ---- staging
VIEWS["latest_customers"] = latest(
    "customers",
    "customer_id",
    "customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state",
    "coalesce(TRY_CAST(updated_at AS TIMESTAMP), _ingested_at)",
)
VIEWS["latest_orders"] = latest(
    "orders",
    "order_id",
    "order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at, "
    "order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date",
)
VIEWS["latest_order_items"] = latest(
    "order_items",
    "order_id, order_item_id",
    "order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value",
)
VIEWS["latest_payments"] = latest(
    "payments",
    "order_id, payment_sequential",
    "order_id, payment_sequential, payment_type, payment_installments, payment_value",
)
VIEWS["latest_products"] = latest(
    "products",
    "product_id",
    f"product_id, product_category_name, product_name_lenght, product_description_lenght, {PRODUCT_MEASURES}",
)
VIEWS["latest_reviews"] = latest(
    "reviews",
    "review_id, order_id",
    "review_id, order_id, review_score, review_comment_title, review_comment_message, "
    "review_creation_date, review_answer_timestamp",
)
VIEWS["latest_sellers"] = latest(
    "sellers", "seller_id", "seller_id, seller_zip_code_prefix, seller_city, seller_state"
)
VIEWS["stg_customers"] = f"""SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
    {trimmed('customer_city')} AS customer_city, lower({trimmed('customer_state')}) AS customer_state FROM latest_customers"""
VIEWS["stg_orders"] = f"""SELECT order_id, customer_id, lower({trimmed('order_status')}) AS order_status,
    order_purchase_timestamp AS purchased_at, order_approved_at AS approved_at,
    order_delivered_carrier_date AS delivered_to_carrier_at, order_delivered_customer_date AS delivered_to_customer_at,
    order_estimated_delivery_date AS estimated_delivery_at FROM latest_orders"""
VIEWS["stg_order_items"] = """SELECT * RENAME (shipping_limit_date AS shipping_limit_at) FROM latest_order_items"""
VIEWS["stg_payments"] = f"""SELECT * REPLACE (lower({trimmed('payment_type')}) AS payment_type) FROM latest_payments"""
VIEWS["stg_products"] = f"""SELECT product_id, product_category_name,
    TRY_CAST(product_name_lenght AS BIGINT) AS product_name_length,
    TRY_CAST(product_description_lenght AS BIGINT) AS product_description_length, {PRODUCT_MEASURES} FROM latest_products"""
VIEWS["stg_reviews"] = f"""SELECT review_id, order_id, review_score,
    {trimmed('review_comment_title')} AS review_comment_title, {trimmed('review_comment_message')} AS review_comment_message,
    review_creation_date AS review_created_at, review_answer_timestamp AS review_answered_at FROM latest_reviews"""
VIEWS["stg_sellers"] = f"""SELECT seller_id, seller_zip_code_prefix, {trimmed('seller_city')} AS seller_city,
    lower({trimmed('seller_state')}) AS seller_state FROM latest_sellers"""
VIEWS["stg_geolocation"] = f"""SELECT geolocation_zip_code_prefix, {trimmed('geolocation_city')} AS geolocation_city,
    lower(geolocation_state) AS geolocation_state, TRY_CAST(geolocation_lat AS DOUBLE) AS latitude,
    TRY_CAST(geolocation_lng AS DOUBLE) AS longitude FROM raw_geolocation"""

# ---- intermediate
VIEWS["item_totals"] = """SELECT order_id, COUNT(*) AS item_count, SUM(price) AS item_value,
    SUM(freight_value) AS freight_value FROM stg_order_items GROUP BY ALL"""
VIEWS["payment_totals"] = """SELECT order_id, SUM(payment_value) AS payment_value, COUNT(*) AS payment_count
    FROM stg_payments GROUP BY ALL"""
VIEWS["enriched"] = """SELECT order_id, customer_id, customer_unique_id, customer_city, customer_state, order_status,
    purchased_at, approved_at, delivered_to_carrier_at, delivered_to_customer_at, estimated_delivery_at,
    CAST(delivered_to_customer_at AS DATE) - CAST(purchased_at AS DATE) AS delivery_days,
    CAST(estimated_delivery_at AS DATE) - CAST(purchased_at AS DATE) AS estimated_delivery_days,
    delivered_to_customer_at > estimated_delivery_at AS delivered_late,
    item_count, item_value, freight_value, payment_value, payment_count
    FROM stg_orders LEFT JOIN stg_customers USING (customer_id) LEFT JOIN item_totals USING (order_id)
    LEFT JOIN payment_totals USING (order_id)"""
VIEWS["product_sales"] = f"""SELECT product_id, COUNT(*) AS units_sold, COUNT(DISTINCT order_id) AS order_count,
    SUM(price) AS total_revenue, SUM(freight_value) AS total_freight, {mean('price')} AS average_item_price
    FROM stg_order_items GROUP BY ALL"""
VIEWS["seller_sales"] = f"""SELECT seller_id, COUNT(*) AS units_sold, COUNT(DISTINCT order_id) AS order_count,
    COUNT(DISTINCT product_id) AS product_count, SUM(price) AS total_revenue, SUM(freight_value) AS total_freight,
    {mean('price')} AS average_item_price FROM stg_order_items GROUP BY ALL"""
VIEWS["seller_orders"] = """SELECT DISTINCT seller_id, order_id, purchased_at, delivered_to_customer_at,
    delivery_days, delivered_late FROM stg_order_items JOIN enriched USING (order_id)"""
VIEWS["seller_delivery"] = """SELECT seller_id, AVG(delivery_days) AS average_delivery_days,
    COUNT(*) FILTER (WHERE delivered_late) AS late_orders, COUNT(*) AS total_orders FROM seller_orders GROUP BY ALL"""
VIEWS["seller_reviews"] = """SELECT DISTINCT seller_id, order_id, review_id, review_score
    FROM stg_order_items JOIN stg_reviews USING (order_id)"""
VIEWS["seller_review_metrics"] = """SELECT seller_id, AVG(review_score) AS average_review_score,
    COUNT(*) AS review_count FROM seller_reviews GROUP BY ALL"""
VIEWS["performance"] = """SELECT * FROM seller_sales LEFT JOIN seller_delivery USING (seller_id)
    LEFT JOIN seller_review_metrics USING (seller_id)"""

# ---- marts
VIEWS["fct_orders"] = """SELECT * REPLACE (coalesce(item_count, 0) AS item_count, coalesce(item_value, 0) AS item_value,
    coalesce(freight_value, 0) AS freight_value), payment_value - enriched.item_value AS payment_item_value_difference
    FROM enriched"""
VIEWS["fct_order_items"] = """SELECT order_id, order_item_id, customer_id, customer_unique_id, product_id, seller_id,
    shipping_limit_at, order_status, purchased_at, price, i.freight_value, price + i.freight_value AS item_total_value
    FROM stg_order_items i LEFT JOIN enriched USING (order_id)"""
VIEWS["dim_customers"] = f"""SELECT customer_unique_id,
    first(customer_city ORDER BY purchased_at NULLS FIRST, order_id) FILTER (WHERE customer_city IS NOT NULL) AS customer_city,
    first(customer_state ORDER BY purchased_at NULLS FIRST, order_id) FILTER (WHERE customer_state IS NOT NULL) AS customer_state,
    MIN(purchased_at) AS first_order_at, MAX(purchased_at) AS last_order_at, COUNT(DISTINCT order_id) AS total_orders,
    CAST(SUM(coalesce(item_count, 0)) AS BIGINT) AS total_items, SUM(coalesce(payment_value, 0)) AS total_spend,
    {mean('payment_value')} AS average_order_value,
    COUNT(*) FILTER (WHERE order_status = 'delivered') AS delivered_orders,
    COUNT(*) FILTER (WHERE order_status = 'canceled') AS cancelled_orders,
    COUNT(*) FILTER (WHERE delivered_late) AS late_orders FROM enriched GROUP BY ALL"""
VIEWS["dim_products"] = f"""SELECT product_id,
    CASE WHEN coalesce({trimmed('product_category_name')}, '') = '' THEN 'unknown'
        ELSE {trimmed('product_category_name')} END AS product_category_name,
    product_name_length, product_description_length, {PRODUCT_MEASURES},
    coalesce(units_sold, 0) AS units_sold, coalesce(order_count, 0) AS order_count, coalesce(total_revenue, 0) AS total_revenue,
    coalesce(total_freight, 0) AS total_freight, coalesce(average_item_price, 0) AS average_item_price
    FROM stg_products LEFT JOIN product_sales USING (product_id)"""
VIEWS["dim_sellers"] = f"""SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state,
    coalesce(units_sold, 0) AS units_sold, coalesce(order_count, 0) AS order_count,
    coalesce(product_count, 0) AS product_count, coalesce(total_revenue, 0) AS total_revenue,
    coalesce(total_freight, 0) AS total_freight, average_item_price, average_delivery_days,
    coalesce(late_orders, 0) AS late_orders, coalesce(total_orders, 0) AS total_orders, average_review_score,
    coalesce(review_count, 0) AS review_count, {ratio('p.late_orders', 'p.total_orders')} AS late_order_rate
    FROM stg_sellers LEFT JOIN performance p USING (seller_id)"""
VIEWS["rfm_base"] = """SELECT customer_unique_id, MAX(purchased_at) AS last_purchase_at,
    COUNT(DISTINCT order_id) AS frequency, SUM(coalesce(payment_value, 0)) AS monetary
    FROM enriched WHERE order_status = 'delivered' GROUP BY ALL"""
VIEWS["rfm_metrics"] = """SELECT *, CAST(analysis_date AS DATE) - CAST(last_purchase_at AS DATE) AS recency
    FROM (SELECT *, MAX(last_purchase_at) OVER () AS analysis_date FROM rfm_base)"""
VIEWS["rfm_scores"] = """SELECT *,
    ntile(5) OVER (ORDER BY recency DESC NULLS LAST, customer_unique_id NULLS FIRST) AS recency_score,
    ntile(5) OVER (ORDER BY frequency NULLS FIRST, customer_unique_id NULLS FIRST) AS frequency_score,
    ntile(5) OVER (ORDER BY monetary NULLS FIRST, customer_unique_id NULLS FIRST) AS monetary_score
    FROM rfm_metrics"""
VIEWS["rfm"] = """SELECT *, recency_score || '' || frequency_score || '' || monetary_score AS rfm_score,
    CASE WHEN least(recency_score, frequency_score, monetary_score) >= 4 THEN 'Champions'
        WHEN least(recency_score, monetary_score) >= 3 AND frequency_score >= 4 THEN 'Loyal Customers'
        WHEN recency_score >= 4 AND frequency_score < 3 THEN 'New Customers'
        WHEN recency_score < 3 THEN if(frequency_score >= 3, 'At Risk', 'Hibernating')
        ELSE 'Potential Loyalists' END AS customer_segment FROM rfm_scores"""
_sales = f"""COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT customer_unique_id) AS unique_customers,
    SUM(item_value) AS total_sales, SUM(freight_value) AS total_freight, SUM(payment_value) AS recorded_payment_value,
    {mean('item_value')} AS average_order_value, AVG(delivery_days) AS average_delivery_days,
    COUNT(*) FILTER (WHERE order_status = 'delivered') AS delivered_orders,
    COUNT(*) FILTER (WHERE payment_count IS NOT NULL) AS orders_with_payment"""
VIEWS["daily_sales"] = f"""SELECT CAST(purchased_at AS DATE) AS sales_date, {_sales},
    COUNT(*) FILTER (WHERE delivered_late) AS late_deliveries FROM fct_orders WHERE purchased_at IS NOT NULL GROUP BY ALL"""
VIEWS["repeat_metrics"] = """SELECT COUNT(*) AS total_customers, COUNT(*) FILTER (WHERE n > 1) AS repeat_customers
    FROM (SELECT COUNT(DISTINCT order_id) AS n FROM fct_orders WHERE customer_unique_id IS NOT NULL
    GROUP BY customer_unique_id)"""
VIEWS["overall_metrics"] = f"""SELECT {_sales},
    COUNT(*) FILTER (WHERE delivered_late AND order_status = 'delivered') AS late_deliveries FROM fct_orders"""
VIEWS["monitoring"] = """SELECT *, date_sub('second', started_at, completed_at) AS duration_seconds,
    CASE status WHEN 'SUCCESS' THEN CASE WHEN records_loaded > 0 THEN 'SUCCESS_WITH_DATA'
            WHEN records_loaded = 0 THEN 'SUCCESS_NO_NEW_DATA' ELSE 'UNKNOWN' END
        WHEN 'FAILED' THEN 'FAILED' ELSE 'UNKNOWN' END AS ingestion_result FROM audit"""
VIEWS["unpaid"] = """SELECT order_id, order_status, purchased_at FROM fct_orders
    WHERE order_status = 'delivered' AND payment_count IS NULL"""

_word = re.compile(r"\b[a-z_]+\b")


def statement(final: str) -> str:
    """The select with the views it uses, directly or not, as common table expressions."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in dict.fromkeys(_word.findall(sql)):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name])
                ordered.append(name)

    visit(final)
    if not ordered:
        return final
    parts = ",\n".join(f"{name} AS MATERIALIZED ({VIEWS[name]})" for name in ordered)
    return f"WITH {parts}\n{final}"
