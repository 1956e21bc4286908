"""Raw shop entities derived from the driver tables by Spark.

Every entity covers its whole driver table. The append-only feed (``ingest``)
carries changed versions of the rows that a business attribute selects, such as
one market segment or one order priority.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake import schemas as S
from bazaarlake.functions.expr import MONEY, lower_text, record_hash
from bazaarlake.session import tune

FIRST_FEED, SECOND_FEED = "2002-01-01 00:00:00", "2002-01-02 00:00:00"
UNPAID_BELOW = 6000
TITLE = "\n title\t "
MESSAGE = 'first line\nsaid "second", end '

# Declared, so that opening a table runs no job to look for its schema.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def days(n: str) -> str:
    return f"make_dt_interval(CAST({n} AS INT))"


def minutes(n: str) -> str:
    return f"make_dt_interval(0, 0, CAST({n} AS INT))"


def money(column: str) -> str:
    """Amounts in the driver tables have at most two decimals, which the cast keeps exactly."""
    return f"CAST({column} AS {MONEY.simpleString()})"


BOUGHT = "CAST(o_orderdate AS TIMESTAMP)"

CUSTOMER = {
    "customer_id": "CAST(c_custkey AS STRING)",
    "customer_unique_id": "concat('U', c_custkey DIV 2)",
    "customer_zip_code_prefix": "lpad(CAST(c_custkey AS STRING), 5, '0')",
    "customer_city": "n_name",
    "customer_state": "concat(' ', r_name, ' ')",
}
ORDER = {
    "order_id": "CAST(o_orderkey AS STRING)",
    "customer_id": "CAST(o_custkey AS STRING)",
    "order_status": """CASE WHEN o_orderstatus = 'F' THEN ' Delivered ' WHEN o_orderstatus = 'O' THEN 'shipped'
        WHEN o_orderkey % 2 = 0 THEN 'canceled' ELSE 'processing' END""",
    "order_purchase_timestamp": BOUGHT,
    "order_approved_at": f"IF(o_orderstatus != 'P', {BOUGHT} + {minutes('o_orderkey % 116 + 5')}, NULL)",
    "order_delivered_carrier_date": f"IF(o_orderstatus = 'F', {BOUGHT} + {days('o_orderkey % 3 + 1')}, NULL)",
    "order_delivered_customer_date": f"IF(o_orderstatus = 'F', {BOUGHT} + {days('(o_orderkey * 7) % 17 + 2')}, NULL)",
    "order_estimated_delivery_date": f"{BOUGHT} + {days('(o_orderkey * 5) % 13 + 3')}",
}
ITEM = {
    "order_id": "CAST(l_orderkey AS STRING)",
    "order_item_id": "CAST(l_linenumber AS LONG)",
    "product_id": "CAST(l_partkey AS STRING)",
    "seller_id": "CAST(l_suppkey AS STRING)",
    "shipping_limit_date": "CAST(l_shipdate AS TIMESTAMP)",
    "price": money("l_extendedprice"),
    "freight_value": money("l_quantity"),
}
REVIEW = {
    "review_id": "concat('R', o_orderkey DIV 2)",
    "order_id": "CAST(o_orderkey AS STRING)",
    "review_score": "o_orderkey % 5 + 1",
    "review_comment_title": f"'{TITLE}'",
    "review_comment_message": f"IF(o_orderkey % 4 != 0, '{MESSAGE}', NULL)",
    "review_creation_date": f"{BOUGHT} + {days('(o_orderkey * 7) % 17 + 3')}",
    "review_answer_timestamp": f"{BOUGHT} + {days('(o_orderkey * 7) % 17 + 5')}",
}
PRODUCT = {
    "product_id": "CAST(p_partkey AS STRING)",
    "product_category_name": "CASE p_partkey % 10 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE p_type END",
    "product_name_lenght": "IF(p_partkey % 50 = 0, 'bad', CAST(length(p_name) AS STRING))",
    "product_description_lenght": "CAST(p_size * 10 AS STRING)",
    "product_photos_qty": "CAST(p_size % 8 + 1 AS LONG)",
    "product_weight_g": money("p_size * 100"),
    "product_length_cm": money("p_size"),
    "product_height_cm": money("p_size"),
    "product_width_cm": money("p_size"),
}
SELLER = {
    "seller_id": "CAST(s_suppkey AS STRING)",
    "seller_zip_code_prefix": "lpad(CAST(s_suppkey AS STRING), 5, '0')",
    "seller_city": "concat(' ', n_name)",
    "seller_state": "r_name",
}
GEOLOCATION = {
    "geolocation_zip_code_prefix": "lpad(CAST(c_nationkey AS STRING), 5, '0')",
    "geolocation_city": "concat(n_name, ' ')",
    "geolocation_state": "r_name",
    "geolocation_lat": "IF(c_acctbal < 0, 'n/a', concat(c_custkey % 90, '.25'))",
    "geolocation_lng": "concat('-', c_custkey % 180, '.5')",
}


def expressions(columns: dict[str, str], **changes: str) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in {**columns, **changes}.items()]


def at(text: str) -> str:
    return f"TIMESTAMP '{text}'"


class Shop:
    """Lazily derived frames over one driver folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def raw(self, name: str) -> DataFrame:
        return getattr(self, f"_raw_{name}")()

    def ingest(self, name: str) -> DataFrame:
        """Changed versions with batch metadata, as the append-only tables hold them."""
        rows = getattr(self, f"_feed_{name}")()
        keys = [F.col(k) for k in S.ENTITY[name].keys]
        return rows.withColumns({"_batch_id": F.lit("feed"), "_record_hash": record_hash(*keys)})

    def operational(self, name: str) -> DataFrame:
        """The operational copy: clean order status; masters carry their times as text."""
        rows = self.raw(name)
        if name == "orders":
            return rows.withColumn("order_status", lower_text(F.col("order_status")))
        if name not in ("customers", "products", "sellers"):
            return rows
        key = f"CAST({S.ENTITY[name].keys[0]} AS LONG)"
        created = f"{at('1995-01-01 00:00:00')} + {days(f'({key} * 131) % 2000')}"
        return rows.selectExpr(
            "*",
            f"CAST({created} AS STRING) AS created_at",
            f"CAST({created} + {days(f'({key} * 7) % 500')} AS STRING) AS updated_at",
        )

    # ---- history

    def _places(self, df: DataFrame, nation_key: str) -> DataFrame:
        nation = self.table("nation").withColumnRenamed("n_nationkey", nation_key)
        region = self.table("region").withColumnRenamed("r_regionkey", "n_regionkey")
        return df.join(nation.join(region, "n_regionkey"), nation_key)

    def _customers(self) -> DataFrame:
        return self._places(self.table("customer"), "c_nationkey")

    def _raw_customers(self) -> DataFrame:
        return self._customers().selectExpr(*expressions(CUSTOMER))

    def _raw_orders(self) -> DataFrame:
        return self.table("orders").selectExpr(*expressions(ORDER))

    def _raw_order_items(self) -> DataFrame:
        return self.table("lineitem").selectExpr(*expressions(ITEM))

    def _raw_payments(self) -> DataFrame:
        """One payment per order, a second one for urgent orders, none for small orders."""
        names = "payment_sequential", "payment_type", "payment_installments", "payment_value"
        kinds = "element_at(array('credit_card', 'BOLETO', 'voucher', 'debit_card'), CAST(o_orderkey % 4 + 1 AS INT))"
        first = "1L", kinds, "o_orderkey % 6 + 1", money("o_totalprice")
        second = "2L", "'voucher'", "1L", money("o_orderkey % 50")
        one, two = (
            "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in zip(names, part)) + ")" for part in (first, second)
        )
        parts = f"inline(IF(o_orderpriority = '1-URGENT', array({one}, {two}), array({one})))"
        paid = self.table("orders").filter(f"o_totalprice >= {UNPAID_BELOW}")
        return paid.selectExpr("CAST(o_orderkey AS STRING) AS order_id", parts)

    def _raw_reviews(self) -> DataFrame:
        reviewed = self.table("orders").filter("o_orderstatus = 'F' AND o_orderpriority != '5-LOW'")
        return reviewed.selectExpr(*expressions(REVIEW))

    def _raw_products(self) -> DataFrame:
        return self.table("part").selectExpr(*expressions(PRODUCT))

    def _raw_sellers(self) -> DataFrame:
        return self._places(self.table("supplier"), "s_nationkey").selectExpr(*expressions(SELLER))

    def _raw_geolocation(self) -> DataFrame:
        return self._customers().selectExpr(*expressions(GEOLOCATION))

    # ---- appended versions

    def _feed_customers(self) -> DataFrame:
        """The BUILDING segment moved; half of the change times do not parse. An older
        version of well-funded customers arrives in the same batch and must lose."""
        moved = self._customers().filter("c_mktsegment = 'BUILDING'")
        arrival = {"created_at": "'1999-01-01 00:00:00'", "_ingested_at": at(SECOND_FEED)}
        changed = f"IF(c_custkey % 2 = 0, 'not-a-date', '{FIRST_FEED}')"
        newer = expressions(CUSTOMER, **arrival, customer_city="'moved'", customer_state="'SP'", updated_at=changed)
        older = expressions(CUSTOMER, **arrival, customer_city="'older'", updated_at="'2001-12-01 00:00:00'")
        rich = moved.filter("c_acctbal > 5000")
        return moved.selectExpr(*newer).unionByName(rich.selectExpr(*older))

    def _feed_orders(self) -> DataFrame:
        """Urgent and high orders were delivered; the urgent ones were cancelled a day later."""
        first = expressions(
            ORDER,
            order_status="'delivered'",
            order_approved_at=f"{BOUGHT} + {minutes('30')}",
            order_delivered_carrier_date=f"{BOUGHT} + {days('1')}",
            order_delivered_customer_date=f"{BOUGHT} + {days('4')}",
            _ingested_at=at(FIRST_FEED),
        )
        second = expressions(
            ORDER,
            order_status="'canceled'",
            order_approved_at=f"{BOUGHT} + {minutes('30')}",
            order_delivered_carrier_date="CAST(NULL AS TIMESTAMP)",
            order_delivered_customer_date="CAST(NULL AS TIMESTAMP)",
            order_estimated_delivery_date=f"{BOUGHT} + {days('5')}",
            _ingested_at=at(SECOND_FEED),
        )
        orders = self.table("orders")
        changed = orders.filter("o_orderpriority IN ('1-URGENT', '2-HIGH')").selectExpr(*first)
        return changed.unionByName(orders.filter("o_orderpriority = '1-URGENT'").selectExpr(*second))

    def _feed_order_items(self) -> DataFrame:
        changed = self.table("lineitem").filter("l_returnflag = 'A' AND l_linestatus = 'F'")
        dearer = f"CAST({money('l_extendedprice')} + 1 AS {MONEY.simpleString()})"
        return changed.selectExpr(*expressions(ITEM, price=dearer, _ingested_at=at(FIRST_FEED)))

    def _feed_payments(self) -> DataFrame:
        rows = self._raw_payments().filter("payment_type = 'voucher'")
        value = (F.col("payment_value") + 1).cast(MONEY)
        return rows.withColumns({"payment_value": value, "_ingested_at": F.expr(at(FIRST_FEED))})

    def _feed_reviews(self) -> DataFrame:
        rows = self._raw_reviews().filter("review_score = 1")
        return rows.withColumns({"review_score": F.expr("5L"), "_ingested_at": F.expr(at(FIRST_FEED))})

    def _feed_products(self) -> DataFrame:
        large = self.table("part").filter("p_size > 45")
        return large.selectExpr(
            *expressions(PRODUCT, product_category_name="'relabelled'", _ingested_at=at(FIRST_FEED))
        )

    def _feed_sellers(self) -> DataFrame:
        rich = self._places(self.table("supplier"), "s_nationkey").filter("s_acctbal > 8000")
        return rich.selectExpr(*expressions(SELLER, seller_city="'moved'", _ingested_at=at(FIRST_FEED)))

    # ---- audit

    def audit(self) -> DataFrame:
        """Seven events make one batch; an error event is a failed entity."""
        entities = ", ".join(f"'{e.name}'" for e in S.ENTITIES)
        loaded = "IF(event_type IN ('error', 'signup'), 0L, user_id)"
        started = "CAST(ts AS TIMESTAMP)"
        return self.table("events").selectExpr(
            "concat('B', lpad(CAST(event_id DIV 7 AS STRING), 7, '0')) AS batch_id",
            f"element_at(array({entities}), CAST(event_id % 7 + 1 AS INT)) AS entity",
            f"{started} AS started_at",
            f"{started} + {minutes('user_id % 90')} AS completed_at",
            f"{loaded} AS records_fetched",
            f"{loaded} AS records_loaded",
            f"{started} - {days('1')} AS watermark_before",
            f"IF(event_type != 'error', {started}, NULL) AS watermark_after",
            "IF(event_type = 'error', 'FAILED', 'SUCCESS') AS status",
            "IF(event_type = 'error', props, NULL) AS error_message",
        )
