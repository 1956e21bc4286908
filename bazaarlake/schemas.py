"""Raw schemas, ingest metadata and the description of each ingested entity."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from bazaarlake.functions.expr import MONEY

STRING, LONG, TIME, DOUBLE = T.StringType(), T.LongType(), T.TimestampType(), T.DoubleType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Raw column names, including two that upstream misspells.
CUSTOMERS = _struct(
    customer_id=STRING,
    customer_unique_id=STRING,
    customer_zip_code_prefix=STRING,
    customer_city=STRING,
    customer_state=STRING,
)
PRODUCTS = _struct(
    product_id=STRING,
    product_category_name=STRING,
    product_name_lenght=LONG,
    product_description_lenght=LONG,
    product_photos_qty=LONG,
    product_weight_g=MONEY,
    product_length_cm=MONEY,
    product_height_cm=MONEY,
    product_width_cm=MONEY,
)
SELLERS = _struct(
    seller_id=STRING,
    seller_zip_code_prefix=STRING,
    seller_city=STRING,
    seller_state=STRING,
)
ORDERS = _struct(
    order_id=STRING,
    customer_id=STRING,
    order_status=STRING,
    order_purchase_timestamp=TIME,
    order_approved_at=TIME,
    order_delivered_carrier_date=TIME,
    order_delivered_customer_date=TIME,
    order_estimated_delivery_date=TIME,
)
ORDER_ITEMS = _struct(
    order_id=STRING,
    order_item_id=LONG,
    product_id=STRING,
    seller_id=STRING,
    shipping_limit_date=TIME,
    price=MONEY,
    freight_value=MONEY,
)
PAYMENTS = _struct(
    order_id=STRING,
    payment_sequential=LONG,
    payment_type=STRING,
    payment_installments=LONG,
    payment_value=MONEY,
)
REVIEWS = _struct(
    review_id=STRING,
    order_id=STRING,
    review_score=LONG,
    review_comment_title=STRING,
    review_comment_message=STRING,
    review_creation_date=TIME,
    review_answer_timestamp=TIME,
)
GEOLOCATION = _struct(
    geolocation_zip_code_prefix=STRING,
    geolocation_city=STRING,
    geolocation_state=STRING,
    geolocation_lat=DOUBLE,
    geolocation_lng=DOUBLE,
)
AUDIT = T.StructType(
    [
        T.StructField("batch_id", STRING, False),
        T.StructField("entity", STRING, False),
        T.StructField("started_at", TIME, False),
        T.StructField("completed_at", TIME),
        T.StructField("records_fetched", LONG),
        T.StructField("records_loaded", LONG),
        T.StructField("watermark_before", TIME),
        T.StructField("watermark_after", TIME),
        T.StructField("status", STRING, False),
        T.StructField("error_message", STRING),
    ]
)
WATERMARKS = _struct(entity=STRING, watermark=TIME, saved_at=TIME, sequence=LONG)

RAW_SCHEMAS = {
    "customers": CUSTOMERS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "products": PRODUCTS,
    "payments": PAYMENTS,
    "reviews": REVIEWS,
    "sellers": SELLERS,
    "geolocation": GEOLOCATION,
}

LIFECYCLE = _struct(created_at=STRING, updated_at=STRING)
METADATA = _struct(_batch_id=STRING, _ingested_at=TIME, _record_hash=STRING)


def plus(*parts: T.StructType) -> T.StructType:
    return T.StructType([f for part in parts for f in part.fields])


@dataclass(frozen=True)
class Entity:
    """How one entity is extracted, keyed and stored."""

    name: str
    keys: tuple[str, ...]
    schema: T.StructType
    watermark_column: str
    parent: str | None = field(default=None)

    @property
    def ingest_table(self) -> str:
        return f"_ingest_{self.name}"

    @property
    def ingest_schema(self) -> T.StructType:
        return plus(self.schema, METADATA)


# The ingest order is part of the contract: masters first, then orders, then children.
ENTITIES = (
    Entity("customers", ("customer_id",), plus(CUSTOMERS, LIFECYCLE), "updated_at"),
    Entity("products", ("product_id",), plus(PRODUCTS, LIFECYCLE), "updated_at"),
    Entity("sellers", ("seller_id",), plus(SELLERS, LIFECYCLE), "updated_at"),
    Entity("orders", ("order_id",), ORDERS, "order_purchase_timestamp"),
    Entity("order_items", ("order_id", "order_item_id"), ORDER_ITEMS, "order_purchase_timestamp", "orders"),
    Entity("payments", ("order_id", "payment_sequential"), PAYMENTS, "order_purchase_timestamp", "orders"),
    Entity("reviews", ("review_id", "order_id"), REVIEWS, "review_creation_date"),
)
ENTITY = {entity.name: entity for entity in ENTITIES}


def landing_schema(entity: Entity) -> T.StructType:
    """What a landed feed holds: the entity's columns, and for a child its parent's time."""
    if entity.parent is None:
        return entity.schema
    return plus(entity.schema, T.StructType([ENTITY[entity.parent].schema[entity.watermark_column]]))

#: The columns of a staged record of each entity, before cleaning.
RECORD = {**{name: schema for name, schema in RAW_SCHEMAS.items() if name in ENTITY}, "reviews": REVIEWS}
