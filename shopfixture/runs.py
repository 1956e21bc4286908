"""Registered queries for operators that write: they work in a new folder of the shared
scratch area and return what they wrote, read back."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake import schemas as S
from bazaarlake.functions.expr import record_hash
from bazaarlake.operators import incremental, maintenance, pages
from bazaarlake.operators.fused_checks import run_fused
from bazaarlake.operators.latest import EPOCH, conform
from bazaarlake.operators.quality import run_checks
from bazaarlake.plans import bitmaps, checks, committed, ingest
from bazaarlake.plans.build import BUILD_THREADS, build_models, staged
from bazaarlake.plans.touched import TouchedModels
from bazaarlake.schemas import ENTITIES, ENTITY
from bazaarlake.session import scratch_path, side_by_side
from bazaarlake.sources import csv_files, ingest_log, landing, tables
from bazaarlake.streaming import feed
from shopfixture.catalogue import ITEM_MONEY, ORDER_MONEY, query, replaced
from shopfixture.models import Models
from shopfixture.oracle import VIEWS, dbl
from shopfixture.shop import FIRST_FEED, SECOND_FEED

CLOCK = datetime(2002, 2, 1, tzinfo=timezone.utc)
BATCH = "20020201T000000_0000abcd"
MASTER_MARK, ORDER_MARK, REVIEW_MARK = "1997-01-01 00:00:00", "1999-01-01 00:00:00", "1999-06-01 00:00:00"
FAR_MARK = "2100-01-01 00:00:00"
MARKS = {
    "customers": MASTER_MARK,
    "products": MASTER_MARK,
    "sellers": MASTER_MARK,
    "orders": ORDER_MARK,
    "order_items": ORDER_MARK,
    "payments": ORDER_MARK,
    "reviews": REVIEW_MARK,
}
MASTERS = ("customers", "products", "sellers")
NOW_SQL = "TIMESTAMP '2002-02-01 00:00:00'"


def moment(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def workspace(m: Models) -> tables.Layers:
    """Four new namespaces below the shared scratch folder."""
    tag = uuid.uuid4().hex[:12]
    layers = tables.Layers(f"raw_{tag}", f"staging_{tag}", f"intermediate_{tag}", f"analytics_{tag}")
    return tables.create_layers(m.spark, layers, scratch_path(m.spark, "layers"))


def fill_raw(m: Models, raw: str) -> None:
    for name in S.RAW_SCHEMAS:
        tables.overwrite_table(m.raw(name), raw, name)
    for entity in ENTITIES:
        tables.append_table(m.ingest(entity.name), raw, entity.ingest_table)
    tables.append_table(m.audit(), raw, tables.AUDIT_TABLE)


def run(m: Models, names, marks=MARKS, batch_id: str | None = BATCH) -> str:
    """Ingest the entities into a new raw namespace with a stopped clock; its name."""
    raw = workspace(m).raw
    store = ingest_log.WatermarkStore(m.spark, raw)
    store.save_all([(n, moment(t)) for n, t in marks.items()])
    source = {e.name: m.operational(e.name) for e in ENTITIES}
    entities = tuple(ENTITY[n] for n in names)
    ingest.run_batch(m.spark, source, raw, batch_id, lambda: CLOCK, entities)
    return raw


ALL = tuple(e.name for e in ENTITIES)

# SQL views of what each extract returns.
for _name in MASTERS:
    VIEWS[f"new_{_name}"] = f"""SELECT *, CAST(updated_at AS TIMESTAMP) AS source_time FROM op_{_name}
    WHERE source_time > TIMESTAMP '{MASTER_MARK}'"""
VIEWS["new_orders"] = f"""SELECT *, order_purchase_timestamp AS source_time FROM op_orders
    WHERE source_time > TIMESTAMP '{ORDER_MARK}'"""
for _name in ("order_items", "payments"):
    VIEWS[f"new_{_name}"] = f"""SELECT op_{_name}.*, order_purchase_timestamp, source_time
    FROM op_{_name} JOIN new_orders USING (order_id)"""
VIEWS["new_reviews"] = f"""SELECT *, review_creation_date AS source_time FROM op_reviews
    WHERE source_time > TIMESTAMP '{REVIEW_MARK}'"""


def each(template: str, names=ALL) -> str:
    return " UNION ALL ".join(
        template.format(name=n, before=f"TIMESTAMP '{MARKS[n]}'", key=ENTITY[n].keys[0]) for n in names
    )


def hash_sql(*keys: str) -> str:
    return "sha256(" + " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), 'None')" for k in keys) + ")"


#: A quoted export cannot be split: one task reads a file, so files stay small.
EXPORT_ROWS = 500_000


def export_csv(m: Models, names, folder: str) -> None:
    stems = {table: stem for stem, table in csv_files.EXPORTS.items()}
    for name in names:
        writer = m.raw(name).write.option("header", True).option("escape", '"').option("maxRecordsPerFile", EXPORT_ROWS)
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        writer.option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(f"{folder}/{stems[name]}.csv")


def to_pages(df: DataFrame, position: Column, limit: int = landing.PAGE_SIZE) -> DataFrame:
    """Envelopes of at most ``limit`` rows; the position is unique and not below zero."""
    page = F.floor(position / limit).alias("page")
    pages = df.groupBy(page).agg(F.count("*").alias("count"), F.collect_list(F.struct(*df.columns)).alias("data"))
    return pages.drop("page")


def row_counts(m: Models, namespace: str, names) -> DataFrame:
    counted = None
    for name in names:
        part = m.spark.table(f"{namespace}.{name}").agg(F.count("*").alias("row_count"))
        part = part.select(F.lit(name).alias("table_name"), "row_count")
        counted = part if counted is None else counted.unionByName(part)
    return counted


def counts_sql(prefix: str, names) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {prefix}_{n}" for n in names
    )


# ---------------------------------------------------------------- sources and sinks


@query("s01_csv_full_load", "SELECT * FROM raw_reviews")
def _(m):
    """Reviews hold quotes and line breaks in their text."""
    folder, raw = scratch_path(m.spark, "csv"), workspace(m).raw
    export_csv(m, ["reviews"], folder)
    item = next(i for i in csv_files.csv_catalogue(folder) if i.table == "reviews")
    csv_files.csv_full_load(m.spark, item, raw)
    return m.spark.table(f"{raw}.reviews")


def typed(column: str, field: T.StructField) -> str:
    """A number as the export's reader has it: text that isn't one is NULL."""
    kind = {"bigint": "BIGINT", "double": "DOUBLE"}.get(field.dataType.simpleString())
    return f"TRY_CAST(CAST({column} AS VARCHAR) AS {kind})" if kind else column


def profile(table: DataFrame, name: str) -> DataFrame:
    """Known and different values of every column, and the length of text, each column grouped by itself.

    Distinct counts of many columns at once copy the wide row for each of them; here only a column's own values are read and shuffled.
    """

    def of(f: T.StructField) -> DataFrame:
        values = table.select(F.col(f.name).alias("value")).where("value IS NOT NULL").groupBy("value").agg(F.count("*").alias("n"))
        characters = F.sum(F.length("value") * F.col("n")) if isinstance(f.dataType, T.StringType) else F.lit(0)
        totals = {"known": F.sum("n"), "different": F.count("*"), "characters": characters}
        found = values.agg(*[F.coalesce(total, F.lit(0)).cast("long").alias(c) for c, total in totals.items()])
        return found.select(F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"), *totals)

    return reduce(DataFrame.unionByName, map(of, table.schema.fields))


@query(
    "s02_csv_load_catalogue",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS table_name, '{c}' AS column_name, COUNT({typed(c, kind)}) AS known,
        COUNT(DISTINCT {typed(c, kind)}) AS different,
        coalesce(SUM(length(CAST({c} AS VARCHAR))) FILTER (WHERE {'TRUE' if kind.dataType.simpleString() == 'string' else 'FALSE'}), 0)
        AS characters FROM raw_{n}"""
        for n, schema in S.RAW_SCHEMAS.items()
        for c, kind in zip(schema.names, schema.fields, strict=True)
    ),
)
def _(m):
    """Every column of every table: known and different values, and the length of text."""
    folder, raw = scratch_path(m.spark, "csv"), workspace(m).raw
    export_csv(m, S.RAW_SCHEMAS, folder)
    items = csv_files.csv_catalogue(folder)
    csv_files.load_catalogue(m.spark, items, raw)
    return reduce(DataFrame.unionByName, [profile(m.spark.table(f"{raw}.{i.table}"), i.table) for i in items])


@query("s03_loaded_row_count", counts_sql("raw", S.RAW_SCHEMAS))
def _(m):
    """The counts are observed by the loads themselves."""
    raw = workspace(m).raw
    counts = [(name, tables.overwrite_table(m.raw(name), raw, name)) for name in S.RAW_SCHEMAS]
    return m.spark.createDataFrame(counts, "table_name string, row_count long")


@query("s04_csv_replace_bootstrap", counts_sql("raw", ALL))
def _(m):
    """Loading twice replaces."""
    folder, copy = scratch_path(m.spark, "csv"), workspace(m).staging
    export_csv(m, ALL, folder)
    items = csv_files.operational_catalogue(folder)
    csv_files.load_catalogue(m.spark, items, copy)
    csv_files.load_catalogue(m.spark, items, copy)
    return row_counts(m, copy, ALL)


@query("s05_read_landing_pages", "SELECT * FROM raw_orders")
def _(m):
    """Three fetch runs in one folder, with pages of 1000, 100 and 700 rows, short ones among them."""
    path = scratch_path(m.spark, "pages")
    number = F.col("order_id").cast("long")
    for part, limit in enumerate((1000, 100, 700)):
        rows = m.raw("orders").filter(F.pmod(number, F.lit(3)) == part)
        to_pages(rows, number, limit).write.mode("append").json(path)
    return landing.read_landing_pages(m.spark, path, S.ORDERS)


@query(
    "s06_append_batch",
    f"""SELECT customer_id, batch AS _batch_id, {NOW_SQL} AS _ingested_at, {hash_sql('customer_id')} AS _record_hash
    FROM op_customers, (SELECT unnest(['one', 'two']) AS batch)""",
)
def _(m):
    raw = workspace(m).raw
    for batch_id in ("one", "two"):
        ingest_log.append_batch(m.operational("customers"), raw, "_ingest_customers", ["customer_id"], batch_id, CLOCK)
    appended = m.spark.table(f"{raw}._ingest_customers")
    return appended.select("customer_id", "_batch_id", "_ingested_at", "_record_hash")


@query(
    "s07_record_hash",
    f"""SELECT product_id, {hash_sql('product_id', 'product_category_name')} AS record_hash FROM raw_products""",
)
def _(m):
    keys = record_hash(F.col("product_id"), F.col("product_category_name"))
    return m.raw("products").select("product_id", keys.alias("record_hash"))


AUDIT_SQL = each(
    f"""SELECT '{BATCH}' AS batch_id, '{{name}}' AS entity, {NOW_SQL} AS started_at, {NOW_SQL} AS completed_at,
    COUNT(*) AS records_fetched, COUNT(*) AS records_loaded, {{before}} AS watermark_before,
    coalesce(MAX(source_time), {{before}}) AS watermark_after, 'SUCCESS' AS status,
    CAST(NULL AS VARCHAR) AS error_message FROM new_{{name}}"""
)


@query("s08_audit_append", AUDIT_SQL)
def _(m):
    return m.spark.table(f"{run(m, ALL)}.{tables.AUDIT_TABLE}")


@query(
    "s09_source_registry",
    counts_sql("raw", S.RAW_SCHEMAS)
    + " UNION ALL "
    + " UNION ALL ".join(f"SELECT '_ingest_{n}', COUNT(*) FROM feed_{n}" for n in ALL)
    + " UNION ALL SELECT 'ingestion_audit', COUNT(*) FROM audit",
)
def _(m):
    raw = workspace(m).raw
    fill_raw(m, raw)
    found = None
    for name in tables.SOURCES:
        part = tables.source(m.spark, raw, name).agg(F.count("*").alias("row_count"))
        part = part.select(F.lit(name).alias("table_name"), "row_count")
        found = part if found is None else found.unionByName(part)
    return found


@query("s10_create_namespace", "SELECT seller_id, seller_city FROM raw_sellers")
def _(m):
    """Creating twice keeps what is there."""
    name, place = f"shop_{uuid.uuid4().hex[:12]}", scratch_path(m.spark, "namespace")
    tables.create_namespace(m.spark, name, place)
    tables.overwrite_table(m.raw("sellers"), name, "sellers")
    tables.create_namespace(m.spark, name, place)
    return m.spark.table(f"{name}.sellers").select("seller_id", "seller_city")


@query(
    "s11_materialize",
    f"""SELECT product_id, product_category_name, units_sold, {dbl('total_revenue')} AS total_revenue
    FROM dim_products""",
)
def _(m):
    """A staged table, a view in its namespace, and the mart as a table over them."""
    from bazaarlake.plans import intermediate, marts

    layers, units = workspace(m), ("product_id", "units_sold", "order_count", "total_revenue", "total_freight", "average_item_price")
    products = tables.materialize_table(m.staged("products"), layers.staging, "stg_products")
    tables.materialize_table(intermediate.int_product_sales(m.items), layers.intermediate, "int_product_sales")
    query = tables.projection(layers.intermediate, "int_product_sales", units)
    tables.materialize_view(m.spark, layers.intermediate, "int_sales_view", query)
    sales = m.spark.table(f"{layers.intermediate}.int_sales_view")
    table = tables.materialize_table(marts.dim_products(products, sales), layers.marts, "dim_products")
    return table.select("product_id", "product_category_name", "units_sold", "total_revenue")


@query(
    "s12_route_namespace",
    """SELECT 'own' AS layer, seller_id FROM raw_sellers UNION ALL SELECT 'default', customer_id FROM raw_customers""",
)
def _(m):
    layers = workspace(m)
    own = tables.route_namespace(f" {layers.marts} ", layers.staging)
    default = tables.route_namespace(None, layers.staging)
    tables.overwrite_table(m.raw("sellers"), own, "routed")
    tables.overwrite_table(m.raw("customers"), default, "routed")
    first = m.spark.table(f"{layers.marts}.routed").select(F.lit("own").alias("layer"), "seller_id")
    second = m.spark.table(f"{layers.staging}.routed").select(F.lit("default"), "customer_id")
    return first.union(second)


MARK_SQL = each(
    "SELECT '{name}' AS entity, coalesce(MAX(source_time), {before}) AS watermark FROM new_{name}"
)


@query("s13_watermark_store", MARK_SQL)
def _(m):
    return ingest_log.WatermarkStore(m.spark, run(m, ALL)).load()


# ---------------------------------------------------------------- incremental


@query("i01_extract_updated_after", each("SELECT '{name}' AS entity, {key} AS id, updated_at FROM new_{name}", MASTERS))
def _(m):
    found = None
    for name in MASTERS:
        rows = incremental.extract_after(m.operational(name), "updated_at", MASTER_MARK)
        part = rows.select(F.lit(name).alias("entity"), F.col(ENTITY[name].keys[0]).alias("id"), "updated_at")
        found = part if found is None else found.unionByName(part)
    return found


@query("i02_extract_created_after", "SELECT * EXCLUDE (source_time) FROM new_orders")
def _(m):
    return incremental.extract_after(m.operational("orders"), "order_purchase_timestamp", ORDER_MARK)


@query(
    "i03_extract_children_after",
    """SELECT 'order_items' AS entity, order_id, order_item_id AS position, order_purchase_timestamp FROM new_order_items
    UNION ALL SELECT 'payments', order_id, payment_sequential, order_purchase_timestamp FROM new_payments""",
)
def _(m):
    time = "order_purchase_timestamp"

    def part(name, position):
        rows = incremental.extract_children_after(
            m.operational(name), m.operational("orders"), "order_id", time, ORDER_MARK
        )
        return rows.select(F.lit(name).alias("entity"), "order_id", F.col(position).alias("position"), time)

    return part("order_items", "order_item_id").unionByName(part("payments", "payment_sequential"))


@query("i04_extract_reviews_after", "SELECT * EXCLUDE (source_time) FROM new_reviews")
def _(m):
    return incremental.extract_after(m.operational("reviews"), "review_creation_date", REVIEW_MARK)


@query("i05_extract_full", each("SELECT '{name}' AS entity, {key} AS id FROM op_{name}"))
def _(m):
    source = {name: m.operational(name) for name in ALL}
    found = None
    for entity in ENTITIES:
        rows = ingest.extract(entity, source, None)
        part = rows.select(F.lit(entity.name).alias("entity"), F.col(entity.keys[0]).alias("id"))
        found = part if found is None else found.unionByName(part)
    return found


@query(
    "i06_page",
    "SELECT * FROM op_orders ORDER BY order_purchase_timestamp, order_id LIMIT 1000 OFFSET 250",
)
def _(m):
    return incremental.page(m.operational("orders"), ["order_purchase_timestamp", "order_id"], 1000, 250)


@query(
    "i07_geolocation_page",
    "SELECT * FROM raw_geolocation ORDER BY ALL NULLS FIRST LIMIT 100 OFFSET 20",
)
def _(m):
    return incremental.geolocation_page(m.raw("geolocation"), 100, 20)


ORDER_PLACE = ["order_purchase_timestamp", "order_id"]


@query("i06_indexed_page", "SELECT * FROM op_orders ORDER BY order_purchase_timestamp, order_id LIMIT 1000 OFFSET 7250")
def _(m):
    """A deep page: its ranges are looked up in the index."""
    orders = pages.paged(m.operational("orders"), ORDER_PLACE, scratch_path(m.spark, "pages"), range_rows=2000)
    return orders.page(1000, 7250)


@query("i06_next_page", "SELECT * FROM op_orders ORDER BY order_purchase_timestamp, order_id LIMIT 1000 OFFSET 5000")
def _(m):
    """The page behind a key: the last one of the page before is the token."""
    orders = pages.paged(m.operational("orders"), ORDER_PLACE, scratch_path(m.spark, "pages"), range_rows=2000)
    last = orders.page(1, 4999).select(*ORDER_PLACE).first()
    return orders.after(tuple(last), 1000) if last else orders.page(1000, 5000)  # no such row: nothing follows it


@query(
    "i07_indexed_geolocation_page",
    "SELECT * FROM raw_geolocation ORDER BY ALL NULLS FIRST LIMIT 1000 OFFSET 300",
)
def _(m):
    places = m.raw("geolocation")
    return pages.paged(places, places.columns, scratch_path(m.spark, "pages"), range_rows=500).page(1000, 300)


@query(
    "i08_entity_count",
    each("SELECT '{name}' AS entity, COUNT(*) AS count FROM op_{name}", (*MASTERS, "orders")),
)
def _(m):
    found = None
    for name in (*MASTERS, "orders"):
        part = incremental.entity_count(m.operational(name)).select(F.lit(name).alias("entity"), "count")
        found = part if found is None else found.unionByName(part)
    return found


@query(
    "i09_source_status",
    f"""SELECT *, (SELECT MAX(order_purchase_timestamp) FROM op_orders) AS latest_order_timestamp
    FROM ({counts_sql('op', ALL)})""",
)
def _(m):
    source = {name: m.operational(name) for name in ALL}
    return incremental.source_status(source, source["orders"], "order_purchase_timestamp")


def metadata_sql(*keys: str) -> str:
    return f"'{BATCH}' AS _batch_id, {NOW_SQL} AS _ingested_at, {hash_sql(*keys)} AS _record_hash"


MASTERS, TRANSACTIONS = ("customers", "products", "sellers"), ("orders", "order_items", "payments")


def ingested_sql(names) -> str:
    """Keys and metadata of the rows that a batch appends."""
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS entity, CAST({ENTITY[n].keys[0]} AS VARCHAR) AS id, '{BATCH}' AS _batch_id, {NOW_SQL} AS _ingested_at,
        {hash_sql(*ENTITY[n].keys)} AS _record_hash FROM new_{n}"""
        for n in names
    )


def ingested(m: Models, names) -> DataFrame:
    raw, found = run(m, list(names)), None
    for n in names:
        part = m.spark.table(f"{raw}.{ENTITY[n].ingest_table}").select(
            F.lit(n).alias("entity"), F.col(ENTITY[n].keys[0]).cast("string").alias("id"), "_batch_id", "_ingested_at", "_record_hash"
        )
        found = part if found is None else found.unionByName(part)
    return found


@query("i10_ingest_masters", ingested_sql(MASTERS))
def _(m):
    return ingested(m, MASTERS)


@query("i11_ingest_transactions", ingested_sql(TRANSACTIONS))
def _(m):
    return ingested(m, TRANSACTIONS)


@query(
    "i10_ingest_dimension",
    f"SELECT * EXCLUDE (source_time), {metadata_sql('customer_id')} FROM new_customers",
)
def _(m):
    return m.spark.table(f"{run(m, ['customers'])}._ingest_customers")


@query(
    "i11_ingest_transaction",
    f"""SELECT * EXCLUDE (source_time, order_purchase_timestamp) REPLACE ({dbl('price')} AS price,
    {dbl('freight_value')} AS freight_value), {metadata_sql('order_id', 'order_item_id')} FROM new_order_items""",
)
def _(m):
    return m.spark.table(f"{run(m, ['order_items'])}._ingest_order_items")


@query(
    "i12_ingest_reviews",
    f"SELECT * EXCLUDE (source_time), {metadata_sql('review_id', 'order_id')} FROM new_reviews",
)
def _(m):
    return m.spark.table(f"{run(m, ['reviews'])}._ingest_reviews")


@query("i13_advance_watermark", MARK_SQL)
def _(m):
    """The next watermark of every entity, from its extract alone."""
    source = {name: m.operational(name) for name in ALL}
    found = None
    for entity in ENTITIES:
        rows = ingest.extract(entity, source, moment(MARKS[entity.name]))
        part = incremental.next_watermark(rows, entity.watermark_column)
        part = part.select(
            F.lit(entity.name).alias("entity"),
            F.coalesce("watermark", F.lit(MARKS[entity.name]).cast("timestamp")).alias("watermark"),
        )
        found = part if found is None else found.unionByName(part)
    return found


@query(
    "i14_project_to_schema",
    """SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
    order_delivered_carrier_date, order_delivered_customer_date,
    CAST(NULL AS TIMESTAMP) AS order_estimated_delivery_date FROM raw_orders""",
)
def _(m):
    """One declared column is missing, one undeclared column is there."""
    rows = m.raw("orders").drop("order_estimated_delivery_date").withColumn("extra", F.lit(1))
    return rows.select(*conform(rows, S.ORDERS))


@query(
    "i15_empty_batch",
    each(
        f"""SELECT '{{name}}' AS entity, CAST(0 AS BIGINT) AS records_fetched, CAST(0 AS BIGINT) AS records_loaded,
    TIMESTAMP '{FAR_MARK}' AS watermark_before, TIMESTAMP '{FAR_MARK}' AS watermark_after, 'SUCCESS' AS status,
    COUNT(*) FILTER (WHERE FALSE) AS appended FROM new_{{name}}"""
    ),
)
def _(m):
    raw = run(m, ALL, {name: FAR_MARK for name in ALL})
    audit = m.spark.table(f"{raw}.{tables.AUDIT_TABLE}")
    appended = row_counts(m, raw, [f"_ingest_{name}" for name in ALL])
    appended = appended.select(
        F.regexp_replace("table_name", "^_ingest_", "").alias("entity"), F.col("row_count").alias("appended")
    )
    columns = ["entity", "records_fetched", "records_loaded", "watermark_before", "watermark_after", "status"]
    return audit.select(*columns).join(appended, "entity")


@query(
    "i16_run_with_audit",
    f"""SELECT 'customers' AS entity, COUNT(*) AS records_fetched, COUNT(*) AS records_loaded,
    TIMESTAMP '{MASTER_MARK}' AS watermark_before,
    coalesce(MAX(source_time), TIMESTAMP '{MASTER_MARK}') AS watermark_after, 'SUCCESS' AS status,
    CAST(NULL AS VARCHAR) AS error_message FROM new_customers
    UNION ALL SELECT 'products', 0, 0, TIMESTAMP '{MASTER_MARK}', NULL, 'FAILED', 'source is down'""",
)
def _(m):
    """The second entity fails: audited, raised, and nothing after it runs."""
    raw = workspace(m).raw
    store = ingest_log.WatermarkStore(m.spark, raw)
    store.save_all([(name, moment(mark)) for name, mark in MARKS.items()])

    def fail():
        raise ConnectionError("source is down")

    source = {"customers": m.operational("customers")}
    work = {
        "customers": lambda: ingest.ingest_entity(ENTITY["customers"], source, raw, store, BATCH, CLOCK),
        "products": fail,
        "sellers": fail,
    }
    try:
        for name, job in work.items():
            ingest.run_with_audit(m.spark, raw, BATCH, name, store.get(name), job, lambda: CLOCK)
    except ConnectionError:
        pass
    audit = m.spark.table(f"{raw}.{tables.AUDIT_TABLE}")
    return audit.drop("batch_id", "started_at", "completed_at")


@query(
    "i17_run_batch",
    each(f"SELECT '{{name}}' AS entity, '{BATCH}' AS _batch_id, {{key}} AS id FROM new_{{name}}"),
)
def _(m):
    raw = run(m, ALL)
    found = None
    for entity in ENTITIES:
        rows = m.spark.table(f"{raw}.{entity.ingest_table}")
        part = rows.select(F.lit(entity.name).alias("entity"), "_batch_id", F.col(entity.keys[0]).alias("id"))
        found = part if found is None else found.unionByName(part)
    return found


@query("i18_new_batch_id", "SELECT order_id, TRUE AS well_formed FROM new_orders")
def _(m):
    """Without a given id the batch gets one: UTC time and eight hex digits."""
    rows = m.spark.table(f"{run(m, ['orders'], batch_id=None)}._ingest_orders")
    return rows.select("order_id", F.col("_batch_id").rlike("^20020201T000000_[0-9a-f]{8}$").alias("well_formed"))


@query(
    "i19_init_watermarks",
    f"""SELECT 'customers' AS entity, TIMESTAMP '2018-11-04 23:17:19' AS watermark
    UNION ALL SELECT unnest(['products', 'sellers']), TIMESTAMP '{ingest.MASTER_CUTOFF}'
    UNION ALL SELECT unnest(['orders', 'order_items', 'payments']), MAX(order_purchase_timestamp) FROM raw_orders
    UNION ALL SELECT 'reviews', MAX(review_creation_date) FROM raw_reviews""",
)
def _(m):
    saved = m.spark.createDataFrame([("customers", "2018-11-04 23:17:19")], "entity string, watermark string")
    existing = saved.withColumn("watermark", F.col("watermark").cast("timestamp"))
    return ingest.init_watermarks(existing, m.raw("orders"), m.raw("reviews"))


class Unreachable(Exception):
    pass


def committed_runs(m: Models, wait: int) -> str:
    """Shipped orders turn up on the second day only; on that day the fifth entity fails once. History ends at the first mark."""
    raw = workspace(m).raw
    for name, schema in S.RAW_SCHEMAS.items():
        known = m.operational(name).select(*schema.names)
        known = known.where(f"order_purchase_timestamp <= '{ORDER_MARK}'") if name == "orders" else known
        tables.overwrite_table(known, raw, name)
    tables.create_append_tables(m.spark, raw)
    committed.start_watermarks(m.spark, raw, {n: moment(t) for n, t in MARKS.items()}, CLOCK)
    source = {e.name: m.operational(e.name) for e in ENTITIES}
    timely = source | {"orders": source["orders"].where("order_status != 'shipped'")}

    class Breaking(dict):
        def __getitem__(self, name):
            if name == "order_items":
                raise Unreachable(name)
            return super().__getitem__(name)

    def run_once(batch: str, operational) -> None:
        overlap = timedelta(days=wait)
        committed.run_committed_batch(m.spark, operational, raw, batch, lambda: CLOCK, overlap)

    run_once("first", timely)
    try:
        run_once("torn", Breaking(source))
    except Unreachable:
        pass
    run_once("second", source)
    run_once("third", source)
    return raw


VIEWS["after_orders"] = f"""SELECT *, if(order_status = 'shipped', 'second', 'first') AS _batch_id FROM op_orders
    WHERE order_purchase_timestamp > TIMESTAMP '{ORDER_MARK}'"""


@query("i13_late_orders_ingested", "SELECT order_id, order_status, _batch_id FROM after_orders")
def _(m):
    """Late orders come in with the second batch, once; the torn batch is not seen, the third finds nothing new."""
    rows = committed.committed(m.spark, committed_runs(m, 4000), ENTITY["orders"])
    return rows.select("order_id", "order_status", "_batch_id")


@query(
    "i17_committed_batch",
    f"""SELECT 'first' AS batch_id, 'orders' AS entity, COUNT(*) FILTER (WHERE _batch_id = 'first') AS records,
        MAX(order_purchase_timestamp) FILTER (WHERE _batch_id = 'first') AS watermark FROM after_orders
    UNION ALL SELECT 'second', 'orders', COUNT(*) FILTER (WHERE _batch_id = 'second'), MAX(order_purchase_timestamp) FROM after_orders
    UNION ALL SELECT 'third', 'orders', 0, MAX(order_purchase_timestamp) FROM after_orders
    UNION ALL SELECT 'start', 'orders', 0, TIMESTAMP '{ORDER_MARK}'""",
)
def _(m):
    log = committed.commits(m.spark, committed_runs(m, 4000)).where("entity = 'orders'")
    return log.select("batch_id", "entity", "records", "watermark")


@query("t02_committed_orders", "SELECT order_id, order_status FROM op_orders")
def _(m):
    """Staging that sees the history and committed batches only."""
    rows = staged(m.spark, committed_runs(m, 4000), committed_only=True)["stg_orders"]
    return rows.select("order_id", "order_status")


def daily_bitmaps(m: Models) -> DataFrame:
    numbers = tables.written(bitmaps.numbered(m.fct_orders), "numbers")
    return bitmaps.daily_bitmaps(m.fct_orders, numbers)


@query(
    "m10_daily_distinct_bitmaps",
    "SELECT CAST(sales_date AS TIMESTAMP) AS sales_date, total_orders, unique_customers FROM daily_sales",
)
def _(m):
    return bitmaps.distinct_counts(daily_bitmaps(m).where("sales_date IS NOT NULL"), sales_date=F.col("sales_date"))


@query(
    "m10_monthly_distinct_bitmaps",
    """SELECT date_trunc('month', purchased_at)::TIMESTAMP AS month, COUNT(DISTINCT order_id) AS total_orders,
    COUNT(DISTINCT customer_unique_id) AS unique_customers FROM fct_orders WHERE purchased_at IS NOT NULL GROUP BY ALL""",
)
def _(m):
    """Months from the stored daily bitmaps alone."""
    daily = tables.written(daily_bitmaps(m), "daily-bitmaps")
    return bitmaps.distinct_counts(daily.where("sales_date IS NOT NULL"), month=F.trunc("sales_date", "month"))


@query("m12_total_distinct_bitmaps", "SELECT total_orders, unique_customers FROM overall_metrics")
def _(m):
    return bitmaps.distinct_counts(daily_bitmaps(m))


_positions = ", ".join(f"({i + 1}, '{e.name}')" for i, e in enumerate(ENTITIES))


@query(
    "i20_validate_batch",
    f"""SELECT batch_id, position, entity, CASE WHEN status IS NULL THEN 'missing entity' ELSE 'not successful' END AS problem
    FROM (SELECT DISTINCT batch_id FROM audit) CROSS JOIN (VALUES {_positions}) AS expected(position, entity)
    LEFT JOIN audit USING (batch_id, entity) WHERE status IS DISTINCT FROM 'SUCCESS'""",
)
def _(m):
    """Every batch of the log is judged; sound entities are left out."""
    judged = checks.batch_problems(m.monitoring).filter(F.col("problem").isNotNull())
    return judged.select("batch_id", "position", "entity", "problem")


# ---------------------------------------------------------------- checks

SQL_MODEL = {
    "int_orders_enriched": "enriched",
    "int_customer_orders": "enriched",
    "int_product_sales": "product_sales",
    "int_seller_performance": "performance",
    "mart_customer_rfm": "rfm",
    "mart_daily_sales": "daily_sales",
    "mart_ingestion_monitoring": "monitoring",
}


def check_sql(check) -> str:
    model = SQL_MODEL.get(check.model, check.model)
    column = ", ".join(check.columns)
    if check.kind == "not_null":
        count = f"SELECT COUNT(*) - COUNT({column}) AS n FROM {model}"
    elif check.kind in ("unique", "composite_unique"):
        known = f"WHERE {column} IS NOT NULL" if check.kind == "unique" else ""
        count = f"SELECT COUNT(*) AS n FROM (SELECT {column} FROM {model} {known} GROUP BY ALL HAVING COUNT(*) > 1)"
    elif check.kind == "relationships":
        parent = SQL_MODEL.get(check.parent, check.parent)
        count = f"""SELECT COUNT(*) AS n FROM {model} WHERE {column} IS NOT NULL
        AND {column} NOT IN (SELECT {check.parent_field} FROM {parent})"""
    elif check.kind == "accepted_values":
        allowed = ", ".join(f"'{v}'" for v in check.values)
        count = f"SELECT COUNT(*) AS n FROM {model} WHERE {column} NOT IN ({allowed})"
    else:
        bad = {
            "valid_record_counts": "least(records_fetched, records_loaded) < 0 OR records_loaded > records_fetched",
            "valid_duration": "completed_at < started_at",
            "paid_when_delivered": "order_status = 'delivered' AND payment_count IS NULL",
        }[check.label]
        count = f"SELECT COUNT(*) AS n FROM {model} WHERE {bad}"
    fail = "warn" if check.severity == "warn" else "fail"
    return f"""SELECT '{check.model}' AS model, '{check.label}' AS check_name, '{check.severity}' AS severity,
    n AS failures, if(n = 0, 'pass', '{fail}') AS status FROM ({count})"""


@query("q09_run_checks", " UNION ALL ".join(check_sql(c) for c in checks.suite()))
def _(m):
    """The whole suite over the built models."""
    layers = workspace(m)
    fill_raw(m, layers.raw)
    return run_checks(build_models(m.spark, layers), checks.suite())


@query("q09_fused_checks", " UNION ALL ".join(check_sql(c) for c in checks.suite()))
def _(m):
    """The same suite with one scan for a model's rows and one for each of its keys."""
    layers = workspace(m)
    fill_raw(m, layers.raw)
    return run_fused(build_models(m.spark, layers), checks.suite())


# ---------------------------------------------------------------- builds of touched keys


def second_day(m: Models) -> TouchedModels:
    """The first build has history and the first day's feed; the second one takes in the next day's batch."""
    layers = workspace(m)
    # the tables do not depend on each other
    loads = [partial(tables.overwrite_table, m.raw(name), layers.raw, name) for name in S.RAW_SCHEMAS]
    side_by_side(m.spark, loads, BUILD_THREADS)
    models = TouchedModels(m.spark, layers, buckets=8)
    for day, arrival in (("day1", FIRST_FEED), ("day2", SECOND_FEED)):
        appends = []
        for entity in ENTITIES:
            rows = m.ingest(entity.name).where(F.col("_ingested_at") == arrival).withColumn("_batch_id", F.lit(day))
            appends.append(partial(tables.append_table, rows, layers.raw, entity.ingest_table))
        side_by_side(m.spark, appends, BUILD_THREADS)
        models.build()
    return models


@query("t02_touched_orders", "SELECT * FROM stg_orders")
def _(m):
    return second_day(m).staged("orders")


@query("n05_touched_orders_enriched", replaced("enriched", ORDER_MONEY))
def _(m):
    return second_day(m).model("int_orders_enriched")


@query("m01_touched_fct_orders", replaced("fct_orders", f"{ORDER_MONEY} payment_item_value_difference"))
def _(m):
    return second_day(m).model("fct_orders")


@query("m02_touched_fct_order_items", replaced("fct_order_items", f"{ITEM_MONEY} item_total_value"))
def _(m):
    return second_day(m).model("fct_order_items")


# ---------------------------------------------------------------- maintenance


@query(
    "u01_add_column_if_missing",
    "SELECT *, CAST(NULL AS VARCHAR) AS created_at, CAST(NULL AS VARCHAR) AS updated_at FROM raw_customers",
)
def _(m):
    once = maintenance.add_lifecycle_columns(m.raw("customers"))
    return maintenance.add_lifecycle_columns(once)


@query(
    "u02_backfill_timestamps",
    f"""SELECT customer_id, if(customer_city = 'NATION_3', '{maintenance.HISTORY_CUTOFF}', created_at) AS created_at,
    if(customer_city = 'NATION_3', '{maintenance.HISTORY_CUTOFF}', updated_at) AS updated_at FROM op_customers""",
)
def _(m):
    known = F.when(F.col("customer_city") != "NATION_3", F.col("created_at"))
    rows = maintenance.backfill_timestamps(m.operational("customers").withColumn("created_at", known))
    return rows.select("customer_id", "created_at", "updated_at")


@query("u03_historical_ids", "SELECT DISTINCT product_id FROM raw_order_items")
def _(m):
    return maintenance.historical_ids(m.raw("order_items"), "product_id")


def repaired_sql(name: str, key: str, history: str, times: str) -> str:
    return f"""SELECT {key}, if(repair, CAST(first_at AS VARCHAR), created_at) AS created_at,
    if(repair, CAST(last_at AS VARCHAR), updated_at) AS updated_at FROM (
        SELECT *, NOT ({history}) AND first_at IS NOT NULL AS repair FROM op_{name} LEFT JOIN (
            SELECT {key}, MIN(order_purchase_timestamp) AS first_at, MAX(order_purchase_timestamp) AS last_at
            FROM {times} GROUP BY ALL) USING ({key}))"""


@query(
    "u04_repair_timestamps_customers",
    repaired_sql("customers", "customer_id", "customer_state <> ' ASIA '", "op_orders"),
)
def _(m):
    history = m.raw("customers").filter("customer_state <> ' ASIA '")
    rows = maintenance.repair_customer_timestamps(m.operational("customers"), history, m.operational("orders"))
    return rows.select("customer_id", "created_at", "updated_at")


@query(
    "u05_repair_timestamps_products",
    repaired_sql("products", "product_id", "product_category_name IS NOT NULL", "op_order_items JOIN op_orders USING (order_id)"),
)
def _(m):
    history = m.raw("products").filter("product_category_name IS NOT NULL")
    rows = maintenance.repair_product_timestamps(
        m.operational("products"), history, m.operational("order_items"), m.operational("orders")
    )
    return rows.select("product_id", "created_at", "updated_at")


@query(
    "u05_repair_timestamps_sellers",
    repaired_sql("sellers", "seller_id", "seller_state <> 'ASIA'", "op_order_items JOIN op_orders USING (order_id)"),
)
def _(m):
    history = m.raw("sellers").filter("seller_state <> 'ASIA'")
    rows = maintenance.repair_seller_timestamps(
        m.operational("sellers"), history, m.operational("order_items"), m.operational("orders")
    )
    return rows.select("seller_id", "created_at", "updated_at")


VIEWS["waiting"] = """SELECT order_id, order_delivered_customer_date FROM op_orders
    WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
    AND order_id NOT IN (SELECT order_id FROM op_reviews)"""


@query("u06_orders_awaiting_review", "SELECT * FROM waiting")
def _(m):
    waiting = maintenance.orders_awaiting_review(m.operational("orders"), m.operational("reviews"))
    return waiting.orderBy("order_delivered_customer_date", "order_id")


@query(
    "u07_reviewable_as_of",
    """SELECT * FROM waiting WHERE order_delivered_customer_date <=
    (SELECT MAX(order_purchase_timestamp) FROM op_orders) + to_days(6)""",
)
def _(m):
    return maintenance.reviewable_as_of(m.operational("orders"), m.operational("reviews"))


# ---------------------------------------------------------------- streaming


class Torn(Exception):
    pass


def torn_ingest(m: Models, rows: DataFrame, raw: str, checkpoint: str, stream_id: str) -> None:
    """A run whose audit write fails after the rows are stored, so that its epoch comes again."""
    whole = feed.audit_append

    def fail(*_):
        raise Torn

    feed.audit_append = fail
    try:
        feed.stream_ingest(rows, ENTITY["orders"], raw, checkpoint, stream_id, CLOCK).awaitTermination()
    except Exception as error:
        if "Torn" not in str(error):
            raise
    finally:
        feed.audit_append = whole


def streamed_orders(m: Models) -> str:
    """Two waves land; the second holds rows older than the newest of the first, and its epoch comes twice."""
    place, mark, raw = scratch_path(m.spark, "landing"), scratch_path(m.spark, "mark"), workspace(m).raw
    orders, shipped = m.operational("orders"), F.col("order_status") == "shipped"
    tables.create_append_tables(m.spark, raw)
    for wave in (orders.filter(~shipped), orders.filter(shipped)):
        wave.write.mode("append").json(place)
        rows = feed.read_landing(m.spark, place, S.ORDERS)
        torn_ingest(m, rows, raw, mark, "orders")
        feed.stream_ingest(rows, ENTITY["orders"], raw, mark, "orders", CLOCK).awaitTermination()
    return raw


@query(
    "x01_stream_ingest",
    f"""SELECT *, if(order_status = 'shipped', 'orders-00000001', 'orders-00000000') AS _batch_id,
    {NOW_SQL} AS _ingested_at, {hash_sql('order_id')} AS _record_hash FROM op_orders""",
)
def _(m):
    return tables.source(m.spark, streamed_orders(m), "_ingest_orders")


@query(
    "x01_stream_audit",
    """SELECT if(order_status = 'shipped', 'orders-00000001', 'orders-00000000') AS batch_id, 'orders' AS entity,
    COUNT(*) AS records_fetched, COUNT(*) AS records_loaded, MAX(order_purchase_timestamp) AS watermark_after,
    'SUCCESS' AS status FROM op_orders GROUP BY ALL""",
)
def _(m):
    audit = tables.source(m.spark, streamed_orders(m), tables.AUDIT_TABLE)
    return audit.select("batch_id", "entity", "records_fetched", "records_loaded", "watermark_after", "status")


def landed_versions(m):
    """History and feed land as files and arrive in several micro-batches: the running latest row of each order."""
    place = scratch_path(m.spark, "landing")
    history = m.raw("orders").withColumns({"_priority": F.lit(0), "_version_at": F.lit(EPOCH).cast("timestamp")})
    newer = m.ingest("orders").withColumns({"_priority": F.lit(1), "_version_at": F.col("_ingested_at")})
    schema = S.plus(S.ORDERS, T.StructType().add("_priority", T.IntegerType()).add("_version_at", T.TimestampType()))
    newer.select(*schema.names).write.json(place)
    history.select(*schema.names).write.mode("append").json(place)
    feed.use_disk_state(m.spark)
    rows = feed.read_landing(m.spark, place, schema, files_per_batch=4)
    latest = feed.stream_latest_per_key(rows, ["order_id"], [F.col("_priority"), F.col("_version_at")])
    return latest.select(*S.ORDERS.names)


@query("x02_stream_latest_per_key", "SELECT * FROM latest_orders")
def _(m):
    target = scratch_path(m.spark, "stream")
    feed.write_updates(landed_versions(m), target, f"{target}-checkpoint").awaitTermination()
    return feed.read_updates(m.spark, target, ["order_id"], S.ORDERS)


@query("x02_stream_generations", "SELECT * FROM latest_orders")
def _(m):
    """The log is folded while the stream runs, after two epochs at the earliest."""
    target = scratch_path(m.spark, "stream")
    feed.write_generations(landed_versions(m), target, ["order_id"], f"{target}-checkpoint", every=2).awaitTermination()
    return feed.read_generations(m.spark, target, ["order_id"], S.ORDERS)


@query(
    "x03_stream_retry_dedup",
    f"""SELECT customer_id, customer_city, updated_at, {hash_sql('customer_id')} AS _record_hash FROM feed_customers""",
)
def _(m):
    """The feed lands in waves: half of it, a record arriving 30 days behind, then all as a retry 30 days later."""
    place, target = scratch_path(m.spark, "landing"), scratch_path(m.spark, "stream")
    batch = m.ingest("customers")
    early = F.pmod(F.xxhash64("customer_id"), F.lit(2)) == 0

    def at(df: DataFrame, name: str, days: int) -> DataFrame:
        return df.withColumns({"_batch_id": F.lit(name), "_ingested_at": F.col("_ingested_at") + F.make_dt_interval(F.lit(days))})

    schema = ENTITY["customers"].ingest_schema
    for wave in (batch.filter(early), at(batch.filter(~early), "late", -30), at(batch, "retry", 30)):
        wave.select(*schema.names).write.mode("append").json(place)
        rows = feed.stream_retry_dedup(feed.read_landing(m.spark, place, schema), "updated_at")
        kept = rows.select("customer_id", "customer_city", "updated_at", "_record_hash")
        writer = kept.writeStream.format("parquet").option("path", target)
        writer = writer.option("checkpointLocation", f"{target}-checkpoint").trigger(availableNow=True)
        writer.start().awaitTermination()
    return m.spark.read.schema(kept.schema).parquet(target)


@query(
    "x04_late_rows",
    f"""SELECT * FROM op_orders WHERE order_purchase_timestamp <= TIMESTAMP '{ORDER_MARK}'
    AND order_id NOT IN (SELECT order_id FROM feed_orders)""",
)
def _(m):
    return incremental.late_rows(
        m.operational("orders"), "order_purchase_timestamp", ORDER_MARK, m.ingest("orders"), ["order_id"]
    )
