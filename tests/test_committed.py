"""Committed batches, late rows, indexed pages and bitmaps."""

from datetime import datetime, timedelta, timezone

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from bazaarlake.operators import pages
from bazaarlake.plans import bitmaps, build, committed, marts
from bazaarlake.plans.touched import TouchedModels
from bazaarlake.schemas import ENTITIES, ENTITY, RAW_SCHEMAS
from bazaarlake.session import scratch_path
from bazaarlake.sources import tables
from shopfixture.models import Models

CLOCK = datetime(2002, 2, 1, tzinfo=timezone.utc)


@pytest.fixture
def shop(spark, layers):
    m = Models(spark, SMALL)
    for name, schema in RAW_SCHEMAS.items():
        tables.overwrite_table(m.operational(name).select(*schema.names).limit(0), layers.raw, name)
    tables.create_append_tables(spark, layers.raw)
    return m, {e.name: m.operational(e.name) for e in ENTITIES}


def one_order(m, n, days):
    """The n-th order, bought so many days from 2001-06-01."""
    first = m.operational("orders").orderBy("order_id").limit(1)
    at = F.expr(f"TIMESTAMP '2001-06-01 00:00:00' + make_dt_interval({days})")
    return first.withColumns({"order_id": F.lit(f"late{n}"), "order_purchase_timestamp": at})


def run(spark, layers, source, batch, overlap=timedelta(days=30)):
    return committed.run_committed_batch(spark, source, layers.raw, batch, lambda: CLOCK, overlap)


def batches_of(spark, layers, entity="orders"):
    return rows(committed.committed(spark, layers.raw, ENTITY[entity]), "order_id", "_batch_id")


def test_late_rows_are_ingested_once_and_reach_the_daily_sales(spark, layers, shop):
    m, source = shop
    source = {name: df.limit(0) for name, df in source.items()}
    source["orders"] = one_order(m, 1, 0)
    run(spark, layers, source, "a")
    source["orders"] = source["orders"].union(one_order(m, 2, -29)).union(one_order(m, 3, -31))
    run(spark, layers, source, "b")
    run(spark, layers, source, "c")
    assert batches_of(spark, layers) == [("late1", "a"), ("late2", "b")]  # the third lies behind the overlap
    run(spark, layers, source, "d", timedelta(days=40))
    assert batches_of(spark, layers)[-1] == ("late3", "d")
    models = TouchedModels(spark, layers, 4)
    assert models.build().batches == ["a", "b", "c", "d"]
    daily = marts.mart_daily_sales(models.model("fct_orders"))
    assert [r[0] for r in rows(daily, "total_orders")] == [1, 1, 1]
    # a changed row behind the watermark is a new version
    source["orders"] = one_order(m, 2, -29).withColumn("order_status", F.lit("changed"))
    run(spark, layers, source, "e")
    assert batches_of(spark, layers)[-2:] == [("late2", "e"), ("late3", "d")]


def test_rows_of_the_history_do_not_come_back(spark, layers, shop):
    m, source = shop
    source = {name: df.limit(0) for name, df in source.items()}
    source["orders"] = one_order(m, 1, 0).union(one_order(m, 2, -5))
    tables.overwrite_table(source["orders"].select(*RAW_SCHEMAS["orders"].names), layers.raw, "orders")
    committed.start_watermarks(spark, layers.raw, {"orders": datetime(2001, 6, 1, tzinfo=timezone.utc)}, CLOCK)
    run(spark, layers, source, "a")
    assert batches_of(spark, layers) == []


def test_a_batch_that_fails_at_the_fifth_entity_is_not_seen(spark, layers, shop):
    m, source = shop
    run(spark, layers, source, "whole")
    before = {e.name: committed.committed(spark, layers.raw, e).count() for e in ENTITIES}
    marks = committed.watermarks(spark, layers.raw)

    class Breaking(dict):
        def __getitem__(self, name):
            if name == "order_items":
                raise OSError("gone")
            return super().__getitem__(name)

    more = source | {"orders": source["orders"].union(one_order(m, 1, 200))}
    with pytest.raises(OSError, match="gone"):
        run(spark, layers, Breaking(more), "torn")
    assert {e.name: committed.committed(spark, layers.raw, e).count() for e in ENTITIES} == before
    assert committed.watermarks(spark, layers.raw) == marks
    assert tables.source(spark, layers.raw, "_ingest_orders").where("_batch_id = 'torn'").count() == 1
    staged = build.staged(spark, layers.raw, committed_only=True)["stg_orders"]
    assert staged.where("order_id = 'late1'").count() == 0
    run(spark, layers, more, "again")
    assert build.staged(spark, layers.raw, committed_only=True)["stg_orders"].where("order_id = 'late1'").count() == 1
    audit = tables.source(spark, layers.raw, tables.AUDIT_TABLE)
    assert rows(audit.where("batch_id = 'torn'"), "entity", "status")[-1] == ("sellers", "SUCCESS")
    assert audit.where("batch_id = 'torn' AND status = 'FAILED'").count() == 1


def test_pages_read_their_ranges_only(spark):
    df = spark.range(5000).select((F.col("id") % 50).alias("a"), F.col("id").alias("b"), F.lit("x").alias("c"))
    df = df.withColumn("a", F.when(F.col("a") > 0, F.col("a")))  # nulls come first
    expected = [tuple(r) for r in df.orderBy("a", "b").collect()]
    laid = pages.paged(df, ["a", "b"], scratch_path(spark, "pages"), range_rows=500)
    for offset in (0, 499, 500, 2345, 4990, 5000, 9999):
        assert [tuple(r) for r in laid.page(100, offset).collect()] == expected[offset : offset + 100], offset
    assert len(laid.page(100, 4000).inputFiles()) <= 2
    seen, key = [], None
    while page := (laid.page(900) if key is None else laid.after(key, 900)).collect():
        seen += [tuple(r) for r in page]
        key = seen[-1][:2]
    assert seen == expected
    assert pages.paged(df.limit(0), ["a", "b"], scratch_path(spark, "pages")).page().count() == 0
    for bad in ({"limit": 0}, {"limit": 1001}, {"offset": -1}):
        with pytest.raises(ValueError):
            laid.page(**bad)


def test_bitmaps_of_later_days_add_up(spark):
    m = Models(spark, SMALL)
    orders = tables.written(m.fct_orders, "orders")
    early = orders.where("purchased_at < '1998-01-01'")
    first = tables.written(bitmaps.numbered(early), "numbers")
    more = tables.written(bitmaps.numbered(orders, first), "numbers")
    numbers = first.union(more)
    assert numbers.count() == numbers.select("number").distinct().count()
    days = bitmaps.daily_bitmaps(early, first).union(bitmaps.daily_bitmaps(orders.where("purchased_at >= '1998-01-01'"), numbers))
    daily = bitmaps.distinct_counts(days, sales_date=F.col("sales_date"))
    expected = marts.mart_daily_sales(orders).select("sales_date", "total_orders", "unique_customers")
    assert rows(daily) == rows(expected)
    whole = rows(bitmaps.distinct_counts(days))
    assert whole == rows(marts.overall_metrics(orders).select("total_orders", "total_customers_with_orders"))
    assert rows(bitmaps.distinct_counts(days.limit(0))) == [(0, 0)]


def test_a_batch_extracts_and_shuffles_its_rows_once(spark, layers, shop):
    """Before, the rows were extracted and joined for themselves after the mark, behind it, and with the history."""
    m, source = shop
    entity, mark = ENTITY["order_items"], datetime(1995, 6, 1)
    history = source["order_items"].where("order_item_id = 1")
    stored = m.ingest("order_items").where("order_item_id = 2").limit(50).select(*entity.schema.names)
    found = committed.extract_with_gap(entity, source, history, stored, mark, timedelta(days=4000))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftAnti") == 1 and plan.count("Join Inner") == 1
    time = F.col("order_purchase_timestamp")
    every = source["order_items"].join(source["orders"].select("order_id", "order_purchase_timestamp"), "order_id")
    keys = ["order_id", "order_item_id"]
    # no stored version has the price of the source; of the history's records those after the mark come in
    expected = every.where((F.col("order_item_id") != 1) | (time > F.lit(mark).cast("timestamp")))
    assert rows(found, *keys) == rows(expected, *keys)
