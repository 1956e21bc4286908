"""The build of touched keys equals the full build and reads and writes touched buckets only."""

import re
from functools import partial

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from bazaarlake.plans import build, touched
from bazaarlake.plans.touched import FACTS, TouchedModels
from bazaarlake.schemas import ENTITIES, RAW_SCHEMAS
from bazaarlake.session import side_by_side
from bazaarlake.sources import tables, versions
from shopfixture.models import Models
from shopfixture.shop import FIRST_FEED

BUCKETS = 16


def feed(m, name, day):
    batch = F.when(F.col("_ingested_at") == FIRST_FEED, "day1").otherwise("day2")
    return m.ingest(name).withColumn("_batch_id", batch).where(F.col("_batch_id") == day)


@pytest.fixture
def shop(spark, layers):
    m = Models(spark, SMALL)
    for name in RAW_SCHEMAS:
        tables.overwrite_table(m.raw(name), layers.raw, name)
    for entity in ENTITIES:
        tables.append_table(feed(m, entity.name, "day1"), layers.raw, entity.ingest_table)
    return m, layers, TouchedModels(spark, layers, BUCKETS)


def same_as_full(spark, layers, models):
    full = build.staged(spark, layers.raw, normalize_keys=True)
    for name in ("customers", "orders", "order_items", "payments", "products", "reviews", "sellers"):
        columns = full[f"stg_{name}"].columns
        assert rows(models.staged(name), *columns) == rows(full[f"stg_{name}"], *columns), name
    parts = [full[f"stg_{n}"] for n in ("orders", "customers", "order_items", "payments")]
    enriched = touched.intermediate.int_orders_enriched(*parts)
    expected = {
        "int_orders_enriched": enriched,
        "fct_orders": touched.marts.fct_orders(enriched),
        "fct_order_items": touched.marts.fct_order_items(parts[2], enriched),
    }
    for name, df in expected.items():
        assert rows(models.model(name), *df.columns) == rows(df), name


def test_second_day_equals_the_full_build(spark, shop):
    m, layers, models = shop
    assert models.build().replaced["fct_orders"] is None
    same_as_full(spark, layers, models)
    for entity in ENTITIES:
        tables.append_table(feed(m, entity.name, "day2"), layers.raw, entity.ingest_table)
    done = models.build()
    assert done.batches == ["day2"] and done.replaced["latest_order_items"] == []
    same_as_full(spark, layers, models)
    assert models.build().replaced == {}


def odd_batch(spark, layers, name, values, batch, at="2003-01-01 00:00:00"):
    """Rows of one entity: given columns, null in all others."""
    entity = next(e for e in ENTITIES if e.name == name)
    columns = {f.name: f.dataType for f in entity.ingest_schema.fields}
    made = spark.range(1).select(F.explode(F.array(*[F.struct(*[F.lit(v.get(c)).cast(t).alias(c) for c, t in columns.items()]) for v in values])).alias("r")).select("r.*")
    made = made.withColumns({"_batch_id": F.lit(batch), "_ingested_at": F.lit(at).cast("timestamp")})
    tables.append_table(made, layers.raw, entity.ingest_table)


def files_of(spark, namespace, name):
    return {re.sub(r".*/", "", f) for f in spark.table(f"`{namespace}`.`{name}`").inputFiles()}


def test_few_keys_touch_few_buckets_and_no_other_file(spark, shop):
    m, layers, models = shop
    models.build()
    before = {n: files_of(spark, models._place(n), n) for n in FACTS}
    order, other = (r[0] for r in m.staged("orders").select("order_id").orderBy("order_id").limit(2).collect())
    odd_batch(spark, layers, "payments", [{"order_id": order, "payment_sequential": 9, "payment_value": 5}], "few")
    odd_batch(spark, layers, "order_items", [{"order_id": "new", "order_item_id": 1, "price": 2}, {"order_id": None, "order_item_id": 1}], "few")
    odd_batch(spark, layers, "orders", [{"order_id": f" {other} ", "customer_id": "nobody", "order_status": "late"}, {"order_id": None, "customer_id": "1"}], "few")
    done = models.build()
    some = done.replaced["fct_orders"]
    assert len(some) <= 4 and done.replaced["latest_customers"] == [] and len(done.replaced["latest_payments"]) == 1
    for name in FACTS:
        after = files_of(spark, models._place(name), name)
        kept = {f for f in before[name] if int(re.search(r"_(\d{5})\.c", f)[1]) not in some}
        assert kept <= after and len(after - kept) <= len(some), name
    read = versions.rows_of(spark, layers.staging, "latest_orders", some)
    assert len(read.inputFiles()) <= len(some)
    same_as_full(spark, layers, models)


def test_a_moved_customer_touches_all_own_orders_also_former_ones(spark, shop):
    m, layers, models = shop
    models.build()
    buyer = m.staged("orders").groupBy("customer_id").count().where("customer_id is not null").orderBy(F.desc("count")).first()[0]
    odd_batch(spark, layers, "customers", [{"customer_id": buyer, "customer_unique_id": "U", "customer_city": "far", "customer_state": "X"}], "moved")
    done = models.build()
    assert done.replaced["latest_orders"] == [] and done.replaced["fct_orders"]
    assert models.model("fct_orders").where("customer_city = 'far'").count() == m.staged("orders").where(F.col("customer_id") == buyer).count()
    same_as_full(spark, layers, models)


def test_a_build_that_stops_is_repeated_whole(spark, shop, monkeypatch):
    m, layers, models = shop
    models.build()
    for entity in ENTITIES:
        tables.append_table(feed(m, entity.name, "day2"), layers.raw, entity.ingest_table)

    def stop(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(touched.marts, "fct_order_items", stop)
    with pytest.raises(RuntimeError, match="lost"):
        models.build()
    monkeypatch.undo()
    assert models.build().batches == ["day2"]
    same_as_full(spark, layers, models)


def test_order_joins_of_the_first_build_have_no_exchange(spark, shop):
    m, layers, models = shop
    models.build()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items, payments = models.staged("order_items"), models.staged("payments")
        totals = touched.intermediate.order_item_totals(items).join(touched.intermediate.order_payment_totals(payments), "order_id", "left")
        facts = touched.marts.fct_order_items(items, models.model("int_orders_enriched"))
        sellers = touched.intermediate.seller_lines(items, models.model("int_orders_enriched"), models.staged("reviews"))
        for df in (totals, facts, sellers):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        whole = touched.intermediate.int_orders_enriched_by_order(models.staged("orders"), models.staged("customers"), items, payments)
        plan = whole._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(order_id") == 1  # the customers' columns on their way back
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_of_a_build_are_not_shuffled_again(spark, shop, monkeypatch):
    """States and facts lie in their buckets before they are written; the facts of the second day need no exchange at all."""
    m, layers, models = shop
    written = []

    def record(df, namespace, name, *args, placed=False, **more):
        written.append((name, placed, df._jdf.queryExecution().executedPlan().toString()))
        return versions.publish_buckets(df, namespace, name, *args, placed=placed, **more)

    monkeypatch.setattr(touched, "publish_buckets", record)
    models.build()
    assert all(placed for name, placed, _ in written if name in FACTS or name.startswith("latest_"))
    written.clear()
    tables.append_table(feed(m, "orders", "day2"), layers.raw, "_ingest_orders")
    models.build()
    plans = {name: plan for name, _, plan in written}
    assert all("Exchange hashpartitioning" not in plans[name] for name in ("fct_orders", "fct_order_items"))


def test_large_raw_tables_are_built_in_slices(spark, shop, monkeypatch):
    """However few the buckets are, a task takes a piece of bounded size; later builds and other readers keep the slices."""
    m, layers, _ = shop
    monkeypatch.setattr(versions, "SLICE_BYTES", 8 << 10)
    models = TouchedModels(spark, layers, 2)
    models.build()
    assert models.slices > 1
    monkeypatch.undo()
    parts = 2 * models.slices
    for entity in ENTITIES:
        tables.append_table(feed(m, entity.name, "day2"), layers.raw, entity.ingest_table)
    again = TouchedModels(spark, layers, 2)
    assert again.build().batches == ["day2"] and again.slices == models.slices
    for place, name in ((layers.staging, "latest_orders"), (layers.staging, "latest_order_items"), *((again._place(n), n) for n in FACTS)):
        assert len(spark.table(f"`{place}`.`{name}`").inputFiles()) == parts, name  # a file each: a task wrote one slice, sorted
    same_as_full(spark, layers, again)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = touched.marts.fct_order_items(again.staged("order_items"), again.model("int_orders_enriched"))
        plan = facts._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort [" not in plan and facts.rdd.getNumPartitions() == parts
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_works_side_by_side_have_local_properties_of_their_own(spark):
    """Shared ones lose the running query of one thread when that of another ends."""
    sc = spark.sparkContext

    def work(n):
        sc.setLocalProperty("mine", str(n))
        spark.range(1000).groupBy(F.col("id") % 7).count().collect()
        return sc.getLocalProperty("mine")

    assert side_by_side(spark, [partial(work, n) for n in range(12)], 4) == [str(n) for n in range(12)]

    def fail():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        side_by_side(spark, [fail, partial(work, 1)], 2)
