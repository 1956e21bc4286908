"""Versioned tables: no gap, held readers, replaced buckets, swept files, joins without an exchange."""

import os
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from bazaarlake.sources import tables, versions
from bazaarlake.sources.versions import Layout, publish_buckets, rows_of, sweep, touched

LAYOUT = Layout("order_id", 8)


def numbered(spark, ids, value):
    return spark.createDataFrame([(None if i is None else str(i), value) for i in ids], "order_id string, v long")


def folders(spark, namespace):
    root = spark.catalog.getDatabase(namespace).locationUri.removeprefix("file:")
    return sorted(f for f in os.listdir(root) if "__v" in f)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("step", ["_new_version", "point_at", "sweep"])
def test_a_replacement_that_stops_at_any_step_leaves_the_old_or_the_new_table(spark, layers, monkeypatch, step):
    ns = layers.raw
    tables.overwrite_table(numbered(spark, range(3), 1), ns, "t")
    publish_buckets(numbered(spark, range(3), 1), ns, "b", LAYOUT)

    class Stopped(Exception):
        pass

    def stop(*_, **__):
        raise Stopped

    monkeypatch.setattr(versions, step, stop)
    with pytest.raises(Stopped):
        tables.overwrite_table(numbered(spark, range(5), 2), ns, "t")
    with pytest.raises(Stopped):
        publish_buckets(numbered(spark, range(5), 2), ns, "b", LAYOUT)
    monkeypatch.undo()
    for name in ("t", "b"):
        assert spark.table(f"{ns}.{name}").count() == (5 if step == "sweep" else 3)
    tables.overwrite_table(numbered(spark, range(7), 3), ns, "t")
    publish_buckets(numbered(spark, range(7), 3), ns, "b", LAYOUT)
    assert spark.table(f"{ns}.t").count() == spark.table(f"{ns}.b").count() == 7
    assert len(versions._tables(spark, ns, "t")) <= versions.KEPT
    assert len([f for f in folders(spark, ns) if f.startswith("b__")]) <= versions.KEPT


def test_a_failing_write_leaves_the_table(spark, layers):
    publish_buckets(numbered(spark, range(3), 1), layers.raw, "b", LAYOUT)
    with pytest.raises(Exception, match="broken"):
        bad = numbered(spark, range(3), 2).withColumn("v", F.raise_error(F.lit("broken")).cast("long"))
        publish_buckets(bad, layers.raw, "b", LAYOUT, [0, 1])
    assert rows(spark.table(f"{layers.raw}.b"), "v") == [(1,)] * 3


def test_a_reader_holds_its_version(spark, layers):
    ns = layers.raw
    tables.overwrite_table(numbered(spark, range(3), 1), ns, "t")
    held = spark.table(f"{ns}.t")
    tables.overwrite_table(numbered(spark, range(9), 2), ns, "t")
    assert held.count() == 3 and spark.table(f"{ns}.t").count() == 9


def test_a_plain_table_and_a_plain_view_become_pointers(spark, layers):
    ns = layers.raw
    numbered(spark, range(2), 0).write.saveAsTable(f"{ns}.old")
    assert versions.current_version(spark, ns, "old") is None
    tables.overwrite_table(numbered(spark, range(4), 1), ns, "old")
    assert spark.table(f"{ns}.old").count() == 4
    tables.materialize_view(spark, ns, "seen", f"SELECT * FROM {ns}.old")
    tables.overwrite_table(numbered(spark, range(5), 1), ns, "seen")
    assert spark.table(f"{ns}.seen").count() == 5


def test_appends_go_to_the_current_version(spark, layers):
    ns = layers.raw
    tables.append_table(numbered(spark, range(2), 0), ns, "log")
    tables.append_table(numbered(spark, range(3), 1), ns, "log")
    assert spark.table(f"{ns}.log").count() == 5
    tables.overwrite_table(spark.table(f"{ns}.log").where("v = 1"), ns, "log")
    tables.append_table(numbered(spark, range(1), 2), ns, "log")
    assert spark.table(f"{ns}.log").count() == 4


def test_names_that_begin_alike_are_different_tables(spark, layers):
    ns = layers.raw
    for name in ("t", "t__v000001_0000000a", "T2"):
        tables.overwrite_table(numbered(spark, range(2), 0), ns, name)
        tables.overwrite_table(numbered(spark, range(3), 0), ns, name)
        tables.overwrite_table(numbered(spark, range(4), 0), ns, name)
    assert [spark.table(f"{ns}.`{n}`").count() for n in ("t", "t__v000001_0000000a", "T2")] == [4, 4, 4]


def test_only_replaced_buckets_are_written_and_read(spark, layers):
    ns = layers.raw
    publish_buckets(numbered(spark, [*range(200), None], 1), ns, "b", LAYOUT)
    before = {re.sub(".*/", "", f) for f in spark.table(f"{ns}.b").inputFiles()}
    changed = numbered(spark, [5, 77, None], 2)
    some = touched(changed, LAYOUT)
    assert 0 < len(some) <= 3
    old = rows_of(spark, ns, "b", some)
    assert len(old.inputFiles()) == len(some)
    kept = old.where("order_id not in ('5', '77')")
    done = publish_buckets(kept.union(changed), ns, "b", LAYOUT, some)
    assert done.rows < 201
    after = {re.sub(".*/", "", f) for f in spark.table(f"{ns}.b").inputFiles()}
    assert len(after & before) == 8 - len(some) and len(after) == 8
    assert rows(spark.table(f"{ns}.b").groupBy("v").count()) == [(1, 198), (2, 3)]
    with pytest.raises(Exception, match="outside of the replaced buckets"):
        publish_buckets(numbered(spark, range(200), 3), ns, "b", LAYOUT, some)
    assert rows(spark.table(f"{ns}.b").groupBy("v").count()) == [(1, 198), (2, 3)]


def test_files_stay_while_a_kept_version_names_them(spark, layers):
    ns = layers.raw
    publish_buckets(numbered(spark, range(200), 0), ns, "b", LAYOUT)
    for n in range(8):
        mine = rows_of(spark, ns, "b", [n]).withColumn("v", F.lit(n + 1).cast("long"))
        publish_buckets(mine, ns, "b", LAYOUT, [n])
        assert spark.table(f"{ns}.b").count() == 200
    assert len(versions._tables(spark, ns, "b")) == versions.KEPT
    # a folder for each bucket's own version; the first one is gone since nothing names it
    assert len([f for f in folders(spark, ns) if f.startswith("b__")]) <= 9
    publish_buckets(numbered(spark, range(200), 0), ns, "b", LAYOUT)
    publish_buckets(numbered(spark, range(200), 0), ns, "b", LAYOUT)
    sweep(spark, ns, "b", keep=1)
    assert len([f for f in folders(spark, ns) if f.startswith("b__")]) == 1 and spark.table(f"{ns}.b").count() == 200


def test_bucketed_tables_join_and_group_without_an_exchange(spark, layers, monkeypatch):
    ns = layers.raw
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        publish_buckets(numbered(spark, range(200), 1), ns, "a", LAYOUT)
        publish_buckets(numbered(spark, range(100), 2), ns, "b", LAYOUT)
        publish_buckets(rows_of(spark, ns, "b", [3]), ns, "b", LAYOUT, [3])
        joined = spark.table(f"{ns}.a").join(spark.table(f"{ns}.b").withColumnRenamed("v", "w"), "order_id", "left")
        assert "Exchange" not in plan_of(joined) and joined.where("w = 2").count() == 100
        assert "Exchange" not in plan_of(spark.table(f"{ns}.a").groupBy("order_id").count())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_bucket_is_cut_into_slices_and_replaced_as_a_whole(spark, layers, monkeypatch):
    ns, sliced = layers.raw, Layout("order_id", 4, 3)
    monkeypatch.setattr(versions, "SLICE_BYTES", 100)
    assert versions.fitting(Layout("order_id", 4), 1200) == sliced and versions.fitting(LAYOUT, 800) == LAYOUT
    assert versions.fitting(LAYOUT, 2**63).tasks == versions.MOST_SLICES
    ids = [*range(300), None]
    for name in ("one", "two"):
        publish_buckets(numbered(spark, ids, 1), ns, name, sliced)
    version = spark.table(f"{ns}.{versions.current_version(spark, ns, 'one')}")
    assert len(version.inputFiles()) == 12 and versions.slices_of(spark, ns, "one", 4) == 3
    assert version.where(F.col(versions.KEY_BUCKET) != versions.bucket_of(F.col("order_id"), 4)).isEmpty()
    some = touched(numbered(spark, [7], 2), sliced)
    publish_buckets(rows_of(spark, ns, "one", some).withColumn("v", F.lit(2).cast("long")), ns, "one", sliced, some)
    before = {f for f in spark.table(f"{ns}.two").inputFiles()}
    assert len(spark.table(f"{ns}.one").inputFiles()) == len(before) == 12
    changed = spark.table(f"{ns}.one").where("v = 2")
    assert changed.count() == rows_of(spark, ns, "two", some).count() > 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = spark.table(f"{ns}.one").join(spark.table(f"{ns}.two").withColumnRenamed("v", "w"), "order_id")
        assert "Exchange" not in plan_of(both) and "Sort [" not in plan_of(both)
        assert both.rdd.getNumPartitions() == 12 and both.count() == 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
