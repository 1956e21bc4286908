import json
from datetime import datetime, timezone

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake import schemas as S
from bazaarlake.operators import incremental
from bazaarlake.plans import ingest, staging
from bazaarlake.schemas import ENTITIES, ENTITY
from bazaarlake.sources import csv_files, ingest_log, landing, tables
from shopfixture import runs
from shopfixture.models import Models

T1, T2, T3 = datetime(2020, 1, 1), datetime(2020, 1, 2), datetime(2020, 1, 3)
CLOCK = datetime(2020, 6, 1, tzinfo=timezone.utc)


def seller(key, updated, city="c"):
    return (key, "01234", city, "s", None, None if updated is None else f"{updated:%Y-%m-%d %H:%M:%S}")


def sellers(spark, *data):
    return spark.createDataFrame(list(data), ENTITY["sellers"].schema)


def orders(spark, *data):
    return spark.createDataFrame([(k, "c", "delivered", t, None, None, None, None) for k, t in data], S.ORDERS)


def load(spark, layers, source, entity="sellers", batch="b1"):
    store = ingest_log.WatermarkStore(spark, layers.raw)
    return ingest.ingest_entity(ENTITY[entity], source, layers.raw, store, batch, CLOCK), store


def test_watermark_is_strict_and_typed(spark):
    df = sellers(spark, seller("1", T1), seller("2", T2), seller("3", None))
    assert rows(incremental.extract_after(df, "updated_at", T1), "seller_id") == [("2",)]
    assert incremental.extract_after(df, "updated_at", "2020-1-1").count() == 1
    assert incremental.extract_after(df, "updated_at", None).count() == 3


def test_typed_watermark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    orders(spark, ("1", T1), ("2", T2)).write.parquet(path)
    new = incremental.extract_after(spark.read.parquet(path), "order_purchase_timestamp", T1).select("order_id")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(order_purchase_timestamp" in plan
    assert "ReadSchema: struct<order_id:string,order_purchase_timestamp:timestamp>" in plan


def test_children_follow_their_parent_and_orphans_drop(spark):
    child = spark.createDataFrame([("1", 1), ("2", 1), ("9", 1)], "order_id string, n int")
    parent = orders(spark, ("1", T1), ("2", T2))
    time = "order_purchase_timestamp"
    assert rows(incremental.extract_children_after(child, parent, "order_id", time, T1)) == [("2", 1, T2)]
    assert incremental.extract_children_after(child, parent, "order_id", time, None).count() == 2


def test_pages_cover_everything_once(spark):
    df = orders(spark, *[(str(n), T1) for n in range(25)])
    seen = []
    for offset in range(0, 30, 10):
        seen += [r["order_id"] for r in incremental.page(df, ["order_purchase_timestamp", "order_id"], 10, offset).collect()]
    assert sorted(seen, key=int) == [str(n) for n in range(25)]


@pytest.mark.parametrize("limit", [0, -1, 1001])
def test_page_limit_bounds(spark, limit):
    with pytest.raises(ValueError, match="between 1 and 1000"):
        incremental.page(spark.range(3), ["id"], limit)


def test_late_rows_report_what_the_watermark_loses(spark):
    source, ingested = orders(spark, ("1", T1), ("2", T2), ("3", T3)), orders(spark, ("1", T1))
    lost = incremental.late_rows(source, "order_purchase_timestamp", T2, ingested, ["order_id"])
    assert rows(lost, "order_id") == [("2",)]


def test_ingest_appends_and_moves_the_watermark(spark, layers):
    first, store = load(spark, layers, {"sellers": sellers(spark, seller("1", T1), seller("2", T2))})
    assert (first.loaded, first.watermark) == (2, T2)
    second, store = load(spark, layers, {"sellers": sellers(spark, seller("1", T3, "new"), seller("2", T2))}, batch="b2")
    assert (second.loaded, second.watermark, store.get("sellers")) == (1, T3, T3)
    table = spark.table(f"{layers.raw}._ingest_sellers")
    assert rows(table, "seller_id", "_batch_id") == [("1", "b1"), ("1", "b2"), ("2", "b1")]


def test_empty_batch_keeps_the_watermark(spark, layers):
    load(spark, layers, {"sellers": sellers(spark, seller("1", T2))})
    empty, store = load(spark, layers, {"sellers": sellers(spark, seller("1", T2))}, batch="b2")
    assert (empty.fetched, empty.loaded, empty.watermark, store.get("sellers")) == (0, 0, T2, T2)


def test_batch_without_any_time_keeps_the_watermark(spark, layers):
    result, store = load(spark, layers, {"sellers": sellers(spark, seller("1", None))})
    assert (result.loaded, result.watermark, store.get("sellers")) == (1, None, None)


def test_undeclared_columns_are_dropped_and_missing_ones_are_null(spark, layers):
    source = sellers(spark, seller("1", T1)).drop("seller_city").withColumn("junk", F.lit(1))
    load(spark, layers, {"sellers": source})
    table = spark.table(f"{layers.raw}._ingest_sellers")
    assert table.columns == ENTITY["sellers"].ingest_schema.names
    assert rows(table, "seller_id", "seller_city") == [("1", None)]


def test_retry_leaves_staging_unchanged(spark, layers):
    source = {"sellers": sellers(spark, seller("1", T1), seller("2", T2, "b"))}
    history = spark.createDataFrame([("1", "0", "old", "s")], S.SELLERS)
    load(spark, layers, source)
    table = f"{layers.raw}._ingest_sellers"
    before = rows(staging.stg_sellers(history, spark.table(table)))
    ingest.append_entity(source["sellers"], ENTITY["sellers"], layers.raw, "b1", CLOCK)
    assert spark.table(table).count() == 4
    assert rows(staging.stg_sellers(history, spark.table(table))) == before


def test_failure_is_audited_raised_and_stops_the_batch(spark, layers):
    m = Models(spark, SMALL)
    source = {e.name: m.operational(e.name) for e in ENTITIES}
    source["sellers"] = source["sellers"].withColumn("updated_at", F.raise_error(F.lit("x" * 3000)).cast("string"))
    with pytest.raises(Exception, match="xxx"):
        ingest.run_batch(spark, source, layers.raw, "bad")
    audit = spark.table(f"{layers.raw}.{tables.AUDIT_TABLE}")
    assert rows(audit, "entity", "status") == [("customers", "SUCCESS"), ("products", "SUCCESS"), ("sellers", "FAILED")]
    failed = audit.filter("status = 'FAILED'").first()
    assert (failed["records_loaded"], failed["watermark_after"], "x" * 3000 in failed["error_message"]) == (0, None, True)
    assert not tables.table_exists(spark, layers.raw, "_ingest_orders")


def test_generic_append_makes_an_id_also_for_no_rows(spark, layers):
    df = spark.createDataFrame([("1", 2)], "k string, n int")
    done = ingest_log.append_batch(df, layers.raw, "things", ["k", "n"])
    none = ingest_log.append_batch(df.limit(0), layers.raw, "things", ["k", "n"])
    assert (done.rows, done.last, none.rows) == (1, None, 0) and done.batch_id != none.batch_id
    assert rows(spark.table(f"{layers.raw}.things"), "k", "_batch_id") == [("1", done.batch_id)]


def test_landed_children_carry_the_parent_time(spark):
    rows_in = spark.createDataFrame([("1", 1, T1), ("2", 1, T2)], "order_id string, n int, order_purchase_timestamp timestamp")
    got = ingest.extract(ENTITY["payments"], {"payments": rows_in}, T1)
    assert rows(got, "order_id") == [("2",)]


def test_batch_ids(spark):
    import re

    made = {ingest_log.new_batch_id(CLOCK) for _ in range(20)}
    assert len(made) == 20 and all(re.fullmatch(r"20200601T000000_[0-9a-f]{8}", x) for x in made)


def test_watermark_store(spark, layers):
    store = ingest_log.WatermarkStore(spark, layers.raw)
    assert store.get("orders") is None and store.load().count() == 0
    store.save("orders", T2, datetime(2021, 1, 2))
    store.save("orders", T1, datetime(2021, 1, 1))  # a clock that was set back
    store.save("reviews", T3)
    store.save("reviews", None)
    assert rows(store.load()) == [("orders", T1), ("reviews", T3)]
    store.compact()
    assert rows(store.load()) == [("orders", T1), ("reviews", T3)] and store._log().count() == 2
    store.save("orders", T3)
    assert store.as_dict() == {"orders": T3, "reviews": T3}


def test_an_audit_that_fails_hides_nothing(spark, layers, monkeypatch):
    def broken(*_):
        raise OSError("audit is gone")

    def fail():
        raise ConnectionError("source is down")

    with monkeypatch.context() as patched:
        patched.setattr(ingest, "audit_append", broken)
        with pytest.raises(ConnectionError, match="source is down") as error:
            ingest.run_with_audit(spark, layers.raw, "b", "orders", None, fail)
        assert "audit is gone" in error.value.__notes__[0]

    whole, calls = ingest_log.audit_append, []

    def once(*args):
        calls.append(args)
        if len(calls) == 1:
            raise OSError("no room for success")
        whole(*args)

    monkeypatch.setattr(ingest, "audit_append", once)
    with pytest.raises(OSError, match="no room"):
        ingest.run_with_audit(spark, layers.raw, "b", "orders", None, lambda: ingest.Loaded(1, 1, None))
    audit = spark.table(f"{layers.raw}.{tables.AUDIT_TABLE}")
    assert rows(audit, "status", "error_message") == [("FAILED", "no room for success")]


def test_initial_watermarks(spark):
    existing = spark.createDataFrame([("orders", T1)], "entity string, watermark timestamp")
    reviews = spark.createDataFrame([], S.REVIEWS)
    got = dict(rows(ingest.init_watermarks(existing, orders(spark, ("1", T2)), reviews, "2018-10-17 23:59:59")))
    cutoff = datetime(2018, 10, 17, 23, 59, 59)
    assert got == {"customers": cutoff, "products": cutoff, "sellers": cutoff, "orders": T1, "order_items": T2, "payments": T2}


def test_csv_with_quotes_newlines_and_leading_zeros(spark, layers, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text('seller_id,seller_zip_code_prefix,seller_city,seller_state\n1,00123,"two\nlines ""q"", x",SP\n2,9,,\n')
    assert csv_files.csv_full_load(spark, csv_files.CsvSource(str(path), "sellers"), layers.raw) == 2
    path.write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\n3,1,c,s\n")
    assert csv_files.csv_full_load(spark, csv_files.CsvSource(str(path), "sellers"), layers.raw) == 1
    assert rows(spark.table(f"{layers.raw}.sellers")) == [("3", "1", "c", "s")]


def test_csv_first_load_content(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text('seller_id,seller_zip_code_prefix,seller_city,seller_state\n1,00123,"two\nlines ""q"", x",SP\n2,9,,\n')
    assert rows(csv_files.read_csv(spark, str(path), S.SELLERS)) == [
        ("1", "00123", 'two\nlines "q", x', "SP"), ("2", "9", None, None),
    ]


def test_csv_bad_number_becomes_null_and_missing_file_raises(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("order_id,payment_sequential,payment_type,payment_installments,payment_value\n1,1,x,bad,1.5\n")
    got = csv_files.read_csv(spark, str(path), S.PAYMENTS).first()
    assert (got["payment_installments"], float(got["payment_value"])) == (None, 1.5)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv_files.read_csv(spark, str(tmp_path / "absent.csv"), S.PAYMENTS)


def test_catalogues():
    items = csv_files.csv_catalogue("/data", prefix="shop_", suffix="_dataset.csv")
    assert [i.table for i in items] == list(S.RAW_SCHEMAS)
    assert items[4].path == "/data/shop_order_payments_dataset.csv"
    assert len(csv_files.operational_catalogue("/data")) == 7


KEY = T.StructType([T.StructField("k", T.StringType())])


def write_pages(folder, *pages):
    folder.mkdir(exist_ok=True)
    name = len(list(folder.iterdir()))
    (folder / f"{name}.json").write_text("\n".join(json.dumps(p) for p in pages))


def page(begin, n, **more):
    return {**more, "data": [{"k": str(i)} for i in range(begin, begin + n)]}


def landed_keys(spark, folder):
    return sorted(int(r["k"]) for r in landing.read_landing_pages(spark, str(folder), KEY).collect())


def test_landing_pages_of_two_fetch_runs(spark, tmp_path):
    write_pages(tmp_path / "p", page(0, 80, count=80, offset=0))
    write_pages(tmp_path / "p", page(80, 1000, count=1000, offset=0), page(1080, 1000, count=1000, offset=1000), page(2080, 500, count=500, offset=2000))
    assert landed_keys(spark, tmp_path / "p") == list(range(2580))


def test_landing_pages_of_any_size(spark, tmp_path):
    write_pages(tmp_path / "p", *[page(100 * i, 100, count=100, offset=100 * i) for i in range(20)])
    assert landed_keys(spark, tmp_path / "p") == list(range(2000))


def test_landing_pages_without_offset_or_count(spark, tmp_path):
    write_pages(tmp_path / "p", page(0, 30, count=30), {"count": 0, "data": []}, page(30, 5))
    assert landed_keys(spark, tmp_path / "p") == list(range(35))


@pytest.mark.parametrize("bad", ['{"count": 1, "data": [{"k": "1"', '{"count": 2, "data": [{"k": "1"}]}', '{"count": 0}', '{"detail": "gone"}'])
def test_a_torn_or_wrong_page_is_an_error(spark, tmp_path, bad):
    write_pages(tmp_path / "p", page(0, 3, count=3), page(3, 3, count=3))
    (tmp_path / "p" / "torn.json").write_text(bad)
    with pytest.raises(Exception, match="landed page with count"):
        landed_keys(spark, tmp_path / "p")


def test_unknown_source_is_an_error(spark, layers):
    with pytest.raises(KeyError, match="unknown source"):
        tables.source(spark, layers.raw, "nope")


def test_route_namespace():
    assert tables.route_namespace(" analytics ", "target") == "analytics"
    assert tables.route_namespace(None, "target") == "target"


def test_a_failing_write_leaves_the_table(spark, layers):
    tables.overwrite_table(spark.range(3), layers.raw, "t")
    with pytest.raises(Exception, match="broken"):
        tables.overwrite_table(spark.range(3).select(F.raise_error(F.lit("broken")).alias("id")), layers.raw, "t")
    assert spark.table(f"{layers.raw}.t").count() == 3
    tables.overwrite_table(spark.table(f"{layers.raw}.t").where("id > 0"), layers.raw, "t")
    assert rows(spark.table(f"{layers.raw}.t")) == [(1,), (2,)]


def test_a_profile_groups_each_column_by_itself(spark):
    """Zero and its negative are one value; wide rows are not copied for each distinct count."""
    made = [("a", 0.0, 1), ("a", -0.0, None), (" bc", float("nan"), 1), (None, float("nan"), 2)]
    table = spark.createDataFrame(made, "text string, number double, whole long")
    found = runs.profile(table, "made")
    assert rows(found) == [("made", "number", 4, 2, 0), ("made", "text", 3, 2, 5), ("made", "whole", 3, 2, 0)]
    assert rows(runs.profile(table.limit(0), "made"), "known", "different", "characters") == [(0, 0, 0)] * 3
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_an_export_is_cut_into_files_of_some_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "EXPORT_ROWS", 20)
    m = Models(spark, SMALL)
    runs.export_csv(m, ["products"], str(tmp_path))
    n = m.raw("products").count()
    assert len(list(tmp_path.glob("products.csv/part-*.csv"))) >= n // 20 > 1
    item = next(i for i in csv_files.csv_catalogue(str(tmp_path)) if i.table == "products")
    read = csv_files.read_csv(spark, item.path, item.schema)
    assert rows(read, "product_id") == rows(m.raw("products"), "product_id")
