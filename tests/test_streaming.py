from datetime import datetime, timedelta, timezone

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.plans.build import build_models
from bazaarlake.plans.checks import MONITORING, validate_batch
from bazaarlake.schemas import ENTITIES, ENTITY, ORDERS, RAW_SCHEMAS, landing_schema
from bazaarlake.sources import tables
from bazaarlake.streaming import feed
from shopfixture.models import Models

T1 = datetime(2020, 1, 1)
CLOCK = datetime(2020, 6, 1, tzinfo=timezone.utc)


def land(spark, path, *data):
    df = spark.createDataFrame([(k, "c", s, t, None, None, None, None) for k, s, t in data], ORDERS)
    df.coalesce(1).write.mode("append").json(path)


def ingest(spark, place, layers, checkpoint, stream_id="feed", entity="orders", schema=ORDERS):
    rows_in = feed.read_landing(spark, place, schema)
    feed.stream_ingest(rows_in, ENTITY[entity], layers.raw, checkpoint, stream_id, CLOCK).awaitTermination()
    return tables.source(spark, layers.raw, ENTITY[entity].ingest_table)


def audit(spark, layers, *columns):
    return rows(tables.source(spark, layers.raw, tables.AUDIT_TABLE), *columns)


def test_late_rows_arrive_and_nothing_arrives_twice(spark, layers, tmp_path):
    place, mark = (str(tmp_path / n) for n in ("in", "mark"))
    land(spark, place, ("1", "x", T1 + timedelta(days=9)))
    assert rows(ingest(spark, place, layers, mark), "order_id") == [("1",)]
    land(spark, place, ("2", "x", T1))
    got = ingest(spark, place, layers, mark)
    assert rows(got, "order_id", "_batch_id") == [("1", "feed-00000000"), ("2", "feed-00000001")]
    assert rows(ingest(spark, place, layers, mark), "order_id") == [("1",), ("2",)]
    assert audit(spark, layers, "batch_id", "records_loaded", "status") == [
        ("feed-00000000", 1, "SUCCESS"), ("feed-00000001", 1, "SUCCESS"),
    ]


@pytest.mark.parametrize("broken", ["audit_append", "append_batch"])
def test_an_epoch_that_failed_comes_again_and_counts_once(spark, layers, tmp_path, monkeypatch, broken):
    """Failing before the rows are stored, and between them and the audit row."""
    place, mark = str(tmp_path / "in"), str(tmp_path / "mark")
    land(spark, place, *[(str(i), "x", T1) for i in range(50)])

    def fail(*_):
        raise OSError("disk is gone")

    with monkeypatch.context() as patched:
        patched.setattr(feed, broken, fail)
        with pytest.raises(Exception, match="disk is gone"):
            ingest(spark, place, layers, mark)
    got = ingest(spark, place, layers, mark)
    assert got.count() == 50 and got.select("_batch_id").distinct().count() == 1
    good = tables.source(spark, layers.raw, tables.AUDIT_TABLE).where("status = 'SUCCESS'")
    assert rows(good, "batch_id", "records_loaded") == [("feed-00000000", 50)]


def test_a_failed_attempt_is_audited(spark, layers, tmp_path, monkeypatch):
    place = str(tmp_path / "in")
    land(spark, place, ("1", "x", T1))
    monkeypatch.setattr(feed, "append_batch", lambda *_: 1 / 0)
    with pytest.raises(Exception, match="division by zero"):
        ingest(spark, place, layers, str(tmp_path / "mark"))
    (batch_id, status, n, error), = audit(spark, layers, "batch_id", "status", "records_loaded", "error_message")
    assert batch_id.startswith("feed-00000000.") and (status, n) == ("FAILED", 0) and "division by zero" in error


def test_text_that_is_not_json_fails(spark, layers, tmp_path):
    place = tmp_path / "in"
    place.mkdir()
    (place / "a.json").write_text('{"order_id": "1"}\n{"order_id": "2", "cust')
    with pytest.raises(Exception, match="not a record"):
        ingest(spark, str(place), layers, str(tmp_path / "mark"))


def test_streamed_rows_reach_the_models(spark, layers, tmp_path):
    """All entities by stream, then the build and the gate on what it stored."""
    m = Models(spark, SMALL)
    tables.create_append_tables(spark, layers.raw)
    for name in RAW_SCHEMAS:
        tables.overwrite_table(m.raw(name), layers.raw, name)
    times = m.operational("orders").select("order_id", "order_purchase_timestamp")
    for entity in ENTITIES:
        landed = m.operational(entity.name)
        landed = landed.join(times, "order_id") if entity.parent else landed
        landed.select(*landing_schema(entity).names).write.json(str(tmp_path / entity.name))
        ingest(spark, str(tmp_path / entity.name), layers, str(tmp_path / f"{entity.name}-mark"), "day", entity.name, landing_schema(entity))
    models = build_models(spark, layers)
    assert len(validate_batch(models[MONITORING], "day-00000000")) == len(ENTITIES)
    assert models["fct_orders"].count() == m.raw("orders").count()


def test_latest_per_key_across_micro_batches(spark, tmp_path):
    place, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = T.StructType([*ORDERS.fields, T.StructField("v", T.IntegerType())])
    for k, s, v in (("1", "new", 2), ("2", "only", 1), ("1", "old", 1), ("1", "tie", 2)):
        df = spark.createDataFrame([(k, "c", s, T1, None, None, None, None, v)], schema)
        df.coalesce(1).write.mode("append").json(place)
    stream = feed.read_landing(spark, place, schema, files_per_batch=1)
    latest = feed.stream_latest_per_key(stream, ["order_id"], [F.col("v")])
    feed.write_updates(latest, target, str(tmp_path / "mark")).awaitTermination()
    got = feed.read_updates(spark, target, ["order_id"], latest.schema)
    assert rows(got, "order_id", "order_status", "v") == [("1", "tie", 2), ("2", "only", 1)]
    short = feed.compact_updates(spark, target, ["order_id"], latest.schema, str(tmp_path / "short"))
    assert rows(short) == rows(got) and spark.read.parquet(str(tmp_path / "short")).count() == 2


VERSIONED = T.StructType([*ORDERS.fields, T.StructField("v", T.IntegerType())])


def land_version(spark, place, n, keys=3):
    """Key n % keys in its version n; every third epoch brings an old version that loses."""
    v = n if n % 3 else -n
    df = spark.createDataFrame([(str(n % keys), "c", f"s{n}", T1, None, None, None, None, v)], VERSIONED)
    df.coalesce(1).write.mode("append").json(place)


def run_generations(spark, place, target, mark, every=3):
    stream = feed.read_landing(spark, place, VERSIONED, files_per_batch=1)
    latest = feed.stream_latest_per_key(stream, ["order_id"], [F.col("v")])
    feed.write_generations(latest, target, ["order_id"], mark, every).awaitTermination()
    return rows(feed.read_generations(spark, target, ["order_id"], latest.schema), "order_id", "order_status", "v")


def expected_versions(n, keys=3):
    best = {}
    for i in range(n):
        v = i if i % 3 else -i
        best[str(i % keys)] = max(best.get(str(i % keys), (-1000, "")), (v, f"s{i}"))
    return sorted((k, s, v) for k, (v, s) in best.items())


def test_generations_fold_the_log_while_the_stream_runs(spark, tmp_path):
    place, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    assert feed.read_generations(spark, target, ["order_id"], VERSIONED).count() == 0
    for n in range(11):
        land_version(spark, place, n, keys=4)
    assert run_generations(spark, place, target, mark) == expected_versions(11, keys=4)
    now = feed.current_generation(spark, target)
    assert now.number == 3 and now.through == 8
    epochs = [p.name for p in (tmp_path / "out" / "slot0").iterdir() if p.name.startswith("_epoch")]
    assert sorted(epochs) == ["_epoch=10", "_epoch=8", "_epoch=9"]  # the slot's first use is gone
    read = feed.read_generations(spark, target, ["order_id"], VERSIONED)
    assert all(f"slot{i}" not in name for name in read.inputFiles() for i in (1, 2))


def test_few_changes_do_not_write_the_whole_state_anew(spark, tmp_path):
    place, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    whole = spark.createDataFrame([(f"k{i}", "c", "s", T1, None, None, None, None, 1) for i in range(8)], VERSIONED)
    whole.coalesce(1).write.mode("append").json(place)
    for n in range(6):
        land_version(spark, place, n)
    run_generations(spark, place, target, mark, every=1)
    # the first epoch begins a generation of 8 rows; the 6th row after it is three quarters of them
    assert feed.current_generation(spark, target) == feed.Generation(2, 6)
    got = rows(feed.read_generations(spark, target, ["order_id"], VERSIONED), "order_id", "order_status", "v")
    assert got == sorted([*expected_versions(6), *[(f"k{i}", "s", 1) for i in range(8)]])


@pytest.mark.parametrize("broken", ["_point_at", "_read_generation"])
def test_an_epoch_whose_folding_failed_comes_again(spark, tmp_path, monkeypatch, broken):
    """Failing before the new generation is written, before and behind the step that names it."""
    place, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for n in range(2):
        land_version(spark, place, n)
    run_generations(spark, place, target, mark)
    land_version(spark, place, 2)
    whole = getattr(feed, broken)
    for first in (False, True):  # the step fails, then it is done and the epoch fails behind it

        def fail(*given, first=first):
            if first:
                whole(*given)
            raise OSError("disk is gone")

        with monkeypatch.context() as patched:
            patched.setattr(feed, broken, fail)
            with pytest.raises(Exception, match="disk is gone"):
                run_generations(spark, place, target, mark)
        latest = feed.read_generations(spark, target, ["order_id"], VERSIONED)
        assert rows(latest, "order_id", "order_status", "v") == expected_versions(3)
    land_version(spark, place, 3)
    assert run_generations(spark, place, target, mark) == expected_versions(4)
    assert feed.current_generation(spark, target) == feed.Generation(1, 2)


def test_retries_drop_and_late_records_stay(spark, tmp_path):
    place, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "customer_id string, updated_at string, _record_hash string, _ingested_at timestamp"
    hour, month = timedelta(hours=1), timedelta(days=32)
    waves = [
        [("1", "a", "h1", T1), ("1", "a", "h1", T1 + hour), ("1", "b", "h1", T1 + hour)],
        [("2", "a", "h2", T1 - month), ("3", None, "h3", T1 - month)],
        [("1", "b", "h1", T1 + month), ("3", None, "h3", T1 + month)],
    ]
    for wave in waves:
        spark.createDataFrame(wave, schema).write.mode("append").json(place)
        stream = feed.stream_retry_dedup(feed.read_landing(spark, place, T._parse_datatype_string(schema)), "updated_at")
        writer = stream.writeStream.format("parquet").option("path", target)
        writer.option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(schema).parquet(target)
    assert rows(got, "customer_id", "updated_at") == [("1", "a"), ("1", "b"), ("2", "a"), ("3", None)]


def test_children_stream_with_the_time_of_their_parent(spark, layers, tmp_path):
    place, mark = str(tmp_path / "in"), str(tmp_path / "mark")
    schema = landing_schema(ENTITY["payments"])
    spark.createDataFrame([("1", 1, "x", 1, None, T1)], schema).write.json(place)
    got = ingest(spark, place, layers, mark, "a", "payments", schema)
    assert rows(got, "order_id", "_batch_id") == [("1", "a-00000000")]
    assert audit(spark, layers, "watermark_after") == [(T1,)]
