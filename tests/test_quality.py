from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from bazaarlake.operators import quality
from bazaarlake.operators.quality import Check, run_checks
from bazaarlake.plans import checks
from bazaarlake.plans.marts import mart_ingestion_monitoring
from bazaarlake.schemas import AUDIT, ENTITIES

T0 = datetime(2020, 1, 1)


@pytest.fixture
def models(spark):
    child = spark.createDataFrame([("1", "a"), ("2", "zz"), ("3", "zz"), (None, None), ("1", "b")], "id string, ref string")
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "ref string")
    return {"child": child, "parent": parent}


def test_each_check_returns_the_offending_rows(models):
    child, parent = models["child"], models["parent"]
    assert rows(quality.not_null(child, "id")) == [(None, None)]
    assert rows(quality.unique(child, "id")) == [("1", 2)]
    assert rows(quality.unique(child, "ref")) == [("zz", 2)]
    assert rows(quality.composite_unique(parent, ["ref"])) == [("b", 2)]
    assert rows(quality.relationships(child, "ref", parent, "ref")) == [("zz", 2)]
    assert rows(quality.accepted_values(child, "ref", ["a", "b"])) == [("2", "zz"), ("3", "zz")]
    assert rows(quality.expression_check(child, F.col("id") > "2")) == [("3", "zz")]
    assert rows(quality.null_counts(child, ["id", "ref"])) == [("id", 1), ("ref", 1)]


def test_suite_results_and_severity(models):
    suite = [
        Check("child", "not_null", ("id",)),
        Check("parent", "not_null", ("ref",)),
        Check("child", "unique", ("id",), severity="warn"),
        Check("child", "relationships", ("ref",), parent="parent", parent_field="ref"),
        Check("child", "expression", bad=lambda: F.col("id") == "9", name="nine"),
    ]
    assert rows(run_checks(models, suite)) == [
        ("child", "nine", "error", 0, "pass"),
        ("child", "not_null:id", "error", 1, "fail"),
        ("child", "relationships:ref", "error", 2, "fail"),
        ("child", "unique:id", "warn", 1, "warn"),
        ("parent", "not_null:ref", "error", 0, "pass"),
    ]


def test_null_checks_of_a_model_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).selectExpr("id", "id AS other").write.parquet(path)
    plan = quality.null_counts(spark.read.parquet(path), ["id", "other"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_declared_suite_size(spark):
    kinds = [c.kind for c in checks.suite()]
    assert [kinds.count(k) for k in ("not_null", "unique", "relationships", "accepted_values")] == [94, 14, 10, 2]
    assert kinds.count("composite_unique") + kinds.count("expression") == 5


def audit(spark, *entries):
    data = [("b1", e, T0, T0, f, n, None, None, s, None) for e, f, n, s in entries]
    return mart_ingestion_monitoring(spark.createDataFrame(data, AUDIT))


def sound(**changes):
    entries = {e.name: (e.name, 2, 2, "SUCCESS") for e in ENTITIES}
    entries.update(changes)
    return [e for e in entries.values() if e]


def test_gate_passes_a_sound_batch_in_ingest_order(spark):
    report = checks.validate_batch(audit(spark, *reversed(sound())), "b1")
    assert [line.split(":")[0] for line in report] == [e.name for e in ENTITIES]


@pytest.mark.parametrize(
    "entries, message",
    [
        (sound(orders=None), "orders: missing entity"),
        (sound(orders=("orders", 0, 0, "FAILED")), "orders: not successful"),
        (sound(orders=("orders", -1, -1, "SUCCESS")), "orders: negative count"),
        (sound(orders=("orders", 1, 2, "SUCCESS")), "orders: more loaded than fetched"),
    ],
)
def test_gate_names_the_problem(spark, entries, message):
    with pytest.raises(checks.BatchInvalid, match=message):
        checks.validate_batch(audit(spark, *entries), "b1")


def test_gate_rejects_an_unknown_batch(spark):
    with pytest.raises(checks.BatchInvalid, match="no monitoring records"):
        checks.validate_batch(audit(spark, *sound()), "b2")


def test_gate_merges_repeated_log_rows(spark):
    entries = sound() + [("orders", 0, 0, "FAILED"), ("orders", 2, 2, "SUCCESS")]
    with pytest.raises(checks.BatchInvalid, match="orders: not successful"):
        checks.validate_batch(audit(spark, *entries), "b1")
    assert len(checks.validate_batch(audit(spark, *sound(), *sound()), "b1")) == 7


def test_an_empty_suite_has_no_results(spark):
    assert run_checks({}, []).count() == 0
