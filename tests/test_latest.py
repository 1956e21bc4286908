from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException  # noqa: F401

from bazaarlake import schemas as S
from bazaarlake.operators.latest import conform, first_per_key, latest_per_key
from bazaarlake.plans import staging

SCHEMA = T.StructType().add("k", T.StringType()).add("v", T.StringType()).add("n", T.LongType())
DAY1, DAY2 = datetime(2020, 1, 1), datetime(2020, 1, 2)


def history(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def feed(spark, data):
    return spark.createDataFrame(data, T.StructType(SCHEMA.fields + [T.StructField("_ingested_at", T.TimestampType())]))


def latest(h, i, **options):
    return latest_per_key(h, i, ["k"], SCHEMA, F.col("_ingested_at"), **options)


def test_any_ingested_version_beats_history_and_the_newest_wins(spark):
    h = history(spark, [("a", "old", 1), ("b", "only", 2)])
    i = feed(spark, [("a", "first", 1, DAY1), ("a", "second", 0, DAY2), ("c", "new", 3, DAY1)])
    assert rows(latest(h, i)) == [("a", "second", 0), ("b", "only", 2), ("c", "new", 3)]


def test_ties_are_settled_by_the_remaining_columns(spark):
    h = history(spark, [("a", "x", 1), ("a", "y", 0), ("a", None, 9)])
    i = feed(spark, [])
    assert rows(latest(h, i)) == [("a", "y", 0)]


def test_result_does_not_depend_on_row_order_or_retries(spark):
    data = [(f"k{n % 7}", f"v{n % 3}", n % 5, DAY1 if n % 2 else DAY2) for n in range(200)]
    h = history(spark, [(f"k{n % 9}", "h", n) for n in range(50)])
    once = rows(latest(h, feed(spark, data)))
    assert rows(latest(h, feed(spark, list(reversed(data))).repartition(3))) == once
    assert rows(latest(h, feed(spark, data + data))) == once
    again = latest(latest(h, feed(spark, data)), feed(spark, []))
    assert rows(again) == once


def test_null_keys_form_one_group(spark):
    h = history(spark, [(None, "x", 1), (None, "y", 1)])
    assert rows(latest(h, feed(spark, []))) == [(None, "y", 1)]


def test_spellings_of_a_key_stay_apart_unless_normalized(spark):
    h = history(spark, [("x", "plain", 1), (" x", "spaced", 1)])
    assert len(rows(latest(h, feed(spark, [])))) == 2
    assert rows(latest(h, feed(spark, []), normalize_keys=True)) == [("x", "spaced", 1)]


def test_conform_keeps_leading_zeros_and_fills_missing_columns(spark):
    df = spark.createDataFrame([("007", 2.7)], "k string, n double")
    assert rows(df.select(*conform(df, SCHEMA))) == [("007", None, 3)]


def test_conform_raises_on_a_bad_timestamp(spark):
    schema = T.StructType().add("t", T.TimestampType())
    df = spark.createDataFrame([("nonsense",)], "t string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(*conform(df, schema)).collect()


def test_hot_key_is_reduced_before_the_exchange(spark):
    data = spark.range(0, 3000, 1, 4).selectExpr(
        "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k", "CAST(id AS STRING) AS v", "id AS n"
    )
    kept = first_per_key(data, ["k"], F.col("n").desc())
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.index("Exchange") < plan.index("Partial")
    assert kept.filter("k = 'hot'").first()["n"] == 2997
    assert kept.count() == 2001


def test_customer_versions_fall_back_to_arrival(spark):
    h = spark.createDataFrame([("1", "u", "01234", "c", " SP ")], S.CUSTOMERS)
    schema = S.ENTITY["customers"].ingest_schema
    version = [("1", "u", "01234", "late", "RJ", None, "not-a-date", "b", DAY2, "h"),
               ("1", "u", "01234", "early", "RJ", None, "2020-01-01 12:00:00", "b", DAY2, "h")]
    out = staging.stg_customers(h, spark.createDataFrame(version, schema))
    assert rows(out) == [("1", "u", "01234", "late", "rj")]


def test_normalized_keys_let_the_join_reuse_the_window_partitioning(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        h = spark.createDataFrame([("1", "c", "x", DAY1, None, None, None, DAY2)], S.ORDERS)
        i = spark.createDataFrame([], S.ENTITY["orders"].ingest_schema)
        totals = spark.range(9).selectExpr("CAST(id AS STRING) AS order_id", "id AS n")
        joined = staging.stg_orders(h, i, normalize_keys=True).join(totals, "order_id", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", [e.name for e in S.ENTITIES])
def test_normalizing_clean_keys_changes_nothing(spark, name):
    from conftest import SMALL
    from shopfixture.models import Models

    m = Models(spark, SMALL)
    make = getattr(staging, f"stg_{name}")
    plain = make(m.raw(name), m.ingest(name))
    normalized = make(m.raw(name), m.ingest(name), normalize_keys=True)
    assert plain.columns == normalized.columns
    assert rows(plain) == rows(normalized)
