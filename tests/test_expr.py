from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.functions import expr


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("out")).first()["out"]


def test_clean_text_strips_all_white_space(spark):
    for space in expr.WHITE_SPACE:
        assert one(spark, expr.clean_text(F.lit(f"{space}a b{space}"))) == "a b"
    assert one(spark, expr.clean_text(F.lit("\n \ta　"))) == "a"
    assert one(spark, expr.clean_text(F.lit(" \n "))) == ""
    assert one(spark, expr.clean_text(F.lit(None).cast("string"))) is None


def test_blank_to_default(spark):
    for value, want in ((" \t", "unknown"), (None, "unknown"), (" toys ", "toys")):
        assert one(spark, expr.blank_to(F.lit(value).cast("string"), "unknown")) == want


@pytest.mark.parametrize(
    "value, kind, want",
    [("12", T.StringType(), 12), ("2.7", T.StringType(), None), ("x", T.StringType(), None), (2.7, T.DoubleType(), 3),
     (2.5, T.DoubleType(), 3), (-2.5, T.DoubleType(), -3), (1e30, T.DoubleType(), None)],
)
def test_safe_cast_to_integer(spark, value, kind, want):
    assert one(spark, expr.safe_cast(F.lit(value).cast(kind), kind, T.LongType())) == want


def test_safe_cast_to_money_keeps_nine_decimals(spark):
    value = expr.safe_cast(F.lit("1.123456789"), T.StringType(), expr.MONEY)
    assert one(spark, value) == Decimal("1.123456789")
    assert one(spark, expr.safe_cast(F.lit("n/a"), T.StringType(), expr.MONEY)) is None


def test_money_arithmetic_keeps_scale(spark):
    df = spark.range(1).select(F.lit("1.000000001").cast(expr.MONEY).alias("a"))
    assert df.select(F.col("a") + F.col("a")).schema[0].dataType.scale == 9
    assert df.agg(F.sum("a")).schema[0].dataType.scale == 9


def test_exact_avg_is_one_division_of_the_exact_sum(spark):
    df = spark.createDataFrame([(Decimal("0.10"),), (Decimal("0.20"),), (None,)], "x decimal(28,9)")
    assert df.agg(expr.exact_avg(F.col("x"))).first()[0] == 0.15
    assert df.filter("x > 9").agg(expr.exact_avg(F.col("x"))).first()[0] is None


def test_safe_ratio(spark):
    assert one(spark, expr.safe_ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, expr.safe_ratio(F.lit(1), F.lit(4))) == 0.25
    assert one(spark, expr.safe_ratio(F.lit(None).cast("long"), F.lit(0))) is None


def test_days_ignore_the_time_of_day(spark):
    def ts(text):
        return F.lit(text).cast("timestamp")

    assert one(spark, expr.days_between(ts("2020-01-02 00:00:01"), ts("2020-01-01 23:59:59"))) == 1
    assert one(spark, expr.days_between(ts("2020-01-01 23:59:59"), ts("2020-01-01 00:00:00"))) == 0


def test_seconds_are_elapsed_not_boundaries(spark):
    def ts(text):
        return F.lit(text).cast("timestamp")

    assert one(spark, expr.seconds_between(ts("2020-01-01 00:00:02.1"), ts("2020-01-01 00:00:00.9"))) == 1


def test_record_hash_names_null(spark):
    import hashlib

    want = hashlib.sha256(b"7|None|x").hexdigest()
    got = one(spark, expr.record_hash(F.lit(7), F.lit(None).cast("string"), F.lit("x")))
    assert got == want
