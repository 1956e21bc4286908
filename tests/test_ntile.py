import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from bazaarlake.operators.ntile import Ordering, bucket_ends, with_ntiles

ORDERINGS = {"a_tile": Ordering("a", descending=True), "b_tile": Ordering("b")}


def plain(df, buckets):
    a = Window.orderBy(F.col("a").desc_nulls_last(), F.col("id").asc_nulls_first())
    b = Window.orderBy(F.col("b").asc_nulls_first(), F.col("id").asc_nulls_first())
    return df.withColumns({"a_tile": F.ntile(buckets).over(a), "b_tile": F.ntile(buckets).over(b)})


def same(df, buckets, **options):
    key = ["id", "a_tile", "b_tile"]
    got = {tuple(r) for r in with_ntiles(df, buckets, ORDERINGS, "id", **options).select(*key).collect()}
    want = {tuple(r) for r in plain(df, buckets).select(*key).collect()}
    assert got == want


def frame(spark, pairs):
    data = [(f"c{i:05d}" if i else None, a, b) for i, (a, b) in enumerate(pairs)]
    return spark.createDataFrame(data, "id string, a int, b decimal(38,9)")


def test_bucket_ends():
    assert bucket_ends(12, 5) == [3, 6, 8, 10]
    assert bucket_ends(3, 5) == [1, 2, 3, 3]
    assert bucket_ends(0, 5) == [0, 0, 0, 0]


@pytest.mark.parametrize("count", [0, 1, 3, 4, 5, 7, 23])
def test_small_counts(spark, count):
    same(frame(spark, [(i % 2, Decimal(i % 3)) for i in range(count)]), 5)


def test_narrowing_with_heavy_ties(spark):
    """96 in 100 rows share one value, as order counts do; bands are far smaller than the tie."""
    rng = random.Random(5)
    pairs = [(rng.randint(0, 900), Decimal(1 if rng.random() < 0.96 else rng.randint(2, 6))) for _ in range(6000)]
    df = frame(spark, pairs).repartition(4).cache()
    same(df, 5, max_band=40, sample_rows=150)
    df.unpersist()


def test_all_rows_equal(spark):
    same(frame(spark, [(1, Decimal(1))] * 500), 5, max_band=20, sample_rows=30)


def test_no_sort_of_all_rows(spark):
    df = frame(spark, [(i, Decimal(i)) for i in range(50)])
    plan = with_ntiles(df, 5, ORDERINGS, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan and "Sort" not in plan


def test_duplicate_ties_are_reported(spark):
    df = spark.createDataFrame([("same", 1, Decimal(1))] * 300, "id string, a int, b decimal(38,9)")
    with pytest.raises(RuntimeError, match="unique"):
        with_ntiles(df, 5, ORDERINGS, "id", max_band=10, sample_rows=20)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    pairs=st.lists(
        st.tuples(st.none() | st.integers(-3, 3), st.none() | st.decimals(-2, 2, places=1)), min_size=1, max_size=60
    ),
    buckets=st.integers(2, 7),
)
def test_equals_ntile_over_the_same_total_order(spark, pairs, buckets):
    same(frame(spark, pairs), buckets, max_band=8, sample_rows=16)
