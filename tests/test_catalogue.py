"""Every registered query against its SQL, and the plans of the main ones."""

import re

import pytest
from conftest import SMALL

import __spark_entry__ as entry
from shopfixture import catalogue
from tools.compare import compare, connect

QUERIES = catalogue.QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = connect(SMALL)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(catalogue.ORACLES) == set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_equals_sql(spark, duck, name):
    good, note = compare(spark, duck, name, SMALL)
    assert good, note


def plan(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


MODELS = [n for n in QUERIES if n[0] in "tnmdu" and n[1:3].isdigit()]


@pytest.mark.parametrize("name", MODELS)
def test_no_cross_join_and_no_single_partition_window(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for window in re.findall(r"Window \[.*", text):
        assert not window.rstrip().endswith("[]")


def test_scans_read_only_what_they_need(spark):
    text = plan(spark, "d04_orders_by_status")
    assert "l_extendedprice" not in text and "o_totalprice" not in text
    text = plan(spark, "q08_delivered_without_payment")
    assert "l_orderkey" not in text


def test_versions_are_reduced_before_the_exchange(spark):
    text = plan(spark, "t03_stg_order_items")
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text and "Final" in text




@pytest.mark.parametrize("name", ["m10_daily_sales", "m12_overall_metrics", "m13_mart_executive_kpis"])
def test_two_distinct_counts_do_not_multiply_the_measures(spark, name):
    assert "Expand" not in plan(spark, name)


def test_rfm_metrics_compute_their_base_once(spark):
    text = plan(spark, "m07_rfm_metrics")
    assert "rfm-base" in text and text.count("Scan parquet") == text.count("rfm-base")
