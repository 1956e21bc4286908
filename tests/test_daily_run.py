import pytest
from conftest import SMALL, rows

from bazaarlake.plans import checks
from bazaarlake.plans.build import build_models
from bazaarlake.plans.daily_run import ChecksFailed, run_day
from bazaarlake.schemas import ENTITIES, RAW_SCHEMAS
from bazaarlake.sources import tables
from shopfixture.models import Models


def prepare(spark, layers):
    m = Models(spark, SMALL)
    for name in RAW_SCHEMAS:
        tables.overwrite_table(m.raw(name), layers.raw, name)
    return m


def test_a_day_from_ingest_to_gate(spark, layers):
    m = prepare(spark, layers)
    report = run_day(spark, {e.name: m.operational(e.name) for e in ENTITIES}, layers, "day-1")
    assert report.batch_id == "day-1"
    assert [line.split(":")[0] for line in report.entities] == [e.name for e in ENTITIES]
    assert [w["check_name"] for w in report.warnings] == ["paid_when_delivered"]
    daily, kpis = (spark.table(f"{layers.marts}.{n}") for n in ("mart_daily_sales", "mart_executive_kpis"))
    first = rows(kpis)
    assert daily.agg({"total_sales": "sum"}).first()[0] == kpis.first()["total_sales"]
    assert spark.table(f"{layers.staging}.stg_orders").count() == m.raw("orders").count()

    second = run_day(spark, {e.name: m.operational(e.name) for e in ENTITIES}, layers, "day-2")
    assert all(": 0 of 0" in line for line in second.entities)
    assert rows(spark.table(f"{layers.marts}.mart_executive_kpis")) == first


def test_a_failed_check_raises(spark, layers):
    m = prepare(spark, layers)
    source = {e.name: m.operational(e.name) for e in ENTITIES}
    tables.overwrite_table(m.raw("sellers").limit(1), layers.raw, "sellers")
    source["sellers"] = source["sellers"].limit(0)
    with pytest.raises(ChecksFailed, match="relationships:seller_id"):
        run_day(spark, source, layers, "day-1")


def test_output_columns(spark, layers):
    m = prepare(spark, layers)
    for entity in ENTITIES:
        tables.append_table(m.ingest(entity.name), layers.raw, entity.ingest_table)
    tables.append_table(m.audit(), layers.raw, tables.AUDIT_TABLE)
    models = build_models(spark, layers)
    assert models["mart_daily_sales"].columns[:3] == ["sales_date", "total_orders", "unique_customers"]
    assert models["fct_orders"].columns[-1] == "payment_item_value_difference"
    assert models["mart_customer_rfm"].columns[-2:] == ["rfm_score", "customer_segment"]
    assert set(checks.NOT_NULL) | {"mart_executive_kpis"} == set(models)
