import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from bazaarlake.__main__ import main
from bazaarlake.schemas import ENTITIES, RAW_SCHEMAS, landing_schema
from bazaarlake.session import scratch_path
from shopfixture.models import Models
from shopfixture.runs import export_csv


def names(layers):
    return ["--raw", layers.raw, "--staging", layers.staging, "--intermediate", layers.intermediate, "--marts", layers.marts]


def land(m, folder):
    """Pages of at most 250 records per entity; children carry their parent's purchase time."""
    times = m.operational("orders").select("order_id", "order_purchase_timestamp")
    for entity in ENTITIES:
        rows = m.operational(entity.name)
        rows = rows.join(times, "order_id") if entity.parent else rows
        picked = rows.limit(900).select(*[F.col(c) for c in landing_schema(entity).names])
        numbered = picked.select(F.floor(F.monotonically_increasing_id() / 250).alias("page"), F.struct("*").alias("row"))
        page = numbered.groupBy("page").agg(F.count("*").alias("count"), F.collect_list("row").alias("data"))
        page.select("count", "data").write.json(f"{folder}/{entity.name}")


def test_steps(spark, layers, capsys):
    m = Models(spark, SMALL)
    exports, pages = scratch_path(spark, "exports"), scratch_path(spark, "pages")
    export_csv(m, RAW_SCHEMAS, exports)
    land(m, pages)
    assert main(["load", "--folder", exports, *names(layers)], spark) == 0
    assert "orders: 1500 rows" in capsys.readouterr().out
    assert main(["build", "--normalize-keys", *names(layers)], spark) == 0
    assert spark.table(f"{layers.marts}.fct_orders").count() == 1500
    assert spark.table(f"{layers.marts}.mart_ingestion_monitoring").count() == 0
    assert main(["ingest", "--folder", pages, "--batch-id", "b1", *names(layers)], spark) == 0
    assert spark.table(f"{layers.raw}._ingest_orders").count() == 900
    assert main(["build", *names(layers)], spark) == 0
    before = spark.table(f"{layers.marts}.fct_orders").inputFiles()
    main(["check", *names(layers)], spark)
    assert spark.table(f"{layers.marts}.fct_orders").inputFiles() == before  # checks rebuild nothing
    assert spark.table(f"{layers.intermediate}.int_customer_orders").count() == 1500
    assert main(["validate", "--batch-id", "b1", *names(layers)], spark) == 0
    assert "orders: 900 of 900 loaded" in capsys.readouterr().out


def test_missing_arguments(capsys):
    for argv in (["load"], ["validate"], ["unknown"]):
        with pytest.raises(SystemExit):
            main(argv)


def test_initial_watermarks(spark, layers, capsys):
    from bazaarlake.sources.ingest_log import WatermarkStore
    from bazaarlake.sources.tables import overwrite_table

    m = Models(spark, SMALL)
    for name in ("orders", "reviews"):
        overwrite_table(m.raw(name), layers.raw, name)
    assert main(["init-watermarks", *names(layers)], spark) == 0
    store = WatermarkStore(spark, layers.raw)
    assert store.load().count() == 7
    assert store.get("orders") == m.raw("orders").agg(F.max("order_purchase_timestamp")).first()[0]
