"""The daily job: ingest a batch, rebuild the models, check them, pass the gate."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from bazaarlake.operators.quality import run_checks
from bazaarlake.plans.build import build_models
from bazaarlake.plans.checks import suite, validate_batch
from bazaarlake.plans.ingest import run_batch
from bazaarlake.session import tune
from bazaarlake.sources.tables import Layers, create_append_tables


class ChecksFailed(RuntimeError):
    """At least one check of error severity found bad rows."""


@dataclass(frozen=True)
class DayReport:
    batch_id: str
    models: Mapping[str, DataFrame]
    checks: list[Row]
    entities: list[str]

    @property
    def warnings(self) -> list[Row]:
        return [row for row in self.checks if row["status"] == "warn"]


def run_day(
    spark: SparkSession,
    operational: Mapping[str, DataFrame],
    layers: Layers,
    batch_id: str | None = None,
    normalize_keys: bool = False,
) -> DayReport:
    """Warnings are reported; a failed check or an unsound batch raises."""
    tune(spark)
    create_append_tables(spark, layers.raw)
    batch_id = run_batch(spark, operational, layers.raw, batch_id)
    models = build_models(spark, layers, normalize_keys)
    results = run_checks(models, suite()).filter(F.col("status") != "pass").collect()
    failed = [f"{r['model']}.{r['check_name']}: {r['failures']}" for r in results if r["status"] == "fail"]
    if failed:
        raise ChecksFailed("; ".join(failed))
    entities = validate_batch(models["mart_ingestion_monitoring"], batch_id)
    return DayReport(batch_id, models, results, entities)
