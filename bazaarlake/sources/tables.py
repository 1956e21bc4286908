"""Catalog tables: namespaces, named sources, materialization and scratch tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from bazaarlake.schemas import AUDIT, ENTITIES, RAW_SCHEMAS
from bazaarlake.session import scratch_path
from bazaarlake.sources import versions

AUDIT_TABLE = "ingestion_audit"
WATERMARK_TABLE = "ingestion_watermarks"

# The named sources: raw history, append-only companions, audit log.
SOURCES = (*RAW_SCHEMAS, *[entity.ingest_table for entity in ENTITIES], AUDIT_TABLE)


@dataclass(frozen=True)
class Layers:
    """Namespace of each layer."""

    raw: str = "raw"
    staging: str = "staging"
    intermediate: str = "intermediate"
    marts: str = "analytics"

    def names(self) -> tuple[str, ...]:
        return (self.raw, self.staging, self.intermediate, self.marts)


def route_namespace(custom: str | None, default: str) -> str:
    """A layer's own name is used as it is, otherwise the default of the target."""
    return (custom or "").strip() or default


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> str:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
    return name


def create_layers(spark: SparkSession, layers: Layers, location: str | None = None) -> Layers:
    for name in layers.names():
        create_namespace(spark, name, f"{location}/{name}" if location else None)
    return layers


def source(spark: SparkSession, namespace: str, name: str) -> DataFrame:
    """One of the named sources as a DataFrame; anything else is an error."""
    if name not in SOURCES:
        raise KeyError(f"unknown source {name!r}")
    return spark.table(f"`{namespace}`.`{name}`")


def table_exists(spark: SparkSession, namespace: str, name: str) -> bool:
    return spark.catalog.tableExists(f"`{namespace}`.`{name}`")


def overwrite_table(df: DataFrame, namespace: str, name: str) -> int:
    """Replace the table and return the rows written, counted during the write.

    The new rows are a version of their own, to which the name then points (see ``versions``). So a write that fails
    leaves the table as it was, a reader finds the old or the new one at any time, and a table may be replaced by what is
    read from it.
    """
    return versions.publish(df, namespace, name).rows


def append_table(df: DataFrame, namespace: str, name: str) -> None:
    """Append to the version that the name points at; the first append makes it."""
    spark = df.sparkSession
    version = versions.current_version(spark, namespace, name)
    if version is None and not table_exists(spark, namespace, name):
        versions.publish(df, namespace, name)
    else:
        df.write.mode("append").saveAsTable(f"`{namespace}`.`{version or name}`")


def create_append_tables(spark: SparkSession, namespace: str) -> None:
    """The audit log and the ingest tables with their declared columns, where missing, so
    that the models can be built before the first batch."""
    declared = {entity.ingest_table: entity.ingest_schema for entity in ENTITIES} | {AUDIT_TABLE: AUDIT}
    for name, schema in declared.items():
        if not table_exists(spark, namespace, name):
            append_table(spark.createDataFrame([], schema), namespace, name)


def materialize_view(spark: SparkSession, namespace: str, name: str, query: str) -> DataFrame:
    """A named, lazily evaluated model in its namespace; it outlives the session where the catalog does."""
    spark.sql(f"CREATE OR REPLACE VIEW `{namespace}`.`{name}` AS {query}")
    return spark.table(f"`{namespace}`.`{name}`")


def projection(namespace: str, name: str, columns: Sequence[str]) -> str:
    """The query of a view that only picks columns of a table."""
    return f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM `{namespace}`.`{name}`"


def materialize_table(df: DataFrame, namespace: str, name: str) -> DataFrame:
    """A full-refresh model table; readers scan it instead of repeating its plan."""
    overwrite_table(df, namespace, name)
    return df.sparkSession.table(f"`{namespace}`.`{name}`")


def written(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Cut lineage: write to the shared scratch folder, or a given place in it, and read back.

    Survives lost executors, unlike a cached frame, and keeps column pruning.
    """
    path = path or scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove what ``written`` left, once nothing reads it any more."""
    versions.remove_folder(spark, path)
