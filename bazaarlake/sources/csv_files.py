"""Full-refresh loads of the historical CSV exports."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bazaarlake.operators.latest import conform
from bazaarlake.schemas import RAW_SCHEMAS
from bazaarlake.sources.tables import overwrite_table

# Export name of each raw entity, in load order.
EXPORTS = {
    "customers": "customers",
    "orders": "orders",
    "order_items": "order_items",
    "products": "products",
    "order_payments": "payments",
    "order_reviews": "reviews",
    "sellers": "sellers",
    "geolocation": "geolocation",
}


LOAD_THREADS = 4


@dataclass(frozen=True)
class CsvSource:
    path: str
    table: str

    @property
    def schema(self) -> T.StructType:
        return RAW_SCHEMAS[self.table]


def csv_catalogue(folder: str, prefix: str = "", suffix: str = ".csv") -> list[CsvSource]:
    """The eight exports below a folder. Each path may be one file or a folder of part files."""
    return [CsvSource(f"{folder}/{prefix}{name}{suffix}", table) for name, table in EXPORTS.items()]


def operational_catalogue(folder: str, prefix: str = "", suffix: str = ".csv") -> list[CsvSource]:
    """The seven exports of the operational copy, which has no geolocation."""
    return [s for s in csv_catalogue(folder, prefix, suffix) if s.table != "geolocation"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType, quoted_newlines: bool = True) -> DataFrame:
    """Read text and convert to the declared types; nothing is inferred, so a zip code
    keeps its leading zeros and a bad number becomes NULL without losing its row.

    With quoted newlines a file cannot be split, so one task reads a whole file;
    large exports should come as many part files, or pass ``quoted_newlines=False``
    for exports that are known to hold none.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = (
        spark.read.schema(text)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", quoted_newlines)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return raw.select(*conform(raw, schema))


def csv_full_load(spark: SparkSession, item: CsvSource, namespace: str, quoted_newlines: bool = True) -> int:
    """Replace the raw table with the export; returns the rows loaded. A missing file raises."""
    return overwrite_table(read_csv(spark, item.path, item.schema, quoted_newlines), namespace, item.table)


def load_catalogue(
    spark: SparkSession, items: list[CsvSource], namespace: str, quoted_newlines: bool = True
) -> dict[str, int]:
    """Load the exports, some at the same time, so that the tail of one does not leave the cluster idle; the rows of each."""
    load = inheritable_thread_target(spark)(lambda item: csv_full_load(spark, item, namespace, quoted_newlines))
    with ThreadPoolExecutor(LOAD_THREADS) as pool:
        return dict(zip([item.table for item in items], pool.map(load, items), strict=True))
