"""Watermark extracts, paging, counts and status of an operational source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_PAGE = 1000


def as_time(df: DataFrame, column: str) -> Column:
    """The column as a timestamp. Text is parsed softly; a typed column stays bare, so
    that a comparison with it is pushed into the scan."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column).try_cast("timestamp")
    return F.col(column)


def _mark(watermark: datetime | str) -> Column:
    return F.lit(watermark).cast("timestamp")


def extract_after(df: DataFrame, column: str, watermark: datetime | str | None) -> DataFrame:
    """Rows strictly after the watermark; everything without one."""
    return df if watermark is None else df.filter(as_time(df, column) > _mark(watermark))


def extract_children_after(
    child: DataFrame, parent: DataFrame, key: str, column: str, watermark: datetime | str | None
) -> DataFrame:
    """Child rows whose parent is after the watermark, with the parent's time carried
    along. Children without a parent drop out."""
    recent = extract_after(parent, column, watermark).select(key, column)
    return child.join(recent, key, "inner")


def late_rows(df: DataFrame, column: str, watermark: datetime | str, ingested: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows at or before the watermark that were never ingested: what a strict
    high-watermark loses."""
    old = df.filter(as_time(df, column) <= _mark(watermark))
    return old.join(ingested.select(*keys), list(keys), "left_anti")


def page(df: DataFrame, order: Sequence[str], limit: int = 100, offset: int = 0) -> DataFrame:
    """One page in a total order; end ``order`` with the business key."""
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be between 1 and {MAX_PAGE}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    return df.orderBy(*order).offset(offset).limit(limit)


def geolocation_page(df: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """A page of a table without a key: all columns order it."""
    return page(df, df.columns, limit, offset)


def entity_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("count"))


def source_status(tables: Mapping[str, DataFrame], orders: DataFrame, column: str) -> DataFrame:
    """(table_name, row_count, latest_order_timestamp), one row per table."""
    counts = None
    for name, df in tables.items():
        part = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = part if counts is None else counts.unionByName(part)
    return counts.withColumn("latest_order_timestamp", orders.agg(F.max(column)).scalar())


def next_watermark(df: DataFrame, column: str) -> DataFrame:
    """The highest known time of a batch; NULL when there is none."""
    return df.agg(F.max(as_time(df, column)).alias("watermark"))
