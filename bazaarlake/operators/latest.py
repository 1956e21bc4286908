"""Keep one record per business key: the latest one, deterministically."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.functions.expr import clean_text, safe_cast

EPOCH = "1970-01-01 00:00:00"
PRIORITY, VERSION, RANK = "_priority", "_version_at", "_rank"


def conform(df: DataFrame, schema: T.StructType) -> list[Column]:
    """The declared columns with the declared types; a column that is missing becomes NULL.

    Both sides of a union are conformed first, so that the union never coerces
    a text key to a number. Numbers fail softly, bad timestamps raise.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for want in schema.fields:
        have = present.get(want.name)
        if have == want.dataType:
            columns.append(F.col(want.name))
            continue
        if have is None:
            value = F.lit(None).cast(want.dataType)
        elif isinstance(want.dataType, T.NumericType):
            value = safe_cast(F.col(want.name), have, want.dataType)
        else:
            value = F.col(want.name).cast(want.dataType)
        columns.append(value.alias(want.name))
    return columns


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """Row 1 of each key in the given order.

    The filter on the rank makes Spark add a partial group limit before the
    exchange: each task ships at most one row per key, also for a hot key.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) == 1).drop(RANK)


def versioned(
    history: DataFrame | None, ingest: DataFrame, schema: T.StructType, version: Column, text_keys: Sequence[str] = ()
) -> DataFrame:
    """History and appended versions in one frame, with what decides between versions of a key.

    The text keys are cleaned, where given, so that a window over them sees one spelling.
    """
    both = ingest.select(*conform(ingest, schema), F.lit(1).alias(PRIORITY), version.alias(VERSION))
    if history is not None:
        first = F.lit(EPOCH).cast("timestamp").alias(VERSION)
        both = history.select(*conform(history, schema), F.lit(0).alias(PRIORITY), first).unionByName(both)
    return both.withColumns({k: clean_text(F.col(k)) for k in text_keys}) if text_keys else both


def newest(versions: DataFrame, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """The row of each key that counts, still with its priority and version: what is newest of parts is newest of the whole."""
    rest = [f.name for f in schema.fields if f.name not in keys]
    order = [F.col(c).desc_nulls_last() for c in (PRIORITY, VERSION, *rest)]
    return first_per_key(versions, keys, *order)


def text_keys(keys: Sequence[str], schema: T.StructType) -> list[str]:
    return [k for k in keys if isinstance(schema[k].dataType, T.StringType)]


def latest_per_key(
    history: DataFrame,
    ingest: DataFrame,
    keys: Sequence[str],
    schema: T.StructType,
    version: Column,
    normalize_keys: bool = False,
) -> DataFrame:
    """History plus appended versions, one row per key.

    Any ingested version beats history; among ingested ones the highest
    ``version`` wins. Equal versions are settled by the remaining columns in
    descending order, so the choice does not depend on row order.
    """
    cleaned = text_keys(keys, schema) if normalize_keys else ()
    return newest(versioned(history, ingest, schema, version, cleaned), keys, schema).drop(PRIORITY, VERSION)
