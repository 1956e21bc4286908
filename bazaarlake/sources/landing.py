"""Pages of a paged feed, landed as JSON envelopes ``{count, data: [...]}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_SIZE = 1000


def envelope(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("count", T.LongType()), T.StructField("data", T.ArrayType(schema))])


def read_landing_pages(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """All records of all pages, whatever their sizes and from however many fetch runs.

    A short page ends a fetch, it does not make other pages void. Text that is not
    JSON, a page without ``data`` and a ``count`` that differs from the records there
    are errors; a page may leave ``count`` out, and further fields are ignored. A value
    that doesn't fit its column is NULL. One envelope per line keeps files splittable;
    pretty-printed files need ``multi_line``.
    """
    reader = spark.read.schema(envelope(schema)).option("multiLine", multi_line)
    # torn text is read as a page without anything
    found = F.coalesce(F.size("data"), F.lit(-1))
    wrong = F.concat(
        F.lit("landed page with count "), F.coalesce(F.col("count").cast("string"), F.lit("absent")),
        F.lit(" and records "), found.cast("string"),
    )
    sound = (found >= 0) & (F.coalesce("count", found) == found)
    records = F.when(sound, F.col("data")).otherwise(F.raise_error(wrong).cast(T.ArrayType(schema)))
    return reader.json(path).select(F.inline(records))
