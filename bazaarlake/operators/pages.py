"""Pages of a table at any depth without sorting it for each page.

``paged`` lays a table out once: ranges of a total order, each sorted, one catalog partition each, with an index of one row per range
(first and last key, rows, rows before it). A page by number looks its ranges up in the index and reads only these; the next page behind
a key seeks the same way. The order must end with the business key. Rows that are equal in it come in no defined order among themselves.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.operators.incremental import MAX_PAGE

RANGE = "page_range"
RANGE_ROWS = 100_000


@dataclass(frozen=True)
class Paged:
    spark: SparkSession
    path: str
    order: tuple[str, ...]
    schema: T.StructType

    def index(self) -> DataFrame:
        """(page_range, first_key, last_key, rows, before): one row per range."""
        return self.spark.read.parquet(f"{self.path}/index")

    def _rows(self, ranges: Sequence[int]) -> DataFrame:
        if not ranges:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/rows/{RANGE}={n}" for n in ranges])

    def _key(self) -> Column:
        return F.struct(*self.order)

    def page(self, limit: int = 100, offset: int = 0) -> DataFrame:
        """Rows offset + 1 to offset + limit of the order."""
        if not 1 <= limit <= MAX_PAGE:
            raise ValueError(f"limit must be between 1 and {MAX_PAGE}")
        if offset < 0:
            raise ValueError("offset must not be negative")
        here = (F.col("before") < offset + limit) & (F.col("before") + F.col("rows") > offset)
        found = self.index().where(here).select(RANGE, "before").orderBy("before").collect()  # a page's ranges
        skip = offset - found[0]["before"] if found else 0
        return self._rows([r[RANGE] for r in found]).orderBy(*self.order).offset(skip).limit(limit)

    def after(self, key: Sequence, limit: int = 100) -> DataFrame:
        """The rows that follow a key, which is the token to go on from: the order's values of the last row seen."""
        if not 1 <= limit <= MAX_PAGE:
            raise ValueError(f"limit must be between 1 and {MAX_PAGE}")
        kinds = {f.name: f.dataType for f in self.index().schema["last_key"].dataType.fields}
        token = F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(self.order, key, strict=True)])
        reached = self.index().where(F.col("last_key") > token).orderBy("before")
        # the range that holds the key may have given all its rows but one, so the rows behind the first one count
        behind = F.col("before") - F.min("before").over(Window.partitionBy()) - F.min_by("rows", "before").over(Window.partitionBy())
        found = reached.withColumn("behind", behind).where(F.col("behind") < limit).select(RANGE).collect()
        return self._rows([r[RANGE] for r in found]).where(self._key() > token).orderBy(*self.order).limit(limit)


def paged(df: DataFrame, order: Sequence[str], path: str, range_rows: int = RANGE_ROWS) -> Paged:
    """Lay the table out below ``path``; counts of the index are exact, also where ranges came out uneven."""
    spark = df.sparkSession
    ranges = max(1, -(-df.count() // range_rows))
    numbered = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn(RANGE, F.spark_partition_id())
    numbered.write.partitionBy(RANGE).parquet(f"{path}/rows")
    key = F.struct(*order)
    rows = spark.read.schema(numbered.schema).parquet(f"{path}/rows")
    counted = rows.groupBy(RANGE).agg(F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy(RANGE)) - F.col("rows")  # over one row per range
    counted.withColumn("before", before).write.parquet(f"{path}/index")
    return Paged(spark, path, tuple(order), df.schema)
