"""Batch metadata on appended rows, the audit log and the watermark store."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import astuple, dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bazaarlake.functions.expr import record_hash
from bazaarlake.schemas import AUDIT, WATERMARKS
from bazaarlake.sources.tables import AUDIT_TABLE, WATERMARK_TABLE, append_table, overwrite_table, table_exists

SUCCESS, FAILED = "SUCCESS", "FAILED"
SOURCE_TIME = "_source_time"


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def new_batch_id(now: datetime | None = None) -> str:
    """UTC time to the second and eight random hex digits."""
    return f"{(now or utc_now()):%Y%m%dT%H%M%S}_{uuid.uuid4().hex[:8]}"


def with_metadata(df: DataFrame, keys: Sequence[str], batch_id: str, ingested_at: datetime) -> DataFrame:
    """The rows plus batch id, arrival time and a hash of the business key."""
    return df.withColumns(
        {
            "_batch_id": F.lit(batch_id),
            "_ingested_at": F.lit(ingested_at).cast("timestamp"),
            "_record_hash": record_hash(*[F.col(k) for k in keys]),
        }
    )


@dataclass(frozen=True)
class Appended:
    """What one append wrote: its batch id, the rows, the highest source time among them."""

    batch_id: str
    rows: int
    last: datetime | None


def append_batch(
    df: DataFrame,
    namespace: str,
    table: str,
    keys: Sequence[str],
    batch_id: str | None = None,
    now: datetime | None = None,
) -> Appended:
    """Append rows with batch metadata; an empty frame adds no row and still has an id.

    The row count and the highest source time, if such a column is carried, are
    observed on the rows being written, in the writing stage itself, so the source
    is read once. The carried column is not stored.
    """
    batch_id = batch_id or str(uuid.uuid4())
    stamped = with_metadata(df, keys, batch_id, now or utc_now())
    last = F.max(SOURCE_TIME) if SOURCE_TIME in df.columns else F.max(F.lit(None).cast("timestamp"))
    seen = Observation()
    counted = stamped.observe(seen, F.count(F.lit(1)).alias("rows"), last.alias("last"))
    append_table(counted.drop(SOURCE_TIME), namespace, table)
    return Appended(batch_id, seen.get["rows"], seen.get["last"])


@dataclass(frozen=True)
class AuditRecord:
    batch_id: str
    entity: str
    started_at: datetime
    completed_at: datetime | None
    records_fetched: int
    records_loaded: int
    watermark_before: datetime | None
    watermark_after: datetime | None
    status: str
    error_message: str | None = None


def audit_append(spark: SparkSession, namespace: str, record: AuditRecord) -> None:
    append_table(spark.createDataFrame([astuple(record)], AUDIT), namespace, AUDIT_TABLE)


@dataclass(frozen=True)
class WatermarkStore:
    """Append-only map of entity to watermark; the highest sequence number counts.

    An append either lands or does not, so a crash never leaves half a map. The
    sequence follows the log itself, so a clock that is set back revives nothing.
    ``compact`` shortens the log to the map.
    """

    spark: SparkSession
    namespace: str

    def _log(self) -> DataFrame:
        if not table_exists(self.spark, self.namespace, WATERMARK_TABLE):
            return self.spark.createDataFrame([], WATERMARKS)
        return self.spark.table(f"`{self.namespace}`.`{WATERMARK_TABLE}`")

    def load(self) -> DataFrame:
        """(entity, watermark); empty when nothing was saved yet."""
        return self._log().groupBy("entity").agg(F.max_by("watermark", "sequence").alias("watermark"))

    def as_dict(self) -> dict[str, datetime]:
        """The whole map in one job: one row per entity."""
        return {row["entity"]: row["watermark"] for row in self.load().collect()}

    def get(self, entity: str) -> datetime | None:
        return self.as_dict().get(entity)

    def save(self, entity: str, watermark: datetime | None, saved_at: datetime | None = None) -> None:
        self.save_all([(entity, watermark)], saved_at)

    def save_all(self, marks: Sequence[tuple], saved_at: datetime | None = None) -> None:
        saved_at = saved_at or utc_now()
        known = [(entity, mark) for entity, mark in marks if mark is not None]
        if known:
            last = self._log().agg(F.max("sequence")).first()[0] or 0
            rows = [(entity, mark, saved_at, last + i) for i, (entity, mark) in enumerate(known, 1)]
            append_table(self.spark.createDataFrame(rows, WATERMARKS), self.namespace, WATERMARK_TABLE)

    def compact(self) -> None:
        """Keep the row of each entity that counts; the log is read before it is replaced."""
        newest = F.max_by(F.struct("watermark", "saved_at", "sequence"), "sequence").alias("row")
        kept = self._log().groupBy("entity").agg(newest).select("entity", "row.*").collect()  # a row per entity
        rows = self.spark.createDataFrame([tuple(row) for row in kept], WATERMARKS)
        overwrite_table(rows, self.namespace, WATERMARK_TABLE)
