"""One incremental batch: extract, append, advance the watermark, audit."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.operators.incremental import as_time, extract_after, extract_children_after
from bazaarlake.operators.latest import conform
from bazaarlake.schemas import ENTITIES, ENTITY, Entity
from bazaarlake.sources.ingest_log import (
    FAILED,
    SOURCE_TIME,
    SUCCESS,
    Appended,
    AuditRecord,
    WatermarkStore,
    append_batch,
    audit_append,
    new_batch_id,
    utc_now,
)

# Fixed value: masters of the historical load are known up to this instant.
MASTER_CUTOFF = "2018-10-17 23:59:59"


@dataclass(frozen=True)
class Loaded:
    fetched: int
    loaded: int
    watermark: datetime | None


def extract(entity: Entity, source: Mapping[str, DataFrame], watermark: datetime | None) -> DataFrame:
    """Rows after the watermark. A child follows its parent's time, which a landed feed
    carries on the child rows already and an operational copy does not."""
    rows = source[entity.name]
    if entity.parent is None or entity.watermark_column in rows.columns:
        return extract_after(rows, entity.watermark_column, watermark)
    parent = source[entity.parent]
    return extract_children_after(rows, parent, entity.keys[0], entity.watermark_column, watermark)


def append_entity(rows: DataFrame, entity: Entity, namespace: str, batch_id: str | None, now: datetime) -> Appended:
    """Project to the declared columns and append to the entity's ingest table."""
    time = as_time(rows, entity.watermark_column).alias(SOURCE_TIME)
    declared = rows.select(*conform(rows, entity.schema), time)
    return append_batch(declared, namespace, entity.ingest_table, entity.keys, batch_id, now)


def ingest_entity(
    entity: Entity,
    source: Mapping[str, DataFrame],
    namespace: str,
    store: WatermarkStore,
    batch_id: str,
    now: datetime,
    marks: Mapping[str, datetime] | None = None,
) -> Loaded:
    """The watermark moves only after the append; a batch without rows or without any
    known time leaves it where it was. ``marks`` is the map if it is already loaded."""
    before = (store.as_dict() if marks is None else marks).get(entity.name)
    done = append_entity(extract(entity, source, before), entity, namespace, batch_id, now)
    if done.last is not None:
        store.save(entity.name, done.last, utc_now())
    return Loaded(done.rows, done.rows, done.last or before)


def run_with_audit(
    spark: SparkSession,
    namespace: str,
    batch_id: str,
    entity: str,
    before: datetime | None,
    work: Callable[[], Loaded],
    clock: Callable[[], datetime] = utc_now,
) -> Loaded:
    """One audit row for success or failure; a failure is re-raised with its whole text.

    If an audit row can't be written either, the first error is raised and the second
    one noted on it. A success that can't be recorded counts as a failure.
    """
    started = clock()

    def record(result: Loaded, status: str, error: str | None = None) -> AuditRecord:
        return AuditRecord(
            batch_id, entity, started, clock(), result.fetched, result.loaded, before, result.watermark, status, error
        )

    try:
        result = work()
        audit_append(spark, namespace, record(result, SUCCESS))
    except Exception as failure:
        try:
            audit_append(spark, namespace, record(Loaded(0, 0, None), FAILED, str(failure)))
        except Exception as second:
            failure.add_note(f"the audit row of {entity} could not be written: {second}")
        raise
    return result


def run_batch(
    spark: SparkSession,
    source: Mapping[str, DataFrame],
    namespace: str,
    batch_id: str | None = None,
    clock: Callable[[], datetime] = utc_now,
    entities: tuple[Entity, ...] = ENTITIES,
) -> str:
    """All entities in their fixed order; the first failure stops the batch."""
    batch_id = batch_id or new_batch_id(clock())
    store = WatermarkStore(spark, namespace)
    marks = store.as_dict()
    for entity in entities:
        run_with_audit(
            spark,
            namespace,
            batch_id,
            entity.name,
            marks.get(entity.name),
            lambda entity=entity: ingest_entity(entity, source, namespace, store, batch_id, clock(), marks),
            clock,
        )
    return batch_id


def init_watermarks(
    existing: DataFrame, orders: DataFrame, reviews: DataFrame, cutoff: str = MASTER_CUTOFF
) -> DataFrame:
    """(entity, watermark): existing entries win, masters default to the cutoff, the
    others to the highest time in the historical tables. Unknown ones are left out."""
    masters = [e.name for e in ENTITIES if e.watermark_column == "updated_at"]
    by_order = [e.name for e in ENTITIES if e.watermark_column == ENTITY["orders"].watermark_column]
    order_time, review_time = ENTITY["orders"].watermark_column, ENTITY["reviews"].watermark_column

    def named(df: DataFrame, names: list[str]) -> DataFrame:
        return df.select(F.explode(F.array(*[F.lit(n) for n in names])).alias("entity"), "watermark")

    last_order = orders.agg(F.date_trunc("second", F.max(order_time)).alias("watermark"))
    last_review = reviews.agg(F.date_trunc("second", F.max(review_time)).alias("watermark"))
    at_cutoff = last_order.select(F.lit(cutoff).cast("timestamp").alias("watermark"))
    defaults = (
        named(at_cutoff, masters).unionByName(named(last_order, by_order)).unionByName(named(last_review, ["reviews"]))
    )
    current = existing.select("entity", F.col("watermark").alias("current"))
    merged = defaults.join(current, "entity", "full")
    return merged.select("entity", F.coalesce("current", "watermark").alias("watermark")).dropna()
