"""The ingest path as Structured Streaming jobs over a landing folder."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bazaarlake.operators.incremental import as_time
from bazaarlake.operators.latest import conform
from bazaarlake.schemas import Entity
from bazaarlake.sources.ingest_log import (
    FAILED,
    SOURCE_TIME,
    SUCCESS,
    AuditRecord,
    append_batch,
    audit_append,
    utc_now,
)
from bazaarlake.sources.tables import AUDIT_TABLE, table_exists

EPOCH_COLUMN = "_epoch"
#: Generations of a running state take turns in so many folders: the current one, the one before, the next.
SLOTS = 3

# Keyed state may outgrow the heap; keep it in the embedded on-disk store.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_disk_state(spark: SparkSession) -> None:
    """An epoch stores what it changed; the store's files follow in the background, not in every epoch's commit. The rows
    in the store are not counted, which would take a look-up for each row put there."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")


def read_landing(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Landed JSON rows as a stream. Text that is not JSON is read as a row without any value;
    such a row fails the query, so that its file is read again."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    empty = F.coalesce(*[F.col(name).cast("string") for name in schema.names]).isNull()
    return reader.json(path).filter(
        F.when(empty, F.raise_error(F.lit("landed text is not a record")).cast("boolean")).otherwise(True)
    )


def stream_ingest(
    rows: DataFrame,
    entity: Entity,
    namespace: str,
    checkpoint: str,
    stream_id: str,
    now: datetime | None = None,
) -> StreamingQuery:
    """Append all landed rows not seen before to the entity's ingest table, then stop.

    The checkpoint replaces the watermark: it records files, so a row with an old
    source time is still ingested. A batch is named by the stream, which keeps its name
    through restarts, and by the epoch. An epoch that comes again after a failure
    finds its rows stored, or not, and adds only what is missing: rows, audit row.
    A failed attempt has an audit row of its own name, the batch id and the time.
    """

    def stored(spark: SparkSession, table: str, column: str, batch_id: str) -> DataFrame:
        return spark.table(f"`{namespace}`.`{table}`").where(F.col(column) == batch_id)

    def append(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch_id = f"{stream_id}-{epoch:08d}"
        started = utc_now()

        def record(name: str, n: int, last: datetime | None, status: str, error: str | None = None) -> None:
            times = (started, utc_now())
            audit_append(spark, namespace, AuditRecord(name, entity.name, *times, n, n, None, last, status, error))

        try:
            if table_exists(spark, namespace, entity.ingest_table):
                there = stored(spark, entity.ingest_table, "_batch_id", batch_id)
            else:
                there = spark.createDataFrame([], entity.ingest_schema)
            known = entity.watermark_column in batch.columns
            time = as_time(batch, entity.watermark_column) if known else F.lit(None).cast("timestamp")
            if there.isEmpty():
                declared = batch.select(*conform(batch, entity.schema), time.alias(SOURCE_TIME))
                done = append_batch(declared, namespace, entity.ingest_table, entity.keys, batch_id, now or started)
                n, last = done.rows, done.last
            else:
                n, last = batch.agg(F.count("*"), F.max(time)).first()
            audited = table_exists(spark, namespace, AUDIT_TABLE)
            if not audited or stored(spark, AUDIT_TABLE, "batch_id", batch_id).where(f"entity = '{entity.name}'").isEmpty():
                record(batch_id, n, last, SUCCESS)
        except Exception as failure:
            try:
                record(f"{batch_id}.{started:%Y%m%dT%H%M%S%f}", 0, None, FAILED, str(failure))
            except Exception as second:
                failure.add_note(f"the audit row of {entity.name} could not be written: {second}")
            raise
        finally:
            # epochs run in a session of their own; the caller's must not go on with old file lists
            for table in (entity.ingest_table, AUDIT_TABLE):
                if table_exists(rows.sparkSession, namespace, table):
                    rows.sparkSession.catalog.refreshTable(f"`{namespace}`.`{table}`")

    return (
        rows.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_latest_per_key(rows: DataFrame, keys: Sequence[str], version: Sequence[Column]) -> DataFrame:
    """Running latest row per key, for update mode. Ties go to the remaining columns in
    descending order, as in the batch operator; state holds one row per key, on disk: this
    sets the state store of the session."""
    use_disk_state(rows.sparkSession)
    rest = [c for c in rows.columns if c not in keys]
    order = [value.alias(f"_version{i}") for i, value in enumerate(version)]
    latest = F.max(F.struct(*order, *rest)).alias("latest")
    return rows.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"latest.{c}").alias(c) for c in rest])


def write_updates(updates: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Store what each epoch changed in a folder of its own; a replay overwrites it."""

    def store(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/{EPOCH_COLUMN}={epoch}")

    return (
        updates.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def compact_updates(spark: SparkSession, target: str, keys: Sequence[str], schema: T.StructType, place: str) -> DataFrame:
    """Write the state after the last epoch as a log of one epoch to a new place, which
    ``read_updates`` reads as well. Run it between queries, then go on from there."""
    last = spark.read.parquet(target).agg(F.max(EPOCH_COLUMN)).first()[0]
    read_updates(spark, target, keys, schema).write.parquet(f"{place}/{EPOCH_COLUMN}={last}")
    return read_updates(spark, place, keys, schema)


def read_updates(spark: SparkSession, target: str, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """The state after the last epoch: per key the row of its highest epoch."""
    full = T.StructType([*schema.fields, T.StructField(EPOCH_COLUMN, T.LongType())])
    log = spark.read.schema(full).parquet(target)
    rest = [f.name for f in schema.fields if f.name not in keys]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), EPOCH_COLUMN).alias("row"))
    return newest.select(*keys, *[F.col(f"row.{c}").alias(c) for c in rest])


@dataclass(frozen=True)
class Generation:
    """A log of epochs that begins with the whole state after epoch ``through``; the first one begins with nothing."""

    number: int
    through: int

    def place(self, target: str) -> str:
        return f"{target}/slot{self.number % SLOTS}"


def current_generation(spark: SparkSession, target: str) -> Generation | None:
    """The generation with the highest number that was written whole."""
    try:
        known = spark.read.schema("number long, through long").json(f"{target}/generations")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = known.agg(F.max(F.struct("number", "through"))).first()[0]
    return Generation(*newest) if newest else None


def _point_at(spark: SparkSession, target: str, generation: Generation) -> None:
    row = spark.createDataFrame([(generation.number, generation.through)], "number long, through long")
    row.coalesce(1).write.mode("append").json(f"{target}/generations")


def _grown(spark: SparkSession, target: str, generation: Generation) -> bool:
    """Whether the changes of a generation are three quarters as many rows as it began with, or more."""
    log = spark.read.schema(T.StructType([T.StructField(EPOCH_COLUMN, T.LongType())])).parquet(generation.place(target))
    first = F.col(EPOCH_COLUMN) <= generation.through
    counted = log.agg(F.count_if(first).alias("base"), F.count_if(~first).alias("changes")).first()
    return 4 * counted["changes"] >= 3 * counted["base"]


def write_generations(
    updates: DataFrame, target: str, keys: Sequence[str], checkpoint: str, every: int = 64
) -> StreamingQuery:
    """Store what each epoch changed, and fold the log into a new generation while the stream runs: after ``every`` epochs, once
    they changed at least three quarters as many rows as the generation began with.

    A generation is written beside the current one and then named in the list of generations; until that a reader and a
    replay see the old one. An epoch that comes again overwrites its rows, or is left out where a generation holds it
    already. A reader may go on with the generation before the current one; what is older is overwritten. A fold writes at most 7/3 of
    the rows that changed since the one before, so all folds together write no more than that share of all changes, however many epochs there are.
    """

    def store(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        now = current_generation(spark, target)
        if now is None:
            now = Generation(0, -1)
            _point_at(spark, target, now)
        if epoch <= now.through:
            batch.write.format("noop").mode("overwrite").save()  # the epoch's keyed state is still to be stored
            return
        batch.write.mode("overwrite").parquet(f"{now.place(target)}/{EPOCH_COLUMN}={epoch}")
        if epoch - now.through >= every and _grown(spark, target, now):
            after = Generation(now.number + 1, epoch)
            state = _read_generation(spark, target, now, keys, updates.schema).withColumn(EPOCH_COLUMN, F.lit(epoch))
            whole = state.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(EPOCH_COLUMN)
            whole.parquet(after.place(target))
            _point_at(spark, target, after)

    return (
        updates.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _read_generation(
    spark: SparkSession, target: str, generation: Generation, keys: Sequence[str], schema: T.StructType
) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(EPOCH_COLUMN, T.LongType())])
    log = spark.read.schema(full).parquet(generation.place(target))
    base = log.where(F.col(EPOCH_COLUMN) == generation.through).select(*schema.names)
    rest = [name for name in schema.names if name not in keys]
    changes = log.where(F.col(EPOCH_COLUMN) > generation.through)
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), EPOCH_COLUMN).alias("row"))
    newest = newest.select(*keys, *[F.col(f"row.{c}").alias(c) for c in rest]).select(*schema.names)
    same = reduce(lambda a, b: a & b, [base[k].eqNullSafe(newest[k]) for k in keys])
    return base.join(newest, same, "left_anti").unionByName(newest)


def read_generations(spark: SparkSession, target: str, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """The state after the last epoch: the current generation's first epoch without the keys that changed since, and their newest
    rows. Only the changes are grouped, and a read costs the same however many epochs went before."""
    now = current_generation(spark, target)
    if now is None:
        return spark.createDataFrame([], schema)
    return _read_generation(spark, target, now, keys, schema)


def stream_retry_dedup(rows: DataFrame, version: str) -> DataFrame:
    """Drop retried appends of the same record version, however late they come.

    The hash names the record and ``version`` its source time, so an update with a
    new source time stays, and so does a record that arrives late. There is no event-time
    watermark, hence the keys are kept for good, on disk: this sets the state
    store of the session.
    """
    use_disk_state(rows.sparkSession)
    return rows.dropDuplicates(["_record_hash", version])
