"""Tables that are replaced as a whole or bucket by bucket, without a moment in which a reader finds nothing.

A table's name is a view. It points at one *version*, a table of its own that is never changed by a replacement: a new version is
written beside it, and ``CREATE OR REPLACE VIEW`` then moves the pointer in one step of the catalog. A run that stops before that
step leaves the old table, one that stops behind it leaves the new one; what it left half written is swept by the next replacement. A reader
that has opened a version keeps reading it: the last ``KEPT`` versions stay.

A *bucketed* table is laid out by the hash of one key, in files of one bucket each and as one catalog partition per bucket. Two such tables with the
same number of buckets join and group on the key without an exchange, and a filter on the bucket prunes the files. A new
version may replace some buckets only; the others are the old version's files, which both versions then name. Where a bucket is more than a
task should take, the layout cuts it into *slices* by the same hash: a slice is a file, sorted by the key, and a task of its own, while a
bucket is still replaced as a whole. Joins on the key then need no sort either.

One writer at a time replaces a table. A key with very many rows is one slice, read by one task; sorting spills, nothing is held.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

KEY_BUCKET = "key_bucket"
VERSION_PROPERTY = "bazaarlake.version"
#: Versions that stay readable, the current one included.
KEPT = 2
#: Stored bytes that a slice of a bucket should have; the estimate may be far too high, so there are never more slices in all than this.
SLICE_BYTES, MOST_SLICES = 16 << 20, 4096

_VERSION = re.compile(r"(.+)__v(\d{6,})_[0-9a-f]{8}")


@dataclass(frozen=True)
class Layout:
    """Buckets by the hash of a key, each in as many slices. Joins without an exchange need the same numbers on both sides."""

    key: str
    buckets: int = 64
    slices: int = 1

    @property
    def tasks(self) -> int:
        return self.buckets * self.slices


@dataclass(frozen=True)
class Published:
    version: str
    rows: int


def quoted(namespace: str, name: str) -> str:
    return f"`{namespace}`.`{name}`"


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket in which Spark's own bucketed writer puts a row; for a multiple of the number it is the slice, which lies in this bucket."""
    return F.pmod(F.hash(key), F.lit(buckets))


def _tables(spark: SparkSession, namespace: str, name: str) -> list[str]:
    """All versions of a table, complete or not, in the order of their numbers."""
    found = [t.name for t in spark.catalog.listTables(namespace, f"{name}__v*")]
    own = [t for t in found if (m := _VERSION.fullmatch(t)) and m[1] == name.lower()]
    return sorted(own, key=lambda t: int(_VERSION.fullmatch(t)[2]))


def current_version(spark: SparkSession, namespace: str, name: str) -> str | None:
    """The version that the name points at; None where the name is no pointer."""
    if not spark.catalog.tableExists(quoted(namespace, name)):
        return None
    if spark.catalog.getTable(quoted(namespace, name)).tableType != "VIEW":
        return None
    properties = spark.sql(f"SHOW TBLPROPERTIES {quoted(namespace, name)}").collect()
    return {row["key"]: row["value"] for row in properties}.get(VERSION_PROPERTY)


def _new_version(spark: SparkSession, namespace: str, name: str) -> str:
    last = max((int(_VERSION.fullmatch(t)[2]) for t in _tables(spark, namespace, name)), default=0)
    return f"{name.lower()}__v{last + 1:06d}_{uuid.uuid4().hex[:8]}"


def point_at(spark: SparkSession, namespace: str, name: str, version: str, columns: Sequence[str]) -> None:
    """Move the pointer. A plain table that an older release left under the name becomes the version before."""
    if spark.catalog.tableExists(quoted(namespace, name)) and current_version(spark, namespace, name) is None:
        if spark.catalog.getTable(quoted(namespace, name)).tableType == "VIEW":
            spark.sql(f"DROP VIEW {quoted(namespace, name)}")
        else:
            old = f"{name.lower()}__v000000_{uuid.uuid4().hex[:8]}"
            spark.sql(f"ALTER TABLE {quoted(namespace, name)} RENAME TO {quoted(namespace, old)}")
    picked = ", ".join(f"`{c}`" for c in columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(namespace, name)} TBLPROPERTIES ('{VERSION_PROPERTY}' = '{version}') "
        f"AS SELECT {picked} FROM {quoted(namespace, version)}"
    )


def publish(df: DataFrame, namespace: str, name: str) -> Published:
    """Replace a table as a whole; the rows are counted during the write."""
    spark, version, seen = df.sparkSession, _new_version(df.sparkSession, namespace, name), Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").saveAsTable(quoted(namespace, version))
    point_at(spark, namespace, name, version, df.columns)
    sweep(spark, namespace, name)
    return Published(version, seen.get["rows"])


def _folder(spark: SparkSession, namespace: str, version: str) -> str:
    return f"{spark.catalog.getDatabase(namespace).locationUri.rstrip('/')}/{version}"


def _bucket_folders(spark: SparkSession, namespace: str, version: str) -> dict[int, str]:
    """Where each bucket of a bucketed version lies, by its files."""
    files = spark.table(quoted(namespace, version)).inputFiles()
    found = (re.match(rf"(.*/{KEY_BUCKET}=(\d+))/", f) for f in files)
    return {int(m[2]): m[1] for m in found if m}


def laid_out(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows in the partitions of a layout: windows and joins on its key, and ``publish_buckets``, need no other exchange."""
    return df.repartition(layout.tasks, layout.key)


def estimated_bytes(df: DataFrame) -> int:
    """What Spark takes the rows' stored size to be; no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fitting(layout: Layout, stored: int) -> Layout:
    """The layout for a table of so many bytes: one slice a bucket while a bucket is small."""
    wanted = -(-stored // (SLICE_BYTES * layout.buckets))
    return replace(layout, slices=max(1, min(wanted, MOST_SLICES // layout.buckets)))


def slices_of(spark: SparkSession, namespace: str, name: str, buckets: int) -> int:
    """Into how many slices the buckets of a table are cut."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(namespace, current_version(spark, namespace, name))}").collect()
    return max(1, next(int(row["data_type"]) for row in described if row["col_name"] == "Num Buckets") // buckets)


def publish_buckets(
    df: DataFrame,
    namespace: str,
    name: str,
    layout: Layout,
    replaced: Sequence[int] | None = None,
    placed: bool = False,
) -> Published:
    """Replace a bucketed table, or with ``replaced`` the buckets of these numbers only.

    A row of another bucket than those is an error. The other buckets stay the files that they are. ``placed`` rows have the
    layout already and are not shuffled again; the files are the right ones anyhow, a partition with several buckets writes several.
    """
    spark, columns = df.sparkSession, df.columns
    before = current_version(spark, namespace, name)
    version = _new_version(spark, namespace, name)
    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(
        f"CREATE TABLE {quoted(namespace, version)} ({declared}, {KEY_BUCKET} INT) USING parquet "
        f"PARTITIONED BY ({KEY_BUCKET}) CLUSTERED BY (`{layout.key}`) SORTED BY (`{layout.key}`) "
        f"INTO {layout.tasks} BUCKETS LOCATION '{_folder(spark, namespace, version)}'"
    )
    bucket = bucket_of(F.col(layout.key), layout.buckets)
    if before is not None and replaced is not None:
        stay = {k: place for k, place in _bucket_folders(spark, namespace, before).items() if k not in set(replaced)}
        if stay:
            added = " ".join(f"PARTITION ({KEY_BUCKET}={k}) LOCATION '{place}'" for k, place in sorted(stay.items()))
            spark.sql(f"ALTER TABLE {quoted(namespace, version)} ADD {added}")
        wrong = F.raise_error(F.lit("a row outside of the replaced buckets")).cast("int")
        bucket = F.when(bucket.isin(list(replaced)), bucket).otherwise(wrong)
    seen = Observation()
    rows = df.select(*columns, bucket.alias(KEY_BUCKET)).observe(seen, F.count(F.lit(1)).alias("rows"))
    # hash partitioning by the key is the bucketing itself, so a task writes one file of one slice
    (rows if placed else laid_out(rows, layout)).write.insertInto(quoted(namespace, version))
    point_at(spark, namespace, name, version, columns)
    sweep(spark, namespace, name)
    return Published(version, seen.get["rows"])


def rows_of(spark: SparkSession, namespace: str, name: str, buckets: Sequence[int]) -> DataFrame:
    """The rows of some buckets of a bucketed table: only their files are read."""
    version = current_version(spark, namespace, name)
    rows = spark.table(quoted(namespace, version))
    return rows.where(F.col(KEY_BUCKET).isin(list(buckets))).drop(KEY_BUCKET)


def touched(keys: DataFrame, layout: Layout) -> list[int]:
    """The buckets of the keys: as many numbers as there are buckets at most."""
    found = keys.select(bucket_of(F.col(layout.key), layout.buckets).alias("b")).distinct().collect()
    return sorted(row["b"] for row in found)


def remove_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def sweep(spark: SparkSession, namespace: str, name: str, keep: int = KEPT) -> list[str]:
    """Drop the versions behind the last ``keep`` ones up to the current, and those that never became current.

    Files of a dropped version that a kept one still names stay until no version names them.
    """
    current, versions = current_version(spark, namespace, name), _tables(spark, namespace, name)
    if current not in versions:
        return []
    at = versions.index(current)
    kept = versions[max(0, at - keep + 1) : at + 1]
    gone = [v for v in versions if v not in kept]
    named = {place for v in kept for place in _bucket_folders(spark, namespace, v).values()} if gone else set()
    for version in gone:
        root, own = _folder(spark, namespace, version), _bucket_folders(spark, namespace, version)
        spark.sql(f"DROP TABLE IF EXISTS {quoted(namespace, version)}")  # an external one keeps its files
        if own and any(f"/{version}/" in place for place in named):
            for place in own.values():
                if place not in named and f"/{version}/" in place:
                    remove_folder(spark, place)
        else:
            remove_folder(spark, root)
    # folders of versions that were dropped earlier, whose last buckets nothing names any more
    for place in _left_over(spark, namespace, name, versions, named):
        remove_folder(spark, place)
    return gone


def _left_over(spark: SparkSession, namespace: str, name: str, versions: Sequence[str], named: set[str]) -> list[str]:
    """Bucket folders of versions without a table that no kept version names; ``versions`` have just been looked after."""
    root = spark._jvm.org.apache.hadoop.fs.Path(spark.catalog.getDatabase(namespace).locationUri)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for status in files.listStatus(root) if files.exists(root) else []:
        folder = status.getPath()
        match = _VERSION.fullmatch(folder.getName())
        if not match or match[1] != name.lower() or folder.getName() in versions:
            continue
        buckets = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith(f"{KEY_BUCKET}=")]
        tails = {"/".join(place.split("/")[-2:]) for place in named}
        still = [b for b in buckets if f"{folder.getName()}/{b.getName()}" in tails]
        out += [str(b.toString()) for b in buckets if b not in still] if still else [str(folder.toString())]
    return out
