"""Global NTILE without a global sort.

A window without partitions sends every row to one task. The bucket of a row,
however, depends only on the few rows that end a bucket: with N rows and n
buckets these sit at n - 1 known positions. This operator finds the keys at
those positions exactly and then labels rows by comparison, which needs no
shuffle at all:

1. a bounded random sample proposes splitters around each position;
2. one aggregate counts exactly how many rows are at or below each splitter;
3. this repeats until each position lies in a band of a bounded number of rows;
4. only the rows of those bands are ranked, and at most n - 1 keys per ordering
   reach the driver.

The sample only narrows the search; every count and key is exact, so the
result equals NTILE over the same total order. Heavy ties (nearly all customers
with one order) do not matter because the tie column is part of the key.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_NUMBER = T.DecimalType(38, 9)
MAX_BAND_ROWS = 200_000
SAMPLE_ROWS = 20_000
MAX_ROUNDS = 50

Key = tuple  # (null rank, number, tie is known, tie)


@dataclass(frozen=True)
class Ordering:
    """Rank by a numeric column; NULLs come first ascending and last descending."""

    column: str
    descending: bool = False


def _key(order: Ordering, tie: str) -> Column:
    value = F.col(order.column).cast(KEY_NUMBER)
    null_rank = F.when(value.isNull(), 1 if order.descending else 0).otherwise(0 if order.descending else 1)
    number = F.coalesce(-value if order.descending else value, F.lit(0)).cast(KEY_NUMBER)
    return F.struct(
        null_rank.alias("null_rank"),
        number.alias("number"),
        F.col(tie).isNotNull().cast("int").alias("tie_known"),
        F.coalesce(F.col(tie).cast("string"), F.lit("")).alias("tie"),
    )


def _literal(key: Key) -> Column:
    return F.struct(
        F.lit(key[0]).alias("null_rank"),
        F.lit(key[1]).cast(KEY_NUMBER).alias("number"),
        F.lit(key[2]).alias("tie_known"),
        F.lit(key[3]).alias("tie"),
    )


def bucket_ends(rows: int, buckets: int) -> list[int]:
    """Position of the last row of each bucket but the last one."""
    size, larger = divmod(rows, buckets)
    return [i * size + min(i, larger) for i in range(1, buckets)]


class _Search:
    """Known exact ranks for one ordering, and the positions still wanted."""

    def __init__(self, rows: int, positions: list[int]):
        self.ranks: dict[Key, int] = {}
        self.rows = rows
        self.positions = sorted(set(positions))

    def band(self, position: int) -> tuple[Key | None, int, Key | None, int]:
        """(low key, rank of low, high key, rank of high): low rank < position <= high rank."""
        low, low_rank, high, high_rank = None, 0, None, self.rows
        for key, rank in self.ranks.items():
            if rank < position and (low is None or key > low):
                low, low_rank = key, rank
            if rank >= position and (high is None or key < high):
                high, high_rank = key, rank
        return low, low_rank, high, high_rank

    def bands(self) -> dict[tuple, list[int]]:
        grouped: dict[tuple, list[int]] = {}
        for position in self.positions:
            grouped.setdefault(self.band(position), []).append(position)
        return grouped

    def wide(self, limit: int) -> dict[tuple, list[int]]:
        return {b: p for b, p in self.bands().items() if b[3] - b[1] > limit}

    def splitters(self, band: tuple, positions: list[int], sample: list[Key]) -> set[Key]:
        """Sampled keys a little below and above where each position should fall."""
        low, low_rank, high, high_rank = band
        inside = sorted(k for k in sample if (low is None or k > low) and (high is None or k < high))
        size, found = len(inside), set()
        if not size:
            return found
        for position in positions:
            share = (position - low_rank) / (high_rank - low_rank)
            slack = 3 * math.sqrt(share * (1 - share) / size) + 2 / size
            for edge in (share - slack, share + slack):
                found.add(inside[min(size - 1, max(0, int(edge * size)))])
        return found


def _inside(key: Column, band: tuple) -> Column:
    low, _, high, _ = band
    test = F.lit(True)
    if low is not None:
        test = test & (key > _literal(low))
    if high is not None:
        test = test & (key <= _literal(high))
    return test


def _narrow(df, keys, searches, max_band, sample_rows):
    for turn in range(MAX_ROUNDS):
        wide = {name: search.wide(max_band) for name, search in searches.items()}
        if not any(wide.values()):
            return
        wanted = F.lit(False)
        for name, bands in wide.items():
            for band in bands:
                wanted = wanted | _inside(keys[name], band)
        heaviest = max(b[3] - b[1] for bands in wide.values() for b in bands)
        rows = df.filter(wanted).sample(min(1.0, sample_rows / heaviest), seed=turn)
        sample = rows.select(*[keys[name].alias(name) for name in searches]).collect()
        counts = {}
        for name, bands in wide.items():
            seen = [tuple(row[name]) for row in sample]
            for band, positions in bands.items():
                for key in searches[name].splitters(band, positions, seen):
                    counts[f"{name}:{len(counts)}"] = (name, key)
        if not counts:
            continue
        exact = df.agg(*[F.count_if(keys[n] <= _literal(k)).alias(a) for a, (n, k) in counts.items()]).first()
        for alias, (name, key) in counts.items():
            searches[name].ranks[key] = exact[alias]
    raise RuntimeError("bands did not narrow: is the tie column unique?")


def _pick(df, keys, searches) -> dict[str, dict[int, Key]]:
    """Rank the rows of the narrow bands only and fetch the keys at the positions."""
    entries, wanted = [], F.lit(False)
    for name, search in searches.items():
        for number, (band, positions) in enumerate(search.bands().items()):
            inside = F.struct(F.lit(name).alias("ordering"), F.lit(number).alias("band"), keys[name].alias("key"))
            entries.append(F.when(_inside(keys[name], band), inside))
            places = [p - band[1] for p in positions]
            wanted = wanted | (
                (F.col("ordering") == name) & (F.col("band") == number) & F.col("place").isin(places)
            )
    rows = df.select(F.explode(F.array_compact(F.array(*entries))).alias("entry")).select("entry.*")
    window = Window.partitionBy("ordering", "band").orderBy("key")
    found = rows.withColumn("place", F.row_number().over(window)).filter(wanted).collect()
    picked: dict[str, dict[int, Key]] = {name: {} for name in searches}
    for name, search in searches.items():
        starts = [band[1] for band in search.bands()]
        for row in found:
            if row["ordering"] == name:
                picked[name][starts[row["band"]] + row["place"]] = tuple(row["key"])
    return picked


def with_ntiles(
    df: DataFrame,
    buckets: int,
    orderings: Mapping[str, Ordering],
    tie: str,
    rows: int | None = None,
    max_band: int = MAX_BAND_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Add one NTILE column per ordering. ``tie`` must be unique; ``df`` is scanned a
    few times, so pass a written table rather than a long plan."""
    rows = df.count() if rows is None else rows
    keys = {name: _key(order, tie) for name, order in orderings.items()}
    ends = [e for e in bucket_ends(rows, buckets) if e > 0]
    if not ends:
        return df.withColumns({name: F.lit(1).cast("long") for name in orderings})
    searches = {name: _Search(rows, ends) for name in orderings}
    _narrow(df, keys, searches, max_band, sample_rows)
    picked = _pick(df, keys, searches)
    labels = {}
    for name, key in keys.items():
        label = F.lit(1).cast("long")
        for end in ends:
            label = label + (key > _literal(picked[name][end])).cast("long")
        labels[name] = label
    return df.withColumns(labels)


__all__ = ["Ordering", "bucket_ends", "with_ntiles"]
