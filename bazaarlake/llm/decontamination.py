"""Benchmark decontamination: training text that repeats a window of words of a benchmark item.

The windows of all items become a set of hashed word n-grams. Every position of every training text looks up the hashes of the words
that follow it, one for each size of windows, in one scan; a hit counts only if the words themselves are equal. Up to
``BROADCAST_BYTES`` the set is broadcast with its words. A larger one is joined by hash with narrow rows (document, place, hash), and
the places found are then verified against the texts, so that texts are shuffled once and not for each of their words.
Only built-in functions are used.

Defined results: null or empty text has no words and no hits; an item without words has no windows; items with
equal windows are all reported; rows with one id and one text are one document and give one row; a null id is an id of
its own; other columns are ignored, whatever their names; without items nothing is hit; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.word_columns import words

N = 10
#: Bytes of windows that are broadcast at most, with what a row of the hash table takes besides its words.
BROADCAST_BYTES = 100_000_000
ROW_BYTES = 150


def gram_hash(tokens: Column, at: Column, size: int) -> Column:
    """Hash of the words from a place on; fewer at the end of the text."""
    return F.xxhash64(*(F.get(tokens, at + j) for j in range(size)))


def item_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """(item_id, size, gram, key): each distinct window of each item; the whole item if it has fewer than n words."""
    tokens = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(n))
    return (
        tokens.select("item_id", size.alias("size"), "w", F.explode(F.sequence(F.lit(0), F.size("w") - size)).alias("at"))
        .select("item_id", "size", F.slice("w", F.col("at") + 1, F.col("size")).alias("gram"))
        .distinct()
        .withColumn("key", F.xxhash64(*(F.get("gram", F.lit(j)) for j in range(n))))
    )


def hits(docs: DataFrame, benchmark: DataFrame, n: int = N) -> tuple[DataFrame, DataFrame]:
    """Windows found in documents, and which items have them.

    First (doc_id, text_key, n_words, at, size, window_id): one row per place, and one without a place for each document.
    Then (window_id, item_id).
    """
    of_items = item_windows(benchmark, n)
    # a window is named by its words' 128 bits
    window_id = F.md5(F.concat_ws(" ", "gram"))
    of_items = of_items.withColumn("window_id", window_id)
    windows = of_items.select("key", "size", "gram", "window_id").distinct()
    by_size = windows.groupBy("size").agg(F.sum(ROW_BYTES + F.octet_length(F.array_join("gram", " "))).alias("bytes")).collect()
    sizes = sorted(r["size"] for r in by_size) or [n]  # n numbers at most

    read = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("w"))
    # place 0 is there also for a text without words
    placed = read.select(
        "doc_id",
        "text_key",
        "w",
        F.size("w").alias("n_words"),
        F.posexplode(F.when(F.size("w") > 0, F.col("w")).otherwise(F.array(F.lit("")))).alias("at", "word"),
    )
    keys = F.array(*[F.struct(F.lit(s).alias("of_size"), gram_hash(F.col("w"), F.col("at"), s).alias("doc_key")) for s in sizes])
    keyed = placed.select("doc_id", "text_key", "w", "n_words", "at", F.inline(keys))
    fits = (F.col("doc_key") == F.col("key")) & (F.col("of_size") == F.col("size")) & (F.col("at") + F.col("of_size") <= F.col("n_words"))
    same = F.slice("w", F.col("at") + 1, F.col("size")) == F.col("gram")
    one = (F.col("at") == 0) & (F.col("of_size") == sizes[0])
    columns = ["doc_id", "text_key", "n_words", "at", "size", "window_id"]
    if sum(r["bytes"] for r in by_size) <= BROADCAST_BYTES:
        found = keyed.join(F.broadcast(windows), fits & same, "left").where(F.col("window_id").isNotNull() | one).select(*columns)
    else:
        narrow = keyed.select("doc_id", "text_key", "n_words", "at", "of_size", "doc_key")
        places = narrow.join(windows, fits).select(
            F.col("doc_id").alias("its_id"), F.col("text_key").alias("its_key"), "at", "size", "gram", "window_id"
        )
        of_doc = F.col("doc_id").eqNullSafe(F.col("its_id")) & F.col("text_key").eqNullSafe(F.col("its_key"))
        all_docs = read.select("doc_id", "text_key", F.size("w").alias("n_words"), F.lit(0).alias("at"), F.lit(sizes[0]).alias("size"))
        hit = read.withColumn("n_words", F.size("w")).join(places.distinct(), of_doc).where(same).select(*columns)
        found = hit.union(all_docs.withColumn("window_id", F.lit(None).cast("string")))
    return found, of_items.select("window_id", "item_id").distinct()


def covered(places: Column) -> Column:
    """How many words lie in the union of places, an array of (at, size)."""
    step = F.aggregate(
        F.array_sort(places),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct(
            (acc["n"] + F.greatest(F.lit(0), p["at"] + p["size"] - F.greatest(acc["end"], p["at"]))).alias("n"),
            F.greatest(acc["end"], p["at"] + p["size"]).alias("end"),
        ),
    )
    return step["n"]


def scan(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, items (sorted as strings) and places of each document."""
    found, item_of = hits(docs, benchmark, n)
    one = found.groupBy("doc_id", "text_key").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.collect_set(F.when(F.col("window_id").isNotNull(), F.struct("at", "size"))).alias("places"),
        F.collect_set("window_id").alias("window_ids"),
    )
    hit = (
        one.select("doc_id", "text_key", F.explode("window_ids").alias("window_id"))
        .join(item_of, "window_id")
        .groupBy(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"))
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    return one.join(
        hit, F.col("doc_id").eqNullSafe(F.col("hit_id")) & F.col("text_key").eqNullSafe(F.col("hit_key")), "left"
    ).select(
        "doc_id",
        "text_key",
        "n_words",
        covered(F.col("places")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        "places",
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """The documents without a hit, with all their columns."""
    found, _ = hits(docs, benchmark, n)
    bad = (
        found.where("window_id is not null")
        .select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"))
        .distinct()
    )
    # names of the input may clash with the two above, so they are joined on expressions of the input itself
    same = docs["doc_id"].eqNullSafe(bad["hit_id"]) & F.xxhash64(docs["text"]).eqNullSafe(bad["hit_key"])
    return docs.join(bad, same, "left_anti")
