"""How quality filters act on each other: what every filter removes in every order of the filters.

Five filters judge a document; a bit mask of the failed ones, counted by part (language) and labels, is all that the audit of
the orders needs, so the documents are reduced to additive counts before orders are looked at.

One filter is the search for exact copies. A counting Bloom sketch of all texts comes first: every task counts the cells of its
own texts (the partial aggregation), the shuffle merges these sketches by adding, and a text with a cell that was counted once
is certainly unique. Only the others are shuffled as whole texts, which gives the least id of each text exactly.

Odd input: a null text is empty, a null lang is the part ``''``. A row with a null id is no copy of anything and no earlier
document. Rows that repeat an id with its text have no smaller id among themselves and are no copies of each other; each counts.
Of several label rows with one id, one with quality 1 makes it good and one with toxic 1 makes it toxic. Empty tables give no rows.
Further columns are ignored, whatever their names.

Bounds: the sketch has 16 cells a row, at most MOST_CELLS (128 MB as bits, which is what is broadcast). Beyond about 67 million rows it gets
denser and clears fewer texts: about 97, 40 and 0 per cent of the unique ones at 10^8, 10^9 and 10^10 rows. Results do not change, more
texts are shuffled then.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.tables import written

FILTERS = "ABCDE"
#: Bits of the filters in a mask, in the order of FILTERS.
BIT = {name: 1 << i for i, name in enumerate(FILTERS)}
COPY = BIT["E"]

SEGMENT_BITS = 14
CELLS_PER_ROW = 16
MOST_CELLS = 1 << 30

WHITE = r"[\x20\x09-\x0D]+"


def failed(text: Column) -> Column:
    """Mask of the filters A to D that a text fails: short, repetitive, many capitals, signs."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, WHITE), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    conditions = {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }
    return sum((F.when(c, BIT[name]).otherwise(0) for name, c in conditions.items()), F.lit(0))


def _cells(segments: int) -> tuple[Column, Column, Column]:
    """Segment and the two cells in it of the 64-bit hash ``h``."""
    inside = (1 << SEGMENT_BITS) - 1
    h = F.col("h")
    return (
        h.bitwiseAND(segments - 1),
        F.shiftrightunsigned(h, 16).bitwiseAND(inside),
        F.shiftrightunsigned(h, 30).bitwiseAND(inside),
    )


def segments_for(rows: int, most_cells: int = MOST_CELLS) -> int:
    """Segments of the sketch, a power of two, for so many rows."""
    cells = min(max(rows, 1) * CELLS_PER_ROW, most_cells)
    return max(1, 1 << (cells - 1).bit_length() >> SEGMENT_BITS)


def crowded_cells(texts: DataFrame, segments: int) -> DataFrame:
    """(segment, words): for each segment of the merged sketch one bit a cell, set where two rows or more were counted."""
    segment, one, two = _cells(segments)
    hashed = texts.select(F.xxhash64("text").alias("h"))
    cells = hashed.select(segment.alias("segment"), F.explode(F.array_distinct(F.array(one, two))).alias("cell"))
    crowded = cells.groupBy("segment", "cell").count().where("count > 1")
    bit = F.expr("shiftleft(1L, cast(cell & 63 AS int))")
    words = crowded.groupBy("segment", F.shiftright("cell", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    whole = words.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("by_word"))
    every = F.sequence(F.lit(0).cast("long"), F.lit((1 << SEGMENT_BITS - 6) - 1).cast("long"))
    return whole.select(
        "segment", F.transform(every, lambda w: F.coalesce(F.try_element_at("by_word", w), F.lit(0))).alias("words")
    )


def with_possible(texts: DataFrame, sketch: DataFrame, segments: int) -> DataFrame:
    """The rows with ``possible``: whether another row may have the same text. Never false for a text that repeats."""
    segment, one, two = _cells(segments)

    def crowded(cell: Column) -> Column:
        return F.getbit(F.get("words", F.shiftright(cell, 6).cast("int")), cell.bitwiseAND(63).cast("int")) == 1

    hashed = texts.withColumn("h", F.xxhash64("text")).withColumn("segment", segment)
    joined = hashed.join(F.broadcast(sketch), "segment", "left")
    return joined.withColumn("possible", F.coalesce(crowded(one) & crowded(two), F.lit(False))).drop("h", "words", "segment")


def mask_counts(documents: DataFrame, labels: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """Documents counted by (part, mask of failed filters, good, toxic)."""
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("part"))
    segments = segments_for(documents.count(), most_cells)
    judged = with_possible(texts, written(crowded_cells(texts, segments)), segments)

    digest = F.unhex(F.sha2("text", 256))
    repeats = judged.where("possible").groupBy("text").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    firsts = repeats.where("n > 1").select(digest.alias("digest"), "first_id")

    marked = labels.groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    narrow = judged.select("doc_id", "part", failed(F.col("text")).alias("mask"), F.when(F.col("possible"), digest).alias("digest"))
    known = narrow.join(marked, "doc_id", "left").na.fill(False, ["good", "toxic"])
    kind = ["digest", "part", "mask", "good", "toxic"]
    # all rows of a text with one mask and one label become one row before the texts meet their least ids
    by_id = known.groupBy("doc_id", *kind).agg(F.count("*").alias("n"))
    groups = by_id.groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n")).otherwise(0)).alias("with_id"),
        F.min("doc_id").alias("least"),
        F.min_by("n", "doc_id").alias("at_least"),
    )
    first_here = F.when(F.col("least") == F.col("first_id"), F.col("at_least")).otherwise(0)
    copies = F.when(F.col("first_id").isNotNull(), F.col("with_id") - first_here).otherwise(0)
    flagged = groups.join(firsts, "digest", "left").withColumn("copies", copies)
    both = F.array(
        F.struct(F.col("mask"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct(F.col("mask").bitwiseOR(COPY).alias("mask"), F.col("copies").alias("n")),
    )
    return (
        flagged.select("part", "good", "toxic", F.inline(both)).where("n > 0").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    )


def audit(counts: DataFrame) -> DataFrame:
    """For each part, order of the filters and step: what is kept, removed, already gone, and whose loss it is.

    A step depends only on its filter and the set of filters before it, so the counts are taken once for each of these 80
    cases and then given to the 600 steps of the orders.
    """
    spark = counts.sparkSession
    cases = sorted({(sum(BIT[x] for x in order[:i]), BIT[order[i]]) for order in permutations(FILTERS) for i in range(len(FILTERS))})
    steps = [
        ("".join(order), i + 1, sum(BIT[x] for x in order[:i]), BIT[order[i]])
        for order in permutations(FILTERS)
        for i in range(len(FILTERS))
    ]
    n_orders = len(steps) // len(FILTERS)
    every = F.array(*[F.struct(F.lit(before).alias("before"), F.lit(bit).alias("bit")) for before, bit in cases])
    rows = counts.select("*", F.inline(every))
    mask, n = F.col("mask"), F.col("n")
    fails = mask.bitwiseAND(F.col("bit")) != 0
    here = mask.bitwiseAND(F.col("before")) == 0
    per_filter = F.lit(n_orders) / F.bit_count(mask)  # each failed filter comes first in as many of the orders

    def total(condition: Column, name: str, value: Column = n) -> Column:
        return F.sum(F.when(condition, value).otherwise(0)).cast("long").alias(name)

    by_case = rows.groupBy("part", "before", "bit").agg(
        total(here & ~fails, "kept"),
        total(here & fails, "removed"),
        total(~here & fails, "redundant"),
        total(mask == F.col("bit"), "unique_fails"),
        total(here & fails & F.col("good"), "good_lost"),
        total(here & fails & F.col("toxic"), "toxic_lost"),
        total(fails, "shapley", n * per_filter.cast("long")),
    )
    table = spark.createDataFrame(steps, "filter_order string, step int, before int, bit int")
    measures = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return by_case.join(F.broadcast(table), ["before", "bit"]).select("part", "filter_order", "step", *measures)
