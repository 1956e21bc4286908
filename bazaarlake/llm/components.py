"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.tables import written

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of links (a, b); the label is the smallest node that can be reached.

    Alternating star contraction: each round hangs the larger neighbours of every node, then the smaller ones, on the least
    neighbour. The minimum is aggregated before the shuffle, so a node with many links needs no group in memory. Each
    round is written to the shared folder.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u <> v").distinct()
    )
    before = None
    for _ in range(MAX_ROUNDS):
        # large star: neighbours above v hang on the least of v and its neighbours
        both = edges.select("v", "u").union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("w"), F.least("v", "m").alias("m"))
        large = both.where("u > v").join(least, F.col("v") == F.col("w")).select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.where("u <> v").distinct()
        # small star: v and its neighbours below hang on the least of these
        least = large.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("w"), "m")
        below = large.join(least, F.col("v") == F.col("w")).select(F.col("u").alias("v"), F.col("m").alias("u"))
        small = below.union(least.select(F.col("w").alias("v"), F.col("m").alias("u"))).where("u <> v").distinct()
        edges = written(small)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u") % 1_000_000_007)).first()
        if state == before:
            roots = edges.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct()
            return edges.select(F.col("v").alias("node"), F.col("u").alias("label")).union(roots)
        before = state
    raise RuntimeError(f"no components after {MAX_ROUNDS} rounds")
