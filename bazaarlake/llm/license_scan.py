"""License scans by diagonal voting.

Every run of K words of a text is hashed and joined to the places where the same run stands in a license template. A
match votes for its diagonal, the word number in the text less the one in the template: an unchanged copy of a
template puts all its votes on one diagonal. Inserted or lost words move the rest to a neighbouring diagonal, so
diagonals at most ``NEAR`` apart are merged. A merged group is a span; it is verified by the share of the template's words
that equal the text's words there. Only built-in functions are used.

Exact phrases are templates too, of which all words must stand on one diagonal. Hash matches count only if the words
are equal.

Defined results: null or empty text has no words and no spans; rows with one id and one text are one document and give
one row; a null id is an id of its own; overlapping spans all count; other columns are ignored, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlake.llm.word_columns import words

K = 3
NEAR = 2
#: Share of a template's words that a span needs.
LEAST_SHARE = 0.8


@dataclass(frozen=True)
class Template:
    label: str
    text: str  # lower-case words, one blank between them
    exact: bool = False


# Phrases and labels.
PHRASES = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)

# Lines by which well-known licenses are given.
NOTICES = (
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("apache-2.0", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    Template("gpl-3.0", "either version 3 of the license or at your option any later version"),
    Template("gpl-2.0", "either version 2 of the license or at your option any later version"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    Template("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
)


def gram_key(tokens: Column, at: Column, size: int) -> Column:
    """Hash of size words from a place on; the size is part of it."""
    return F.xxhash64(F.lit(size), *(F.get(tokens, at + j) for j in range(size)))


def grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(template, t_words, exact, place, size, gram, key): each run of K words of each template, or all of a shorter one."""
    rows = []
    for number, template in enumerate(templates):
        tokens = template.text.split()
        size = min(K, len(tokens))
        for place in range(len(tokens) - size + 1):
            gram = [F.lit(x) for x in tokens[place : place + size]]
            rows.append(
                F.struct(
                    F.lit(number).alias("template"),
                    F.lit(len(tokens)).alias("t_words"),
                    F.lit(template.exact).alias("exact"),
                    F.lit(place).alias("place"),
                    F.lit(size).alias("size"),
                    F.array(*gram).alias("gram"),
                    F.xxhash64(F.lit(size), *gram).alias("key"),
                )
            )
    return spark.range(1).select(F.inline(F.array(*rows)))


def spans(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES) -> DataFrame:
    """(doc_id, text_key, n_words, template, exact, begin, end, share): every span, verified or not.

    A document without any has one row whose template is null.
    """
    spark = docs.sparkSession
    sizes = sorted({min(K, len(t.text.split())) for t in templates})
    read = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("w"))
    placed = read.select(
        "doc_id",
        "text_key",
        "w",
        F.posexplode(F.when(F.size("w") > 0, F.col("w")).otherwise(F.array(F.lit("")))).alias("at", "word"),
    ).select(
        "doc_id", "text_key", "w", "at", F.explode(F.array(*(gram_key(F.col("w"), F.col("at"), s) for s in sizes))).alias("k")
    )
    known = F.broadcast(grams(spark, templates))  # a fixed list
    same = (F.col("k") == F.col("key")) & (F.slice("w", F.col("at") + 1, F.col("size")) == F.col("gram"))
    votes = (
        placed.join(known, same, "left")
        .where(F.col("template").isNotNull() | (F.col("at") == 0))
        .select(
            "doc_id",
            "text_key",
            F.size("w").alias("n_words"),
            "template",
            "t_words",
            "exact",
            (F.col("at") - F.col("place")).alias("diagonal"),
            "at",
            "place",
            "size",
        )
        # all that follows groups by more than these two and needs no other shuffle
        .repartition("doc_id", "text_key")
    )
    one = ["doc_id", "text_key", "template"]
    diagonals = votes.groupBy(*one, "diagonal").agg(
        F.first("n_words").alias("n_words"),
        F.first("t_words").alias("t_words"),
        F.first("exact").alias("exact"),
        F.collect_set(F.when(F.col("template").isNotNull(), F.struct("place", "size"))).alias("hit"),
        F.min("at").alias("begin"),
        F.max(F.col("at") + F.col("size")).alias("end"),
    )
    by_diagonal = Window.partitionBy(*one).orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > F.when(F.col("exact"), 0).otherwise(NEAR), F.lit(True))
    merged = (
        diagonals.withColumn("apart", apart.cast("int"))
        .withColumn("run", F.sum("apart").over(by_diagonal))
        .groupBy(*one, "run")
        .agg(
            F.first("n_words").alias("n_words"),
            F.first("t_words").alias("t_words"),
            F.first("exact").alias("exact"),
            F.flatten(F.collect_list("hit")).alias("hit"),
            F.min("begin").alias("begin"),
            F.max("end").alias("end"),
        )
    )
    found = F.array_distinct(F.flatten(F.transform("hit", lambda h: F.sequence(h["place"], h["place"] + h["size"] - 1))))
    return merged.select(
        *one, "n_words", "exact", "begin", "end", F.when(F.col("template").isNotNull(), F.size(found) / F.col("t_words")).alias("share")
    )


def license_scan(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each document.

    Base: places of exact phrases. Score: the largest share of a template that one span holds, 0 without any.
    """
    labels = F.array(*(F.lit(t.label) for t in templates))
    marked = spans(docs, templates).withColumn("label", F.get(labels, "template"))
    base = F.col("exact") & (F.col("share") == 1.0)
    good = base | (~F.col("exact") & (F.col("share") >= LEAST_SHARE))
    joined = lambda flag: F.array_join(F.array_sort(F.collect_set(F.when(flag, F.col("label")))), ",")
    return (
        marked.groupBy("doc_id", "text_key")
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.count_if(base).alias("n_base"),
            F.min(F.when(base, F.col("begin"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.col("begin"))).cast("long").alias("last_word"),
            joined(base).alias("base_labels"),
            joined(good).alias("labels"),
            F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        )
        .drop("text_key")
    )
