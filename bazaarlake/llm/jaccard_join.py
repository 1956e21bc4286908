"""N-gram Jaccard join: documents whose sets of word shingles overlap by 80 per cent, and what they connect.

Sets of 64-bit shingle hashes; documents with equal sets become one before anything is compared.

1. Sieve. Of a set of n shingles the n - T + c with the least hashes are sent out, T being the least overlap of any
   partner and c a tenth of n. Partners have c of these in common, so a set of which fewer are found in other sets has no
   partner. The others are cut to their rarest found shingles, of which partners share one at least; sets that are
   connected by such a shingle make a block.
2. T-occurrence search (DivideSkip) inside a block: the inverted lists of a set's shingles are split into short ones, which
   are merged by counting, and long ones, in which the sets that reached the count left over are looked up by binary search.
   Sets that are already connected need no look-up, so a group of copies costs no pair each.
3. A block of more than ``BLOCK_SHINGLES`` is cut into chunks by hash, with a few common sets in each. What is then not in
   the block's largest component is searched against all other chunks that hold one of its rare shingles, dealt out in
   slices of about ``BLOCK_SHINGLES`` too. So two sets of different components are always compared, and a task holds one
   chunk and one slice, however large the block and however little of it is linked.
4. Components of the links, the smallest id of each, and back to the documents.

Defined results: null or empty text has no shingles and is linked with nothing, its component is itself; fewer words than
a shingle needs count as one shingle; rows with one id are nodes of their own and get one row each, joined by their text;
a null id takes part, but names no component unless nothing else can; other columns are ignored, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm import bytewords
from bazaarlake.llm.components import components
from bazaarlake.llm.tables import written

SHINGLE = 5
#: Shingles of a chunk, about; eight bytes each, a few copies of them in a task.
BLOCK_SHINGLES = 4_000_000
#: Sets of a cut block that are put into each of its chunks.
PIVOTS = 8
#: Weight of a list's length in the choice of long lists, from the published method.
MU = 0.0085


def least_overlap(n: np.ndarray) -> np.ndarray:
    """Shingles that a set of n shares at least with any partner: 80 per cent of n."""
    return (4 * n + 4) // 5


def wanted(n: np.ndarray) -> np.ndarray:
    """Common shingles that the sieve asks for."""
    return np.maximum(1, n // 10)


def shingle_sets(text: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """All distinct shingles, sorted in each text, and the number of each text's first one, with the end."""
    w = bytewords.words(text, lower=True)
    hashes = w.hashes()
    begin, key = bytewords.windows(w, hashes, k)
    doc = np.searchsorted(w.first, begin, "right") - 1
    docs, keys = [doc], [key]
    for short in range(1, k):
        own = np.flatnonzero(w.count == short)
        if len(own):
            begin, key = bytewords.windows(w, hashes, short)
            place = np.searchsorted(begin, w.first[own])
            docs.append(own)
            keys.append(key[place])
    doc, key = np.concatenate(docs), np.concatenate(keys)
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    doc, key = doc[fresh], key[fresh]
    return key, np.searchsorted(doc, np.arange(len(w.count) + 1))


def signatures(key: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One number for each set, equal for equal sets."""
    run = np.concatenate([[np.uint64(0)], np.cumsum(bytewords.mixed(key))])
    n = np.diff(first)
    return bytewords.mixed(run[first[1:]] - run[first[:-1]] + n.astype(np.uint64)).view(np.int64)


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, sig, n): signature and size of each document's set; no signature for the empty one."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bytewords.slices(batch):
                key, first = shingle_sets(part.column("text"))
                n = np.diff(first)
                sig = pa.array(signatures(key, first), mask=n == 0)
                yield pa.record_batch(
                    [part.column("doc_id"), part.column("text_key"), sig, pa.array(n.astype(np.int64))],
                    ["doc_id", "text_key", "sig", "n"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(of_batches, f"doc_id {kind}, text_key long, sig long, n long")


def sampled(docs: DataFrame) -> DataFrame:
    """(token, sig, n): the least hashes of each set, as many as the sieve needs."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bytewords.slices(batch):
                key, first = shingle_sets(part.column("text"))
                n = np.diff(first)
                place = np.arange(len(key)) - np.repeat(first[:-1], n)
                chosen = place < np.repeat(n - least_overlap(n) + wanted(n), n)
                sig = np.repeat(signatures(key, first), n)
                yield pa.record_batch(
                    [
                        pa.array(key[chosen].view(np.int64)),
                        pa.array(sig[chosen]),
                        pa.array(np.repeat(n, n)[chosen].astype(np.int32)),
                    ],
                    ["token", "sig", "n"],
                )

    return docs.select("text").mapInArrow(of_batches, "token long, sig long, n int")


def rare_tokens(docs: DataFrame) -> DataFrame:
    """(sig, token) of the sets that may have a partner: their rarest found shingles, of which partners share one."""
    by_set = Window.partitionBy("token").orderBy("sig")
    found = (
        sampled(docs)
        .withColumn("last", F.lag("sig").over(by_set))
        .where("last is null or last <> sig")  # equal sets count once
        .withColumn("sets", F.count("*").over(Window.partitionBy("token")))
        .where("sets > 1")
    )
    needed = "greatest(1, cast(((4 * n + 4) div 5) div 10 as int))"
    return (
        found.groupBy("sig", "n")
        .agg(F.array_sort(F.collect_list(F.struct("sets", "token"))).alias("tokens"))
        .withColumn("needed", F.expr(needed))
        .where("size(tokens) >= needed")
        .select("sig", F.explode(F.expr("slice(tokens, 1, size(tokens) - needed + 1)")).alias("t"))
        .select("sig", F.col("t.token").alias("token"))
    )


def blocks(rare: DataFrame) -> DataFrame:
    """(sig, block) of the sets of rare_tokens(); partners are in one block."""
    stars = rare.withColumn("least", F.first("sig").over(Window.partitionBy("token").orderBy("sig")))
    links = stars.where("sig <> least").select(F.col("sig").alias("a"), F.col("least").alias("b")).distinct()
    return components(links).select(F.col("node").alias("sig"), F.col("label").alias("block"))


def divide_skip(sets: list[np.ndarray], asks: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what is linked: each asking set against all others. Sets are sorted, without repeats."""
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")  # lists of owners, ascending, one after another
    new = np.concatenate([[True], flat[order][1:] != flat[order][:-1]])
    number = np.cumsum(new) - 1
    token = np.empty(len(flat), np.int64)
    token[order] = number
    lists = owner[order]
    begin = np.flatnonzero(np.concatenate([new, [True]]))
    length = np.diff(begin)
    edge = np.concatenate([[0], np.cumsum(size)])
    group, links = np.arange(len(sets)), []  # sets of one number are connected
    for q in np.flatnonzero(asks):
        t = int(least_overlap(size[q : q + 1])[0])
        mine = token[edge[q] : edge[q + 1]]
        mine = mine[length[mine] > 1]
        # a larger partner needs a larger overlap, and a smaller one at least this share of q
        if len(mine) < t:
            continue
        mine = mine[np.argsort(length[mine], kind="stable")]
        n_long = min(t - 1, int(t / (MU * np.log2(max(2, length[mine[-1]])) + 1)))
        short, long = mine[: len(mine) - n_long], mine[len(mine) - n_long :]
        # the lists are merged by counting each set's occurrences
        count = np.bincount(np.concatenate([lists[begin[x] : begin[x + 1]] for x in short]), minlength=len(sets))
        others = np.flatnonzero((count >= t - n_long) & (group != group[q]))
        # 9 * overlap >= 4 * (both sizes) is what 80 per cent means
        fits = (5 * size[others] >= 4 * size[q]) & (4 * size[others] <= 5 * size[q])
        for r in others[fits].tolist():
            if group[q] == group[r]:
                continue
            theirs = np.sort(token[edge[r] : edge[r + 1]])
            at = np.minimum(np.searchsorted(theirs, long), len(theirs) - 1)
            overlap = int(count[r]) + int((theirs[at] == long).sum())
            if 9 * overlap >= 4 * (size[q] + size[r]):
                group[group == group[r]] = group[q]
                links.append((int(q), r))
    return links


def searched(rows: DataFrame) -> DataFrame:
    """Links (a, b) between signatures. rows: block, chunk, slice, sig, asks, text; one search for each of the first three."""

    place = ["block", "chunk", "slice"]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sigs, sets, asks = None, [], [], []

        def out() -> pa.RecordBatch:
            # the same set may come twice; it asks if one of them does
            of = {}
            for s, x, a in zip(sigs, sets, asks, strict=True):
                of[s] = (x, a or (s in of and of[s][1]))
            names = list(of)
            links = divide_skip([of[s][0] for s in names], np.array([of[s][1] for s in names])) if len(names) > 1 else []
            return pa.record_batch(
                [pa.array([names[i] for i, _ in links], pa.int64()), pa.array([names[j] for _, j in links], pa.int64())],
                ["a", "b"],
            )

        for batch in batches:
            for part in bytewords.slices(batch):
                key, first = shingle_sets(part.column("text"))
                heads = zip(*(part.column(c).to_pylist() for c in (*place, "sig", "asks")), strict=True)
                for i, (*at, sig, ask) in enumerate(heads):
                    if at != now:
                        if sigs:
                            yield out()
                        now, sigs, sets, asks = at, [], [], []
                    sigs.append(sig)
                    sets.append(key[first[i] : first[i + 1]].copy())
                    asks.append(ask)
        if sigs:
            yield out()

    return (
        rows.repartition(*place)
        .sortWithinPartitions(*place)
        .select(*place, "sig", "asks", "text")
        .mapInArrow(of_batches, "a long, b long")
    )


def links(docs: DataFrame, sizes: DataFrame, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Links (a, b) of signatures that connect all that is linked. docs: doc_id, text_key, text; sizes: of measured()."""
    # of the documents with one set, one is read again
    one = sizes.where("sig is not null").groupBy(F.col("sig").alias("one_sig"), "n").agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("text_key").alias("key"))).alias("one")
    )
    in_block = blocks(rare_tokens(docs))
    members = in_block.join(one, F.col("sig") == F.col("one_sig")).select("block", "sig", "n", "one.id", "one.key")
    chunks = members.groupBy("block").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("chunks"))
    members = written(
        members.join(chunks.withColumnRenamed("block", "of_block"), F.col("block") == F.col("of_block"))
        .withColumn("chunk", F.expr("pmod(xxhash64(sig, 1), chunks)"))
        .select("block", "sig", "n", "id", "key", "chunk", "chunks")
    )
    # joined by sorting at every size: how many sets are left grows with the input
    texts = docs.select("doc_id", "text_key", "text").hint("merge")

    def with_text(rows: DataFrame) -> DataFrame:
        return rows.join(texts, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key")))

    whole = members.withColumn("slice", F.lit(0).cast("long")).withColumn("asks", F.lit(True))
    cut = members.where("chunks > 1")
    if cut.isEmpty():
        return written(searched(with_text(whole)))
    # a few sets go into every chunk of their block
    rank = F.row_number().over(Window.partitionBy("block").orderBy(F.xxhash64("sig", F.lit(2))))
    pivots = cut.withColumn("rank", rank).where(F.col("rank") <= PIVOTS).drop("rank")
    all_chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks").cast("long") - 1))
    pivots = pivots.withColumn("chunk", all_chunks).withColumn("slice", F.lit(0).cast("long")).withColumn("asks", F.lit(True))
    first = written(searched(with_text(whole.unionByName(pivots))))

    label = components(first).withColumnRenamed("node", "of_sig")
    placed = cut.join(label, F.col("sig") == F.col("of_sig"), "left").withColumn("label", F.coalesce("label", "sig"))
    counted = placed.groupBy("block", "label").count()
    largest = counted.groupBy(F.col("block").alias("l_block")).agg(F.max_by("label", F.struct("count", "label")).alias("l_label"))
    rest = placed.join(largest, (F.col("block") == F.col("l_block")) & (F.col("label") == F.col("l_label")), "left_anti")
    rest = written(rest.select(members.columns))
    if rest.isEmpty():
        return first
    # a set asks the other chunks in which one of its rare shingles lies; in its own it has asked
    of_cut = cut.select(F.col("sig").alias("of_sig"), F.col("chunk").alias("in_chunk"))
    tokens = written(rare_tokens(docs).join(of_cut, F.col("sig") == F.col("of_sig")).select("sig", "token", "in_chunk"))
    lies = tokens.select(F.col("token").alias("of_token"), F.col("in_chunk").alias("to_chunk")).distinct()
    own = tokens.select(F.col("sig").alias("of_sig"), "token")
    routes = rest.join(own, F.col("sig") == F.col("of_sig")).join(lies, F.col("token") == F.col("of_token"))
    asking = (
        routes.where("to_chunk <> chunk")
        .select("block", "sig", "n", "id", "key", F.col("to_chunk").alias("chunk"))
        .distinct()
    )
    asked = asking.groupBy(F.col("block").alias("r_block"), F.col("chunk").alias("r_chunk")).agg(
        F.ceil(F.sum("n") / block_shingles).alias("slices")
    )
    asked = written(asked)
    here = (F.col("block") == F.col("r_block")) & (F.col("chunk") == F.col("r_chunk"))
    columns = ["block", "chunk", "slice", "sig", "id", "key", "asks"]
    asking = asking.join(asked, here).withColumn("slice", F.expr("pmod(xxhash64(sig, 3), slices)"))
    answering = cut.join(asked, here).withColumn("slice", F.explode(F.expr("sequence(0L, slices - 1)")))
    rows = answering.withColumn("asks", F.lit(False)).select(columns).union(asking.withColumn("asks", F.lit(True)).select(columns))
    second = searched(with_text(rows))
    return written(first.union(second))


def jaccard_join(docs: DataFrame, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id for each document."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    sizes = written(measured(rows))
    label = components(links(rows, sizes, block_shingles)).withColumnRenamed("node", "of_sig")
    ids = sizes.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    named = ids.join(label, F.col("sig") == F.col("of_sig"), "left").withColumn("label", F.coalesce("label", "sig"))
    named = written(named.select("sig", "label", "least", "copies"))
    of_label = named.groupBy(F.col("label").alias("group")).agg(F.min("least").alias("component_id"))
    # sets that stand for one document alone name themselves
    component = named.join(of_label, F.col("label") == F.col("group")).where(
        "copies > 1 or not (component_id <=> least)"
    ).select(F.col("sig").alias("of_sig"), "component_id")
    return sizes.join(component, F.col("sig") == F.col("of_sig"), "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One document of each component, that which names it, with all its columns; of repeated rows one stays.

    Documents with a null id stay where nothing else names their component.
    """
    found = jaccard_join(docs.select("doc_id", "text"), block_shingles).where("component_id <=> doc_id")
    named = found.where("doc_id is not null").groupBy("doc_id").agg(F.min("text_key").alias("text_key"))
    nameless = found.where("doc_id is null").select("doc_id", "text_key").distinct()
    kept = named.union(nameless).select(F.col("doc_id").alias("keep_id"), F.col("text_key").alias("keep_key"))
    # the columns travel in a struct, so that their names can't clash
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.struct(*docs.columns).alias("row"))
    same = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_key") == F.col("keep_key"))
    copy = F.row_number().over(Window.partitionBy("doc_id", "text_key").orderBy("text_key"))
    return rows.join(kept, same).withColumn("copy", copy).where(F.col("copy") == 1).select("row.*")
