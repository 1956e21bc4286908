"""Substring dedup: words that lie in a run of k words which also starts in an earlier document are removed.

Texts are dealt out into chunks of about ``CHUNK_BYTES`` by a hash of id and text. A count-min sketch goes first: each chunk counts its windows in
``DEPTH`` rows of cells that saturate at two, and writes a row's partial sketch as the compressed numbers of its cells, cut
into segments. A segment's parts are merged cell by cell in one task; a merged cell says "at most once" or "perhaps twice". The answer goes back to
each chunk that sent cells, one bit a cell. Estimates are never too low, so a window that any row calls single is
single. A second pass over the chunks sends only the other windows to an exact grouping by 80 bits of hash, whose two parts come from different hashes
of the words. What a chunk already sees to be later than a document of its own needs no grouping, so of a very common
window one row a chunk is grouped. The sketch has as many cells as the text asks for; no task holds more of it than a segment, nothing of it is
broadcast or sent to the driver, and the number of passes is two at any size.

Defined results: null or empty text has no words and stays empty; a null id neither removes nor loses words; rows with
one id are one document and don't remove each other's words, also if their texts differ; other columns are ignored,
whatever their names; an empty table gives an empty result. A chunk is worked on by one task; rows that repeat both id and text lie in one
chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm import bytewords

K = 13
DEPTH = 2
#: Cells of a piece of the sketch.
SEGMENT = 1 << 24
#: Bytes of text in a chunk, on average; a chunk has one document at least.
CHUNK_BYTES = 8_000_000


def plan(docs: DataFrame, segment: int, chunk_bytes: int) -> tuple[int, int]:
    """Bits of a cell's number, and chunks: four to eight cells a window, if a window begins every six bytes."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(segment, 1 << int(size * 2 // 3).bit_length()).bit_length() - 1, max(1, -(-size // chunk_bytes))


def packed(places: np.ndarray, segment: int = SEGMENT) -> bytes:
    """Ascending cells of a segment without repeats: low bits as planes, high parts as a row of steps (Elias-Fano)."""
    n = len(places)
    low = max(0, (segment // max(n, 1)).bit_length() - 1)
    steps = np.zeros((segment >> low) + n, bool)
    steps[(places >> low) + np.arange(n)] = True
    planes = [np.packbits((places >> i & 1).astype(bool)).tobytes() for i in range(low)]
    return b"".join([np.uint32(n).tobytes(), bytes([low]), *planes, np.packbits(steps).tobytes()])


def unpacked(raw: bytes, segment: int = SEGMENT) -> np.ndarray:
    n, low = int(np.frombuffer(raw, np.uint32, 1)[0]), raw[4]
    size = (n + 7) // 8
    bits = np.unpackbits(np.frombuffer(raw, np.uint8, offset=5 + low * size), count=(segment >> low) + n)
    places = (np.flatnonzero(bits) - np.arange(n)) << low
    for i in range(low):
        plane = np.frombuffer(raw, np.uint8, size, 5 + i * size)
        places |= np.unpackbits(plane, count=n).astype(np.int64) << i
    return places


def cells(key: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (bytewords.mixed(key ^ np.uint64(row + 1)) >> np.uint64(64 - bits)).astype(np.int64)


def counted(key: np.ndarray, row: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending cells of the windows in a row of the sketch, and whether each has two of them."""
    cell = np.sort(cells(key, row, bits))
    new = np.ones(len(cell), bool)
    new[1:] = cell[1:] != cell[:-1]
    return cell[new], np.diff(np.append(np.flatnonzero(new), len(cell))) > 1


def by_segment(cell: np.ndarray, segment: int) -> Iterator[tuple[int, slice]]:
    """Each segment that has cells, and where they lie."""
    edge = [*np.flatnonzero(np.diff(cell // segment, prepend=-1)).tolist(), len(cell)]
    for begin, end in zip(edge[:-1], edge[1:], strict=True):
        yield int(cell[begin]) // segment, slice(begin, end)


def pieces(chunk: pa.Table, k: int) -> Iterator[tuple[pa.RecordBatch, bytewords.Words, np.ndarray, np.ndarray]]:
    """Rows with an id, their words, and first word and hash of each window."""
    for batch in chunk.filter(pc.is_valid(chunk["doc_id"])).to_batches():
        for part in bytewords.slices(batch):
            w = bytewords.words(part.column("text"))
            yield part, w, *bytewords.windows(w, w.hashes(), k)


def joined_up(arrays: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, kind)


def repeated_cells(rows: DataFrame, k: int, bits: int, segment: int) -> DataFrame:
    """(chunk, piece, bits): for each chunk and piece of the sketch, which of the chunk's cells there are counted twice or more."""
    per_row = (1 << bits) // segment

    def partial(key: tuple, chunk: pa.Table) -> pa.Table:
        windows = joined_up([key for *_, key in pieces(chunk, k)], np.uint64)
        number, seen, twice = [], [], []
        for row in range(DEPTH):
            cell, again = counted(windows, row, bits)
            for s, here in by_segment(cell, segment):
                number.append(row * per_row + s)
                places = cell[here] - s * segment
                seen.append(packed(places, segment))
                twice.append(np.packbits(again[here]).tobytes())
        return pa.table(
            {
                "chunk": pa.array([key[0].as_py()] * len(number), pa.int64()),
                "piece": pa.array(number, pa.int64()),
                "seen": pa.array(seen, pa.binary()),
                "twice": pa.array(twice, pa.binary()),
            }
        )

    def merged(parts: pa.Table) -> pa.Table:
        seen, twice = np.zeros(segment, bool), np.zeros(segment, bool)
        for batch in parts.to_batches():
            for raw, again in zip(batch.column("seen"), batch.column("twice"), strict=True):
                places = unpacked(raw.as_py(), segment)
                mine = np.unpackbits(np.frombuffer(again.as_py(), np.uint8), count=len(places)).astype(bool)
                twice[places[seen[places] | mine]] = True
                seen[places] = True
        answers = [np.packbits(twice[unpacked(raw.as_py(), segment)]).tobytes() for raw in parts.column("seen")]
        return pa.table({"chunk": parts["chunk"], "piece": parts["piece"], "bits": pa.array(answers, pa.binary())})

    parts = rows.groupBy("chunk").applyInArrow(partial, "chunk long, piece long, seen binary, twice binary")
    return parts.groupBy("piece").applyInArrow(merged, "chunk long, piece long, bits binary")


def candidates(rows: DataFrame, answers: DataFrame, k: int, bits: int, segment: int) -> DataFrame:
    """(high, doc_id, marks, at) of the windows that the sketch calls perhaps repeated: ``marks`` holds 16 bits of hash, then the tag,
    ``at`` the place, then 0, or a number of windows.

    With a number, the chunk has this window and its neighbours in documents with smaller ids too; such rows are dealt out by chance.
    """
    per_row = (1 << bits) // segment
    kind = dict(rows.dtypes)["doc_id"]

    def probed(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        parts = list(pieces(chunk, k))
        windows = joined_up([key for *_, key in parts], np.uint64)
        said = dict(zip(answers.column("piece").to_pylist(), answers.column("bits"), strict=True))
        hit = np.arange(len(windows))
        for row in range(DEPTH):
            cell, again = counted(windows, row, bits)
            for s, here in by_segment(cell, segment):
                raw = np.frombuffer(said[row * per_row + s].as_buffer(), np.uint8)
                again[here] = np.unpackbits(raw, count=here.stop - here.start)
            wanted = np.append(cell[again], -1)  # never a cell, so that an empty list can be asked
            mine = cells(windows[hit], row, bits)
            hit = hit[wanted[np.searchsorted(wanted[:-1], mine)] == mine]
        edges = np.cumsum([0, *[len(key) for *_, key in parts]])
        found = []
        base = 0
        for (part, w, begin, _), low, high in zip(parts, edges[:-1], edges[1:], strict=True):
            mine = hit[np.searchsorted(hit, low) : np.searchsorted(hit, high)] - low
            begin = begin[mine]
            second, hashes = np.zeros(len(begin), np.uint64), w.hashes(1)
            for j in range(k):
                second = second * np.uint64(0xD1342543DE82EF95) + hashes[begin + j]
            doc = np.searchsorted(w.first, begin, "right") - 1
            found.append((base + doc, begin - w.first[doc], (bytewords.mixed(second) >> np.uint64(48)).astype(np.uint16)))
            base += part.num_rows
        doc, pos, second = (joined_up([f[i] for f in found], t) for i, t in enumerate((np.int64, np.int64, np.uint16)))
        high = windows[hit]
        docs = pa.Table.from_batches([part for part, *_ in parts], chunk.schema).combine_chunks()
        rank = pc.rank(docs.column("doc_id"), tiebreaker="dense").to_numpy()[doc].astype(np.int64)
        order = np.lexsort((rank, second, high))
        new = np.ones(len(order), bool)
        new[1:] = (high[order][1:] != high[order][:-1]) | (second[order][1:] != second[order][:-1])
        least = rank[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        sure = np.empty(len(order), bool)
        sure[order] = rank[order] > least
        # windows come in the order of documents and places
        after = np.zeros(len(order), bool)
        after[1:] = sure[1:] & sure[:-1] & (doc[1:] == doc[:-1]) & (pos[1:] == pos[:-1] + 1)
        heads = np.flatnonzero(~after)
        run = np.diff(np.append(heads, len(order)))
        sure, doc, pos, high, second = sure[heads], doc[heads], pos[heads], high[heads], second[heads]
        spread = bytewords.mixed(high + pos.astype(np.uint64) + (doc.astype(np.uint64) << np.uint64(32)))
        taken = docs.select(["doc_id", "tag"]).take(pa.array(doc))
        tag = taken["tag"].to_numpy().view(np.uint16).astype(np.uint32)
        return pa.table(
            {
                "high": pa.array(np.where(sure, spread, high).view(np.int64)),
                "doc_id": taken["doc_id"],
                "marks": pa.array((second.astype(np.uint32) << np.uint32(16) | tag).view(np.int32)),
                "at": pa.array(pos << 32 | np.where(sure, run, 0)),
            }
        )

    return (
        rows.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(probed, f"high long, doc_id {kind}, marks int, at long")
    )


def chunk_of(chunks: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "tag"), F.lit(chunks)).alias("chunk")


def chunked(docs: DataFrame, chunks: int) -> DataFrame:
    """doc_id, text, a short tag of the text, which tells texts apart that share an id, and the chunk."""
    tagged = docs.select("doc_id", "text", F.shiftright(F.xxhash64("text"), 48).cast("short").alias("tag"))
    return tagged.select("*", chunk_of(chunks))


def later_windows(rows: DataFrame, k: int, bits: int, segment: int, chunks: int) -> DataFrame:
    """(doc_id, tag, at, chunk): the windows from place ``at >> 32`` on, one or as many as its low half says, whose words also
    start in documents with smaller ids."""
    found = candidates(rows, repeated_cells(rows, k, bits, segment), k, bits, segment)
    # few wide columns cross the exchange; they are taken apart behind it
    apart = found.repartition("high").withColumns(
        {"low": F.shiftright("marks", 16), "sure": F.col("at").bitwiseAND(0xFFFFFFFF) > 0}
    )
    # sorted and streamed: no group is held in memory
    first = F.first("doc_id").over(
        Window.partitionBy("high", "low", "sure").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0)
    )
    later = apart.withColumn("first_id", first).where("sure or doc_id > first_id")
    tag = F.shiftright(F.shiftleft("marks", 16), 16).cast("short").alias("tag")
    return later.select("doc_id", tag, "at").select("*", chunk_of(chunks))


def substring_dedup(docs: DataFrame, k: int = K, segment: int = SEGMENT, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text, the words left joined by one space, for each row."""
    bits, chunks = plan(docs, segment, chunk_bytes)
    rows = chunked(docs, chunks)
    places = later_windows(rows, k, bits, segment, chunks)
    kind = dict(docs.dtypes)["doc_id"]

    def left_over(chunk: pa.Table, places: pa.Table) -> pa.Table:
        cut = places.group_by(["doc_id", "tag"]).aggregate([("at", "list")])
        cuts = dict(zip(zip(cut["doc_id"].to_pylist(), cut["tag"].to_pylist()), cut["at_list"], strict=True))
        n_words, n_removed, kept = [], [], []
        for batch in chunk.to_batches():
            ids, tags = batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist()
            for doc_id, tag, text in zip(ids, tags, batch.column("text").cast(pa.binary()), strict=True):
                words = (text.as_py() or b"").split()  # bytes split at the six ASCII white characters
                n_words.append(len(words))
                if (doc_id, tag) in cuts:
                    begin, run = np.divmod(np.asarray(cuts[doc_id, tag].values), 1 << 32)
                    run = np.maximum(run, 1)
                    change = np.bincount(begin, minlength=len(words) + 1)
                    change -= np.bincount(begin + run + k - 1, minlength=len(words) + 1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
        return pa.table(
            {
                "doc_id": chunk["doc_id"],
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept_text": pa.array(kept, pa.string()),
            }
        )

    return (
        rows.groupBy("chunk")
        .cogroup(places.groupBy("chunk"))
        .applyInArrow(left_over, f"doc_id {kind}, n_words long, n_removed long, kept_text string")
    )
