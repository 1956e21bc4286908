"""Packing of examples into training sequences: vector bin packing by dot products.

A sequence has three limits: ids, segments (pieces), and ids that bear loss. Each task packs the rows of its partition in one
pass with a fixed number of open sequences. An example's full stretches of ``MAX_TOKENS`` become sequences of their own;
the rest goes whole into the open sequence that it fits and whose room, weighted by limit, has the largest dot product
with it. If it fits none, it opens a new one, or is cut to fill the one with the largest dot product. A sequence is closed
when it is full. At the end of a partition the short sequences fill each other up; what is left then, or was stopped by
another limit than that of ids, is cut into lengths that are powers of two, which need no padding. So no sequence is padded.

``loss_from`` names a column with the first id of the example that bears loss (a prompt's length); without it all ids do.

Defined results: null or empty text has the end id only; rows with one id are packed each for itself; a null id is
carried along; a null or negative ``loss_from`` is 0; other columns are ignored, whatever their names; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm import tokens

MAX_TOKENS = 2048
MAX_SEGMENTS = 128
MAX_LOSS = 2048
OPEN = 64

COLUMNS = ["doc_id", "start", "ids", "doc_tokens", "loss", "sequence_id", "offset"]


@dataclass
class Piece:
    row: object  # what the caller knows the example by
    start: int
    ids: np.ndarray
    doc_tokens: int
    loss_from: int

    @property
    def loss(self) -> int:
        return max(0, self.start + len(self.ids) - max(self.start, self.loss_from))

    def cut(self, n: int) -> tuple[Piece, Piece]:
        rest = Piece(self.row, self.start + n, self.ids[n:], self.doc_tokens, self.loss_from)
        return Piece(self.row, self.start, self.ids[:n], self.doc_tokens, self.loss_from), rest

    def longest(self, room_tokens: int, room_loss: int) -> int:
        """How many of its first ids fit."""
        without = max(0, min(len(self.ids), self.loss_from - self.start))
        return min(len(self.ids), room_tokens, without + room_loss)


@dataclass
class Packer:
    limits: np.ndarray
    n_open: int = OPEN
    pieces: list[list[Piece]] = field(default_factory=list)
    room: np.ndarray | None = None  # of each open sequence: ids, segments, ids that bear loss

    def __post_init__(self) -> None:
        self.room = np.zeros((0, 3), np.int64)

    def put(self, at: int, piece: Piece) -> None:
        self.pieces[at].append(piece)
        self.room[at] -= (len(piece.ids), 1, piece.loss)

    def take(self, at: int) -> list[Piece]:
        self.room = np.delete(self.room, at, axis=0)
        return self.pieces.pop(at)

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Place an example; yields the sequences that are closed by it."""
        while len(piece.ids):
            most = piece.longest(int(self.limits[0]), int(self.limits[2]))
            if most == self.limits[0]:
                head, piece = piece.cut(most)
                yield [head]
                continue
            need = np.array([len(piece.ids), 1, piece.loss])
            closeness = (self.room / self.limits) @ (need / self.limits)
            fits = (self.room >= need).all(axis=1)
            if fits.any():
                at = int(np.argmax(np.where(fits, closeness, -1.0)))
                head, piece = piece, piece.cut(len(piece.ids))[1]
            elif len(self.pieces) < self.n_open:
                self.pieces.append([])
                self.room = np.vstack([self.room, self.limits])
                at = len(self.pieces) - 1
                head, piece = piece.cut(most)
            else:
                at = int(np.argmax(closeness))
                n = piece.longest(int(self.room[at][0]), int(self.room[at][2]))
                if not n or not self.room[at][1]:
                    yield from self.closed(self.take(at))
                    continue
                head, piece = piece.cut(n)
            self.put(at, head)
            if not self.room[at][:2].all():
                yield from self.closed(self.take(at))

    def closed(self, pieces: list[Piece]) -> Iterator[list[Piece]]:
        """A sequence, or several whose lengths are powers of two."""
        left = sum(len(p.ids) for p in pieces)
        while left:
            size = min(int(self.limits[0]), 1 << (left.bit_length() - 1))
            left -= size
            out = []
            while size:
                head, rest = pieces[0].cut(min(size, len(pieces[0].ids)))
                size -= len(head.ids)
                out.append(head)
                pieces = [rest, *pieces[1:]] if len(rest.ids) else pieces[1:]
            yield out

    def end(self) -> Iterator[list[Piece]]:
        """Close all: the shortest sequence is dealt out to the others as long as they take it."""
        while self.pieces:
            pieces = self.take(int(np.argmax(self.room[:, 0])))
            while pieces:
                n = np.array([pieces[0].longest(int(t), int(x)) if s else 0 for t, s, x in self.room], np.int64)
                if not n.any():
                    yield from self.closed(pieces)
                    break
                into = int(np.argmax(n))
                head, rest = pieces[0].cut(int(n[into]))
                pieces = [rest, *pieces[1:]] if len(rest.ids) else pieces[1:]
                self.put(into, head)
                if not self.room[into][:2].all():
                    yield from self.closed(self.take(into))


def pack(
    docs: DataFrame,
    vocabulary: str = "word_bpe_49k.json",
    end_id: int = 1,
    loss_from: str | None = None,
    max_tokens: int = MAX_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int = MAX_LOSS,
    special_ids: bool = False,
) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, loss, sequence_id, offset of each piece.

    special_ids: whether the string of a special token in a text becomes its id or is ordinary text.
    """
    kind = dict(docs.dtypes)["doc_id"]
    first_loss = F.greatest(F.lit(0), F.coalesce(F.col(loss_from), F.lit(0))) if loss_from else F.lit(0)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(np.array([max_tokens, max_segments, max_loss], np.int64))
        number = TaskContext.get().partitionId() << 36
        out: list[list] = [[] for _ in COLUMNS]
        id_type = None

        def batch_of() -> pa.RecordBatch:
            arrays = [pa.array(out[0], id_type), *(pa.array(x) for x in out[1:])]
            for x in out:
                x.clear()
            return pa.record_batch(arrays, COLUMNS)

        def keep(sequences: Iterator[list[Piece]]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            for pieces in sequences:
                offset = 0
                for p in pieces:
                    values = (p.row, p.start, p.ids.astype("<u4").tobytes(), p.doc_tokens, p.loss, number, offset)
                    for x, value in zip(out, values, strict=True):
                        x.append(value)
                    offset += len(p.ids)
                number += 1
                if len(out[0]) >= 2000:
                    yield batch_of()

        for rows, ids, edges in tokens.encoded(batches, vocabulary, False, end_id, special_ids):
            id_type = rows.column("doc_id").type
            names, from_ = rows.column("doc_id").to_pylist(), rows.column("first_loss").to_pylist()
            for i, name in enumerate(names):
                own = ids[edges[i] : edges[i + 1]].copy()
                yield from keep(packer.add(Piece(name, 0, own, len(own), from_[i])))
        yield from keep(packer.end())
        if out[0]:
            yield batch_of()

    return (
        docs.select("doc_id", "text", first_loss.cast("long").alias("first_loss"))
        .mapInArrow(
            packed,
            f"doc_id {kind}, start long, ids binary, doc_tokens long, loss long, sequence_id long, offset long",
        )
        .withColumn("length", (F.octet_length("ids") / 4).cast("long"))
    )
