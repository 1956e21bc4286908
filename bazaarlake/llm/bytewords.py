"""Words, word hashes and window hashes of many texts at once, with numpy on the bytes of an Arrow column.

All word classes used here end at ASCII bytes only, so they can be found on UTF-8 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text is worked on alone.
SLICE_BYTES = 2_000_000

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32

#: Words of up to so many bytes are hashed eight bytes at a time, all words at once; longer ones by BLAKE2b.
LONGEST = 64
#: Byte masks of words that end within eight bytes.
MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
FACTOR = np.array([0x9E3779B97F4A7C15, 0xD1342543DE82EF95], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and the n + 1 places where they begin. Null counts as empty."""
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about limit bytes of text, one row at least."""
    _, at = flat(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + limit, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


@dataclass
class Words:
    raw: np.ndarray  # bytes of all texts
    at: np.ndarray  # where each text begins, and the end
    start: np.ndarray  # of each word, in raw
    end: np.ndarray
    count: np.ndarray  # words of each text
    first: np.ndarray  # number of the first word of each text, and the number of all words

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes; which chooses one of two that have nothing in common but the input."""
        length = self.end - self.start
        if not len(length):
            return np.zeros(0, np.uint64)
        padded = np.concatenate([self.raw, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(self.raw) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
        h = mixed(length.astype(np.uint64) * FACTOR[which] + np.uint64(which + 1))
        todo = np.flatnonzero(length <= LONGEST)
        for k in range(0, LONGEST, 8):
            left = length[todo] - k
            part = eight[self.start[todo] + k] & MASK[np.minimum(left, 8)]
            h[todo] = mixed((h[todo] + part) * FACTOR[1]) if which else mixed(h[todo] ^ part)
            todo = todo[left > 8]
            if not len(todo):
                break
        for i in np.flatnonzero(length > LONGEST).tolist():
            digest = hashlib.blake2b(self.raw[self.start[i] : self.end[i]], digest_size=16).digest()
            h[i] = np.frombuffer(digest, np.uint64)[which]
        return h


def words(column: pa.Array, lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text; lower turns A-Z into a-z first."""
    raw, at = flat(column)
    if lower:
        raw = TO_LOWER[raw]
    n = len(raw)
    inside = ~WHITE[raw]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before = np.concatenate([[False], inside[:-1]]) if n else inside
    starts = inside & (~before | edge[:n])
    after = np.concatenate([inside[1:], [False]]) if n else inside
    ends = inside & (~after | edge[1:])
    seen = np.zeros(n + 1, np.int64)
    np.cumsum(starts, out=seen[1:])
    return Words(raw, at, np.flatnonzero(starts), np.flatnonzero(ends) + 1, seen[at[1:]] - seen[at[:-1]], seen[at])


def windows(w: Words, hashes: np.ndarray, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Number of the first word, and a 64-bit hash, of each run of k words that lies in one text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    left = np.repeat(w.first[1:], w.count) - np.arange(len(hashes))  # words from here to the text's end
    begin = np.flatnonzero(left[:n] >= k)
    factor = int(mixed(np.array([2 * seed + 1], np.uint64))[0]) | 1
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * np.uint64(factor) + hashes[j : j + n]
    return begin, mixed(total[begin] + np.uint64(k))
