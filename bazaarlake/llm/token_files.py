"""Token-id files with Re-Pair grammar compression.

Ids are gathered in ascending id order into shards of about ``SHARD_IDS``. In a shard the most frequent pairs of
neighbouring symbols become new symbols, round after round, until no pair occurs ``LEAST_COUNT`` times. A round takes many pairs at once, such that no symbol is the
left part of one and the right part of another, so that their places can't overlap; runs of one symbol are paired from
their start. A shard stores the rules, the expansion length of every new symbol, the compressed symbols and the length of each
document. The lengths tell where a document begins among the symbols, so one can be read without expanding the rest.

File format: Parquet rows (part, number, doc_ids, doc_tokens, n_ids, payload) in ascending id order. The payload is
``REPAIR1`` and, as little-endian unsigned 32-bit numbers: first new symbol, number of rules, number of symbols; then the
rules (left, right), the expansion lengths and the symbols.

Defined results: null or empty text has the end id only; a null id comes first; rows with one id stay apart, in the order
of their texts; other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlake.llm import tokens

MAGIC = b"REPAIR1\x00"
#: Ids of a shard, about: a document is never cut.
SHARD_IDS = 2_000_000
RULES_A_ROUND = 2048
LEAST_COUNT = 16
#: Pairs are counted in so many buckets at first, and exactly in the fullest ones.
BUCKET_BITS = 18
CANDIDATES = 3 * RULES_A_ROUND
#: New symbols start here, above all ids of a vocabulary.
FIRST_SYMBOL = 1 << 18


@dataclass
class Grammar:
    base: int  # the first symbol that is a rule's
    rules: np.ndarray  # (n, 2)
    lengths: np.ndarray  # expansion length of each rule
    symbols: np.ndarray

    def size_of(self, symbols: np.ndarray) -> np.ndarray:
        all_sizes = np.ones(len(symbols), np.int64)
        new = symbols >= self.base
        all_sizes[new] = self.lengths[symbols[new] - self.base]
        return all_sizes

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Short rules are expanded once, into a table from which all their places are filled. It has no more ids than there are symbols."""
        if not len(self.lengths):
            return symbols
        ordered = np.sort(self.lengths)
        fit = int(np.searchsorted(np.cumsum(ordered), len(symbols), "right"))
        longest = int(ordered[fit] - 1 if fit < len(ordered) else ordered[-1])
        symbols = self._by_steps(symbols, longest)
        short = np.flatnonzero(self.lengths <= longest)
        table = self._by_steps((self.base + short).astype(np.uint32), 1)
        first = np.zeros(len(self.lengths), np.int64)
        first[short] = np.cumsum(self.lengths[short]) - self.lengths[short]
        size, new = self.size_of(symbols), symbols >= self.base
        begin = len(table) + np.arange(len(symbols))
        begin[new] = first[symbols[new] - self.base]
        at = np.cumsum(size) - size
        return np.concatenate([table, symbols])[np.repeat(begin - at, size) + np.arange(int(size.sum()))]

    def _by_steps(self, symbols: np.ndarray, longest: int) -> np.ndarray:
        """Symbols with every rule replaced by its pair, step by step, until none stands for more ids than ``longest``."""
        while len(symbols):
            new = self.size_of(symbols) > longest
            if not new.any():
                break
            n = np.where(new, 2, 1)
            at = np.cumsum(n) - n
            out = np.empty(int(n.sum()), np.uint32)
            out[at[~new]] = symbols[~new]
            pairs = self.rules[symbols[new] - self.base]
            out[at[new]], out[at[new] + 1] = pairs[:, 0], pairs[:, 1]
            symbols = out
        return symbols

    def read(self, begin: int, end: int) -> np.ndarray:
        """Ids from begin to end: only the symbols that hold them are expanded."""
        edge = np.concatenate([[0], np.cumsum(self.size_of(self.symbols))])
        i, j = np.searchsorted(edge, begin, "right") - 1, np.searchsorted(edge, end, "left")
        return self.expand(self.symbols[i:j])[begin - edge[i] : end - edge[i]]

    def to_bytes(self) -> bytes:
        head = struct.pack("<3I", self.base, len(self.rules), len(self.symbols))
        return b"".join([MAGIC, head, *(x.astype("<u4").tobytes() for x in (self.rules, self.lengths, self.symbols))])

    @staticmethod
    def from_bytes(raw: bytes) -> Grammar:
        if raw[: len(MAGIC)] != MAGIC:
            raise ValueError("not a shard of token ids")
        base, rules, symbols = struct.unpack_from("<3I", raw, len(MAGIC))
        x = np.frombuffer(raw, "<u4", offset=len(MAGIC) + 12)
        if len(x) != 3 * rules + symbols:
            raise ValueError("a shard of token ids is cut off")
        return Grammar(base, x[: 2 * rules].reshape(-1, 2), x[2 * rules : 3 * rules].astype(np.int64), x[3 * rules :])


def chosen_pairs(left: np.ndarray, right: np.ndarray, n_symbols: int) -> list[int]:
    """Numbers of the pairs to replace, of pairs in order of preference."""
    role = bytearray(n_symbols)  # 1: stands left, 2: stands right, 3: both, in a pair of its own
    out = []
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        if a == b:
            if role[a]:
                continue
            role[a] = 3
        else:
            if role[a] not in (0, 1) or role[b] not in (0, 2):
                continue
            role[a], role[b] = 1, 2
        out.append(i)
        if len(out) == RULES_A_ROUND:
            break
    return out


def _bucket(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return ((left * np.uint32(0x9E3779B1) + right * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def compress(ids: np.ndarray, base: int) -> Grammar:
    symbols, rules, lengths = ids.astype(np.uint32), [], np.ones(base, np.int64)
    if len(ids) and int(ids.max()) >= base:
        raise ValueError(f"token ids must be below {base}")
    most = len(symbols)
    while len(symbols) >= 2 * LEAST_COUNT:
        # pairs that share a bucket are counted together first: one of the most frequent pairs lies in one of the fullest
        bucket = _bucket(symbols[:-1], symbols[1:])
        full = np.bincount(bucket, minlength=1 << BUCKET_BITS)
        limit = max(LEAST_COUNT, min(most, int(np.partition(full, -CANDIDATES)[-CANDIDATES])))
        place = np.flatnonzero((full >= limit)[bucket])
        code = symbols[place].astype(np.uint64) << np.uint64(32) | symbols[place + 1]
        ordered = np.sort(code)
        edges = np.flatnonzero(np.concatenate([ordered[:1] == ordered[:1], ordered[1:] != ordered[:-1], [True]]))
        count = np.diff(edges)
        often = np.flatnonzero(count >= limit)
        often = often[np.argsort(-count[often], kind="stable")]
        pairs = ordered[edges[often]]
        n = base + len(rules)
        picked = pairs[chosen_pairs(pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF), n)]
        if not len(picked):
            if limit == LEAST_COUNT:
                break
            most = limit // 2  # the fullest buckets hold rare pairs only: look into more of them
            continue
        # a bucket's pair is found by the bucket: of two in one bucket, the second waits for the next round
        theirs, first = np.unique(_bucket(*(x.astype(np.uint32) for x in (picked >> np.uint64(32), picked))), return_index=True)
        picked = picked[first]
        of_bucket = np.zeros(1 << BUCKET_BITS, np.int32)
        of_bucket[theirs] = np.arange(len(picked))
        which = of_bucket[bucket[place]]
        hit = picked[which] == code
        at, which = place[hit], which[hit]
        # places of different pairs never overlap; in a run of one symbol every second one counts
        starts = np.concatenate([[True], np.diff(at) > 1])
        every = (at - at[starts][np.cumsum(starts) - 1]) % 2 == 0
        at, which = at[every], which[every]
        symbols[at] = (n + which).astype(np.uint32)
        stays = np.ones(len(symbols), bool)
        stays[at + 1] = False
        symbols = symbols[stays]
        both = np.stack([picked >> np.uint64(32), picked & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32)
        lengths = np.concatenate([lengths, lengths[both[:, 0]] + lengths[both[:, 1]]])
        rules.extend(both.tolist())
    return Grammar(base, np.array(rules, np.uint32).reshape(-1, 2), lengths[base:], symbols)


def write_files(
    docs: DataFrame, path: str, vocabulary: str = "byte_bpe_50k.json", end_id: int = 0, special_ids: bool = False
) -> None:
    """Encode every text, append end_id, and write the shards in ascending doc_id order.

    special_ids: whether the string of a special token in a text becomes its id or is ordinary text.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        names, sizes, held = [], [], []

        def out() -> pa.RecordBatch:
            ids = np.concatenate(held)
            payload = compress(ids, FIRST_SYMBOL).to_bytes()
            arrays = [
                pa.array([part], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([pa.concat_arrays(names).to_pylist()], pa.list_(names[0].type)),
                pa.array([np.concatenate(sizes)], pa.list_(pa.int64())),
                pa.array([len(ids)], pa.int64()),
                pa.array([payload], pa.binary()),
            ]
            return pa.record_batch(arrays, ["part", "number", "doc_ids", "doc_tokens", "n_ids", "payload"])

        for rows, ids, edges in tokens.encoded(batches, vocabulary, True, end_id, special_ids):
            begin = 0
            while begin < rows.num_rows:
                room = SHARD_IDS - sum(map(len, held))
                end = max(begin + 1, int(np.searchsorted(edges, edges[begin] + room, "right")) - 1)
                names.append(rows.column("doc_id").slice(begin, end - begin))
                sizes.append(np.diff(edges[begin : end + 1]))
                held.append(ids[edges[begin] : edges[end]])
                begin = end
                if sum(map(len, held)) >= SHARD_IDS or begin < rows.num_rows:
                    yield out()
                    number += 1
                    names, sizes, held = [], [], []
        if held:
            yield out()

    (
        docs.select("doc_id", "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(shards, f"part int, number int, doc_ids array<{kind}>, doc_tokens array<long>, n_ids long, payload binary")
        .write.parquet(path)
    )


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of every document, from the files."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    # ids before a part, then before a shard in its part
    parts = files.groupBy(F.col("part").alias("of_part")).agg(F.sum("n_ids").alias("n"))
    before = parts.select("of_part", (F.sum("n").over(Window.orderBy("of_part")) - F.col("n")).alias("before"))
    in_part = F.sum("n_ids").over(Window.partitionBy("part").orderBy("number")) - F.col("n_ids")
    start = (
        files.select("part", "number", "n_ids")
        .withColumn("within", in_part)
        .join(before, F.col("part") == F.col("of_part"))
        .select(F.col("part").alias("at_part"), F.col("number").alias("at_number"), (F.col("before") + F.col("within")).alias("base"))
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                grammar = Grammar.from_bytes(batch.column("payload")[i].as_py())
                ids = grammar.expand(grammar.symbols).astype("<u4")
                names = batch.column("doc_ids")[i].values
                sizes = np.asarray(batch.column("doc_tokens")[i].values)
                edges = np.concatenate([[0], np.cumsum(sizes)])
                base = batch.column("base")[i].as_py()
                for j in range(0, len(names), 1000):
                    k = min(j + 1000, len(names))
                    raw = [ids[a:b].tobytes() for a, b in zip(edges[j:k], edges[j + 1 : k + 1], strict=True)]
                    arrays = [names.slice(j, k - j), pa.array(base + edges[j:k]), pa.array(sizes[j:k]), pa.array(raw, pa.binary())]
                    yield pa.record_batch(arrays, ["doc_id", "start", "n_tokens", "ids"])

    return (
        files.join(start, (F.col("part") == F.col("at_part")) & (F.col("number") == F.col("at_number")))
        .select("doc_ids", "doc_tokens", "payload", "base")
        .mapInArrow(documents, f"doc_id {kind}, start long, n_tokens long, ids binary")
    )
