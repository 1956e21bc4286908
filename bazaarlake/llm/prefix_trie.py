"""The trie of all conversation prefixes, counted in node tables with minimal perfect hashing.

A node is a distinct sequence of first turns. It is known by a 128-bit digest that is chained turn by turn, so a conversation
is read as a stream and nothing but its last digest is held. Subtrees of bounded size are the shards: a node with more than
``most`` (conversation, depth) rows below it is a *top* node, and a light child of a top node is the root of a subtree that lies
whole in one shard. In a shard the distinct digests get slots from a minimal perfect hash; every lookup is verified by comparing
the digest that is stored at the slot. Counts are scattered into flat arrays by slot and added up through an array of parent
slots, deepest nodes first. The roots' sums then go to the top nodes, which the driver adds up in the same way.

Bounds: top nodes are fewer than ``TOP_NODES`` whatever the input is, since ``most`` rises where the sum of all weights would
allow more; their digests are what is broadcast (6 MB at most). A shard holds about ``SHARD_ROWS`` rows plus at most one subtree
of ``most`` rows. Copies of a conversation, a first turn that a third of all conversations share and the root are top nodes, or are
reduced within each task before the shuffle. The ids of a top node's members are hashed as a stream of pieces, in order, by one task
that holds one piece at a time: SHA-256 is sequential by nature. Turns of one conversation are read by one task, as a stream too.

Odd input: null role and text are empty, null turns come first, equal turns of a conversation are ordered by the SHA-256 of role and
text; repeated rows are turns of their own. Rows with a null conv_id belong to no conversation and are left out. Empty tables give no nodes. Further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.bytewords import flat, mixed
from bazaarlake.llm.tables import written

#: (conversation, depth) rows of a subtree that may lie in one shard, unless that makes too many top nodes.
MOST_ROWS = 1 << 12
TOP_NODES = 1 << 18
#: Rows that a shard is planned for.
SHARD_ROWS = 1 << 19
#: Distinct nodes that a task combines before it sends them on.
COMBINED = 50_000
#: Member ids of a top node in one piece: those with equal id // 4096.
PIECE_BITS = 12

ROOT = bytes(16)
#: SHA-256 of nothing, for nodes at which no conversation ends.
NO_ENDS = hashlib.sha256(b"").hexdigest()

MEMBER, TOP_END, LIGHT_END = 0, 1, 2

CHAIN = "conv_id long, depth long, node binary, parent binary, n_bytes long, below long"
LABELLED = (
    "kind int, root binary, node binary, parent binary, depth long, n_bytes long, n_convs long, conv_id long, parent_conv_id long"
)
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
SHARD_NODES = NODES + ", top binary"
SHAS = "node binary, sha string"


def turn_keys(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, key (half of the SHA-256 of role and text) and the UTF-8 bytes of the text."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    tagged = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.substring(F.unhex(F.sha2(tagged, 256)), 1, 16).alias("key"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )


def sequences(conversations: DataFrame, base: Column | None = None, shared: Column | None = None, most_shared: int = 0) -> DataFrame:
    """The turns of every conversation in order: conv_id, depth, n_turns, key and n_bytes; a row of depth 0 begins each.

    With ``base`` and ``shared`` (columns of conv_id) a conversation is rebuilt: its first ``shared`` turns are those of the
    conversation ``base``, none where that is absent; its own follow behind its first ``shared``. One shuffle of narrow rows
    brings a conversation and those built on it together, sorted; the rows come out with each conversation in one partition,
    in order.
    """
    family = F.col("conv_id") if base is None else base
    shared = F.lit(0) if shared is None else shared
    rows = turn_keys(conversations).withColumn("family", family).repartition("family")
    own = Window.partitionBy("family", "conv_id").orderBy(F.asc_nulls_first("turn"), "key")
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = rows.withColumns({"rank": F.row_number().over(own), "total": F.count("*").over(whole), "shared": shared})
    if most_shared:
        of_base = (F.col("conv_id") == F.col("family")) & (F.col("rank") <= most_shared)
        head = F.collect_list(F.when(of_base, F.struct("rank", "key", "n_bytes"))).over(Window.partitionBy("family"))
        ranked = ranked.withColumn("head", F.slice(F.array_sort(head), 1, F.greatest("shared", F.lit(1))))
        ranked = ranked.withColumn("head", F.when(F.col("shared") > 0, F.col("head")).otherwise(F.slice("head", 1, 0)))
        taken = F.size("head")
        first = F.transform("head", lambda x: F.struct(x["rank"].cast("long").alias("depth"), x["key"], x["n_bytes"]))
    else:
        taken = F.lit(0)
        first = F.array().cast("array<struct<depth:bigint,key:binary,n_bytes:bigint>>")
    start = F.struct(F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("key"), F.lit(0).cast("long").alias("n_bytes"))
    here = F.struct((taken + F.col("rank") - F.col("shared")).cast("long").alias("depth"), "key", "n_bytes")
    none = F.array().cast("array<struct<depth:bigint,key:binary,n_bytes:bigint>>")
    made = F.concat(
        F.when(F.col("rank") == 1, F.concat(F.array(start), first)).otherwise(none),
        F.when(F.col("rank") > F.col("shared"), F.array(here)).otherwise(none),
    )
    n_turns = (taken + F.greatest(F.col("total") - F.col("shared"), F.lit(0))).cast("long").alias("n_turns")
    return ranked.select("conv_id", n_turns, F.inline(made)).sortWithinPartitions("conv_id", "depth")


def _schema(columns: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))])


def _batch(rows: list[tuple], columns: str) -> pa.RecordBatch:
    schema = _schema(columns)
    values = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    for batch in batches:
        yield list(zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "n_turns", "key", "n_bytes")), strict=True))


def _digest(parent: bytes, key: bytes) -> bytes:
    return hashlib.blake2b(parent + key, digest_size=16).digest()


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each prefix, from rows sorted by conversation and depth."""
    node = ROOT
    for rows in _turns(batches):
        out = []
        for conv, depth, n_turns, key, n_bytes in rows:
            parent = node if depth else ROOT
            node = _digest(parent, key) if depth else ROOT
            out.append((conv, depth, node, parent, n_bytes, n_turns - depth + 1))
        yield _batch(out, CHAIN)


def _labelled(top: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Members of light nodes, combined, and where conversations end, each with the root of its subtree."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs: dict[bytes, int] = top.value
        node, root, parent_conv = ROOT, None, None
        members: dict[bytes, list] = {}
        ends: list[tuple] = []

        def out() -> pa.RecordBatch:
            rows = [(MEMBER, m[0], d, *m[1:]) for d, m in members.items()]
            rows += [(kind, r, d, None, None, None, None, c, None) for kind, r, d, c in ends]
            members.clear()
            ends.clear()
            return _batch(rows, LABELLED)

        for rows in _turns(batches):
            for conv, depth, n_turns, key, n_bytes in rows:
                parent = node
                if depth:
                    node = _digest(parent, key)
                else:
                    node, parent, root, parent_conv = ROOT, ROOT, None, None
                if root is None and node not in convs:
                    root, parent_conv = node, convs[parent]
                if root is not None:
                    known = members.get(node)
                    if known is None:
                        members[node] = [root, parent, depth, n_bytes, 1, conv, parent_conv if node == root else None]
                    else:
                        known[4] += 1
                        known[5] = min(known[5], conv)
                if depth == n_turns:
                    ends.append((TOP_END if root is None else LIGHT_END, root or node, node, conv))
            if len(members) + len(ends) > COMBINED:
                yield out()
        yield out()

    return label


def two_words(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """16-byte values as two columns of 64-bit numbers."""
    raw, _ = flat(column.combine_chunks())
    words = raw.copy().view(np.uint64).reshape(-1, 2)
    return words[:, 0], words[:, 1]


class SlotTable:
    """A minimal perfect hash of distinct 128-bit digests, n of them onto slots 0 to n - 1.

    Level by level the digests that are not placed yet are hashed into cells, twice as many as there are digests; one that is
    alone in its cell keeps it, and its slot is the number of kept cells before it. ``find`` compares the digest that is
    stored at the slot, so a digest that is not in the table is never taken for another.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        n, placed = len(high), 0
        slots = np.full(n, -1, np.int64)
        left = np.arange(n)
        while len(left):
            cell = self.cells(high[left], low[left], len(self.levels), 2 * len(left) + 1)
            alone = np.bincount(cell, minlength=2 * len(left) + 1) == 1
            slot_of = np.cumsum(alone) - 1 + placed
            self.levels.append((alone, slot_of))
            kept = alone[cell]
            slots[left[kept]] = slot_of[cell[kept]]
            placed += int(kept.sum())
            left = left[~kept]
            if len(self.levels) > 500:
                raise ValueError("digests repeat")
        self.high, self.low = np.empty(n, np.uint64), np.empty(n, np.uint64)
        self.high[slots], self.low[slots] = high, low

    @staticmethod
    def cells(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64(2 * level + 1)
        return (mixed(high * seed ^ mixed(low + seed)) % np.uint64(size)).astype(np.int64)

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 where the table does not hold it."""
        found = np.full(len(high), -1, np.int64)
        left = np.arange(len(high))
        for level, (alone, slot_of) in enumerate(self.levels):
            cell = self.cells(high[left], low[left], level, len(alone))
            here = alone[cell]
            slot, rows = slot_of[cell[here]], left[here]
            same = (self.high[slot] == high[rows]) & (self.low[slot] == low[rows])
            found[rows[same]] = slot[same]
            left = left[~here]
        return found


def accumulated(parent: np.ndarray, depth: np.ndarray, leaves: np.ndarray, saved: np.ndarray) -> None:
    """Add each node's leaves and savings to its parent's, deepest nodes first; parent -1 is outside."""
    order = np.argsort(-depth, kind="stable")
    edges = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, edges):
        inner = level[parent[level] >= 0]
        np.add.at(leaves, parent[inner], leaves[inner])
        np.add.at(saved, parent[inner], saved[inner])


def _sha_of(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard."""
    parts = [batch for batch in batches if batch.num_rows]
    if not parts:
        return
    rows = pa.Table.from_batches(parts)
    kind = rows["kind"].to_numpy()
    members, ends = rows.filter(pa.array(kind == MEMBER)), rows.filter(pa.array(kind == LIGHT_END))
    high, low = two_words(members["node"])
    order = np.lexsort((low, high))
    new = np.concatenate([[True], (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)])
    table = SlotTable(high[order[new]], low[order[new]])
    n = len(table.high)
    slot = table.find(high, low)

    n_convs = np.zeros(n, np.int64)
    np.add.at(n_convs, slot, members["n_convs"].to_numpy())
    conv = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(conv, slot, members["conv_id"].to_numpy())
    depth, n_bytes, parent = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
    depth[slot] = members["depth"].to_numpy()
    n_bytes[slot] = members["n_bytes"].to_numpy()
    parent[slot] = table.find(*two_words(members["parent"]))
    outside = np.full(n, -1, np.int64)  # row of a root, which has its parent's digest and conversation
    row = np.flatnonzero(parent[slot] < 0)
    outside[slot[row]] = row

    children = np.bincount(parent[parent >= 0], minlength=n)
    leaves = (children == 0).astype(np.int64)
    saved = (n_convs - 1) * n_bytes
    accumulated(parent, depth, leaves, saved)

    shas = np.full(n, NO_ENDS, object)
    if ends.num_rows:
        at, ids = table.find(*two_words(ends["node"])), ends["conv_id"].to_numpy()
        order = np.lexsort((ids, at))
        at, ids = at[order], ids[order]
        for group in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at)) + 1):
            shas[at[group[0]]] = _sha_of(ids[group])

    inside = parent >= 0
    tops = np.full(n, None, object)
    tops[~inside] = members["parent"].take(pa.array(outside[~inside])).to_pylist()
    parent_conv = conv[parent]
    parent_conv[~inside] = members["parent_conv_id"].take(pa.array(outside[~inside])).to_numpy()
    out = [conv, depth, parent_conv, n_convs, children, leaves, saved]
    columns = [*[pa.array(x, pa.int64()) for x in out], pa.array(shas, pa.string()), pa.array(tops, pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, schema=_schema(SHARD_NODES))


def _streamed_shas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's member ids, from pieces sorted by node and place."""
    node, sha = None, None
    for batch in batches:
        found = []
        for its, piece in zip(batch.column("node").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if its != node:
                if node is not None:
                    found.append((node, sha.hexdigest()))
                node, sha = its, hashlib.sha256(piece.encode())
            else:
                sha.update(b"," + piece.encode())
        yield _batch(found, SHAS)
    if node is not None:
        yield _batch([(node, sha.hexdigest())], SHAS)


def _top_ends(ends: DataFrame) -> DataFrame:
    place = F.shiftright("conv_id", PIECE_BITS).alias("place")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    pieces = ends.groupBy("node", place).agg(ids.alias("piece"))
    in_order = pieces.repartition("node").sortWithinPartitions("node", "place").select("node", "piece")
    return in_order.mapInArrow(_streamed_shas, SHAS)


def prefix_trie(turns: DataFrame, most: int = MOST_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Every node of the trie of ``sequences``: its smallest member, depth, parent, members, children, leaves below,
    saved bytes below, and the hash of the members that end there."""
    spark = turns.sparkSession
    weights = turns.agg(F.sum(F.col("n_turns") - F.col("depth") + 1), F.count("*")).first()
    total, n_rows = weights[0] or 0, weights[1]
    if not n_rows:
        return spark.createDataFrame([], NODES)
    most = max(most, -(-total // TOP_NODES))

    chain = turns.mapInArrow(_chained, CHAIN)
    sums = chain.groupBy("node", "parent", "depth", "n_bytes").agg(
        F.sum("below").alias("weight"), F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")
    )
    top = sums.where((F.col("weight") > most) | (F.col("depth") == 0)).collect()
    place = {bytes(r.node): i for i, r in enumerate(top)}
    known = spark.sparkContext.broadcast({node: top[i].conv_id for node, i in place.items()})
    labelled = written(turns.mapInArrow(_labelled(known), LABELLED))

    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // shard_rows))
    light = labelled.where(F.col("kind") != TOP_END).repartition(shards, "root").mapInArrow(_counted, SHARD_NODES)
    light = written(light)
    below = light.where("top IS NOT NULL").groupBy("top").agg(F.count("*"), F.sum("n_leaves"), F.sum("saved_tokens")).collect()
    shas = {bytes(r.node): r.sha for r in _top_ends(labelled.where(F.col("kind") == TOP_END)).collect()}

    parent = np.array([place[bytes(r.parent)] if r.depth else -1 for r in top], np.int64)
    depth = np.array([r.depth for r in top], np.int64)
    saved = np.array([(r.n_convs - 1) * r.n_bytes for r in top], np.int64)
    children = np.bincount(parent[parent >= 0], minlength=len(top))
    leaves = np.zeros(len(top), np.int64)
    for node, n, its_leaves, its_saved in below:
        at = place[bytes(node)]
        children[at] += n
        leaves[at] += its_leaves
        saved[at] += its_saved
    leaves[children == 0] = 1
    accumulated(parent, depth, leaves, saved)
    rows = [
        (r.conv_id, r.depth, top[parent[i]].conv_id if r.depth else None, r.n_convs, int(children[i]), int(leaves[i]), int(saved[i]), shas.get(bytes(r.node), NO_ENDS))
        for i, r in enumerate(top)
    ]
    return light.drop("top").unionByName(spark.createDataFrame(rows, NODES))
