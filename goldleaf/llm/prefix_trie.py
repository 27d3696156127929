"""Prefix trie of conversations: shared turn prefixes, and the tokens that sharing saves.

A conversation is the sequence of its turns' digests (16 bytes each), so that sorting
(sequence, conv_id) puts the members of every node next to each other, a node before its
descendants and equal conversations by id.  The order is cut into shards by splitters, taken
from a bounded sample.  A node can have members in two shards only if it lies on the path
of a splitter: the splitters' trie, the skeleton, is broadcast.  Each shard is walked once in
order with a stack of open nodes; nodes off the skeleton are finished there, nodes on it
give partial counts, which a grouping adds up.  Subtree sums inside the skeleton are a
second grouping over each skeleton node's ancestors.

Bounds: splitters are at most SPLITTERS paths of a sample (SAMPLE rows a shard), each cut to
SPLITTER_TURNS turns, so the skeleton has at most SPLITTERS * SPLITTER_TURNS nodes, whatever
the corpus; a cut path is still a valid splitter.  Equal conversations are split by conv_id among shards, so one that holds a third
of all rows, or a first turn that does, is no larger a task than another (save for equal
conversations of more than SPLITTER_TURNS turns, which share a shard: more time, not more
memory, as a walk holds one path).  The ids that end at a skeleton node are hashed in order
from pieces of bounded size, as SHA-256 has no other way.  The digests of one conversation
(20 bytes a turn) must fit in a row.

Turns are ordered by turn (null first), equal turns by role, then by their digest; a repeated
row is a turn of its own.  Null roles and texts are empty.  Rows with a null conv_id belong
to no conversation and are left out.  A table without conversations gives no nodes.  Only
conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import hash_share, stored

#: Bytes of a turn's digest.
WIDTH = 16
#: Rows sampled for each shard, turns kept of a splitter, and splitters at most.
SAMPLE, SPLITTER_TURNS, SPLITTERS = 16, 64, 4096
#: Characters of ids in a piece of a skeleton node's end list.
PIECE = 1 << 16

ROOT_HASH = hashlib.sha256(b"").hexdigest()
NODES = "shard int, pre bigint, depth int, skeleton bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, chars bigint, ends_sha256 string, ends string"
_NODE_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), *[pa.int64()] * 6, pa.string(), pa.string()]


# --- conversations as sequences ------------------------------------------------

def _size(text: Column) -> Column:
    return F.octet_length(text).cast("string")


def sequences(turns: DataFrame, block: int = 100) -> DataFrame:
    """conv_id, base (conv_id - conv_id % block) and ts, the turns in order as (digest hex, code points of the text).

    Rows are dealt by base, and the grouping keeps that; texts stay behind the digest.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(_size(role), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    conv = F.col("conv_id").cast("long")
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        conv.alias("conv_id"), (conv - conv % block).alias("base"), F.struct("turn", role.alias("role"), digest.alias("d"), F.length(text).alias("n")).alias("t"))
    out = rows.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return out.withColumn("ts", F.transform("ts", lambda t: F.struct(t["d"].alias("d"), t["n"].alias("n"))))


def rebuilt(turns: DataFrame, block: int = 100, heads: int = 6) -> DataFrame:
    """conv_id and ts of every conversation with its first turns replaced by those of its block's first one.

    The first h turns of conversation conv_id - conv_id % block, then its own turns after
    its first h; h is crc32(conv_id) % heads.  % takes the sign of conv_id.
    """
    own = sequences(turns, block)
    first = own.where(F.col("conv_id") == F.col("base")).select("base", F.slice("ts", 1, heads - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    head = F.slice(F.coalesce("head", F.array().cast(own.schema["ts"].dataType)), F.lit(1), h)
    rest = F.slice("ts", h + 1, F.greatest(F.size("ts"), F.lit(1)))
    return own.join(first, "base", "left").select("conv_id", F.concat(head, rest).alias("ts"))


# --- splitters and their trie ---------------------------------------------------

def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common from the start."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    if a[:high * WIDTH] == b[:high * WIDTH]:
        return high
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid * WIDTH] == b[:mid * WIDTH]:
            low = mid
        else:
            high = mid - 1
    return low


class Skeleton:
    """The sorted splitters (path, conv_id) and the trie of their paths.

    A skeleton node is (first splitter whose path goes through it, depth), as one long;
    `inner` are those with a child in the trie.  Splitters are paths of rows, so each node has members.
    """

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = sorted(set(splitters))
        self.first: list[np.ndarray] = []
        for i, (path, _) in enumerate(self.splitters):
            own = np.full(len(path) // WIDTH + 1, i, np.int64)
            own[0] = 0
            if i:
                same = _shared(self.splitters[i - 1][0], path)
                own[:same + 1] = self.first[-1][:same + 1]
            self.first.append(own)
        self.inner = {self.node(i, d) for i, own in enumerate(self.first) for d in range(len(own) - 1)}

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))

    def along(self, path: bytes, shard: int) -> list[int]:
        """Ids of the skeleton nodes on the path of a row of the shard, from the root."""
        best, depth = None, -1
        for i in (shard - 1, shard):
            if 0 <= i < len(self.splitters) and (d := _shared(path, self.splitters[i][0])) > depth:
                best, depth = i, d
        return [0] if best is None else [self.node(best, d) for d in range(depth + 1)]

    def node(self, splitter: int, depth: int) -> int:
        return int(self.first[splitter][depth]) * (SPLITTER_TURNS + 1) + depth

    def ancestors(self, node: int) -> list[int]:
        """Ids from the root down to the node itself."""
        splitter, depth = divmod(node, SPLITTER_TURNS + 1)
        return [self.node(splitter, d) for d in range(depth + 1)] if self.splitters else [0]


def skeleton_of(paths: DataFrame, shards: int) -> Skeleton:
    """Splitters at even ranks of a bounded sample; they decide speed, never the result."""
    shards = min(shards, SPLITTERS + 1)
    cut = F.substring("path", 1, WIDTH * SPLITTER_TURNS)
    rows = hash_share(paths, F.col("conv_id"), SAMPLE * shards).select(cut.alias("path"), "conv_id").collect()
    rows = sorted((bytes(r["path"]), r["conv_id"]) for r in rows)
    return Skeleton([rows[k * len(rows) // shards] for k in range(1, shards)] if rows else [])


# --- the walk of a shard -----------------------------------------------------------

class _Node:
    __slots__ = ("chars", "children", "conv", "count", "ends", "hash", "leaves", "low", "piece", "pre", "saved", "skeleton")

    def __init__(self, pre: int, skeleton: int | None, chars: int):
        self.pre, self.skeleton, self.chars = pre, skeleton, chars
        self.low: int | None = None
        self.count = self.children = self.leaves = self.saved = self.ends = 0
        self.hash = None
        self.piece: list[str] = []


class Walk:
    """Rows of shards in order of (shard, path, conv_id) -> rows of NODES.

    A node off the skeleton gives one finished row.  A node on it gives rows with its id in
    `skeleton`: pieces of its end list (`ends`, under their smallest conv_id), and one with the
    sums over its members and its children off the skeleton.  `pre` numbers a shard's nodes
    parents first.
    """

    def __init__(self, skeleton: Skeleton):
        self.skeleton = skeleton
        self.shard: int | None = None
        self.path, self.stack, self.pre = b"", [], 0
        self.out: list[tuple] = []

    def add(self, shard: int, path: bytes, chars: np.ndarray, conv_id: int) -> None:
        if shard != self.shard:
            self.finish()
            self.shard, self.pre = shard, 0
        if not self.stack or path != self.path:
            same = _shared(self.path, path) if self.stack else -1
            while len(self.stack) > same + 1:
                self._close()
            along = self.skeleton.along(path, shard)
            for d in range(len(self.stack), len(path) // WIDTH + 1):
                self.stack.append(_Node(self.pre, along[d] if d < len(along) else None, int(chars[d - 1]) if d else 0))
                self.pre += 1
            self.path = path
        end = self.stack[-1]
        end.count += 1
        end.low = conv_id if end.low is None else min(end.low, conv_id)
        end.ends += 1
        if end.skeleton is None:
            if end.hash is None:
                end.hash = hashlib.sha256(str(conv_id).encode())
            else:
                end.hash.update(f",{conv_id}".encode())
        else:
            if not end.piece:
                end.conv = conv_id
            end.piece.append(str(conv_id))
            if len(end.piece) * 20 >= PIECE:
                self._piece(end)

    def _piece(self, node: _Node) -> None:
        if node.piece:
            self.out.append((self.shard, None, len(self.stack) - 1, node.skeleton, node.conv, *[None] * 6, ",".join(node.piece)))
            node.piece = []

    def _close(self) -> None:
        node = self.stack[-1]
        on = node.skeleton is not None
        if on:
            self._piece(node)
        else:
            node.saved += (node.count - 1) * node.chars
            node.leaves = node.leaves or 1
        ends = None if on else node.hash.hexdigest() if node.hash else ROOT_HASH
        self.out.append((self.shard, node.pre, len(self.stack) - 1, node.skeleton, node.low, node.count, node.children, node.leaves, node.saved, node.chars, ends, None))
        self.stack.pop()
        if self.stack:
            up = self.stack[-1]
            up.count += node.count
            up.low = node.low if up.low is None else min(up.low, node.low)
            if not on:
                up.children += 1
                up.leaves += node.leaves
                up.saved += node.saved

    def finish(self) -> None:
        while self.stack:
            self._close()
        self.path = b""

    def taken(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


def _rows(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names)


_NODE_NAMES = [f.split()[0] for f in NODES.split(", ")]


def _walk(sorted_rows: DataFrame, skeleton: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk(skeleton.value)
        for batch in batches:
            for shard, path, chars, conv_id in zip(*(batch.column(c).to_pylist() for c in ("shard", "path", "chars", "conv_id")), strict=True):
                walk.add(shard, path, chars, conv_id)
                if len(walk.out) >= 4096:
                    yield _rows(walk.taken(), _NODE_TYPES, _NODE_NAMES)
            if walk.out:
                yield _rows(walk.taken(), _NODE_TYPES, _NODE_NAMES)
        walk.finish()
        if walk.out:
            yield _rows(walk.taken(), _NODE_TYPES, _NODE_NAMES)

    return sorted_rows.mapInArrow(run, NODES)


def _parents(nodes: DataFrame) -> DataFrame:
    """Adds to nodes in order of (shard, pre) the parent's conv_id, or its skeleton id where it lies on the skeleton."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[tuple[int | None, int | None]] = []
        for batch in batches:
            conv, on = [], []
            for depth, skeleton, conv_id in zip(*(batch.column(c).to_pylist() for c in ("depth", "skeleton", "conv_id")), strict=True):
                del open_[depth:]
                up = open_[-1] if open_ else (None, None)
                open_.append((conv_id, None) if skeleton is None else (None, skeleton))
                conv.append(up[0])
                on.append(up[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(conv, pa.int64()), pa.array(on, pa.int64())], [*batch.schema.names, "parent", "parent_on"])

    return nodes.mapInArrow(run, f"{NODES}, parent bigint, parent_on bigint")


def _ends(pieces: DataFrame) -> DataFrame:
    """skeleton, ends_sha256: the pieces of each node's end list, in order, through one hash at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for own, text in zip(batch.column("skeleton").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                if own != node:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = own, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if done:
                yield _rows(done, [pa.int64(), pa.string()], ["skeleton", "ends_sha256"])
        if node is not None:
            yield _rows([(node, state.hexdigest())], [pa.int64(), pa.string()], ["skeleton", "ends_sha256"])

    return pieces.repartition("skeleton").sortWithinPartitions("skeleton", "conv_id").mapInArrow(run, "skeleton bigint, ends_sha256 string")


# --- the trie ------------------------------------------------------------------------

RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(chats: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of the trie over `chats` (conv_id, ts as from sequences()); one row each, columns RESULT."""
    spark = chats.sparkSession
    shards = shards or max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = F.unhex(F.array_join(F.transform("ts", lambda t: t["d"]), ""))
    paths = stored(chats.select("conv_id", path.alias("path"), F.transform("ts", lambda t: t["n"]).alias("chars")), "trie-paths")
    skeleton = skeleton_of(paths, shards)
    shared = spark.sparkContext.broadcast(skeleton)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shared.value.shard(p, c) for p, c in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32())], [*batch.schema.names, "shard"])

    dealt = paths.mapInArrow(deal, "conv_id bigint, path binary, chars array<int>, shard int")
    dealt = dealt.repartitionById(len(skeleton.splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    # pieces of end lists have no `pre`; they come first in their shard and change no stack
    nodes = stored(_walk(dealt, shared), "trie-nodes")
    finished = _parents(nodes.where(F.col("pre").isNotNull()).repartitionById(len(skeleton.splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "pre"))
    finished = finished.where(F.col("skeleton").isNull())
    spine = stored(_spine(nodes.where(F.col("skeleton").isNotNull()), shared), "trie-skeleton")
    # at most SPLITTERS * SPLITTER_TURNS rows
    known = F.broadcast(spine.select(F.col("skeleton").alias("parent_on"), F.col("conv_id").alias("on_conv")))
    off = finished.join(known, "parent_on", "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.coalesce("parent", "on_conv").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")
    return off.unionByName(spine.select(*RESULT))


def _spine(partials: DataFrame, skeleton: Broadcast) -> DataFrame:
    """The skeleton's nodes (RESULT and skeleton) from the shards' partial rows."""
    sums = partials.where(F.col("pre").isNotNull()).groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").cast("long").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max("chars").alias("chars"))
    sums = stored(sums, "trie-sums")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # what each node adds to itself and its ancestors; its parent counts it as a child
        for batch in batches:
            for node, convs, children, leaves, saved, chars in zip(*(batch.column(c).to_pylist() for c in ("skeleton", "n_convs", "n_children", "n_leaves", "saved", "chars")), strict=True):
                line = skeleton.value.ancestors(node)
                own = saved + (convs - 1) * chars
                if not children and node not in skeleton.value.inner:
                    leaves = 1
                yield _rows([(a, int(k == len(line) - 2), leaves, own, line[-2] if len(line) > 1 and a == node else None) for k, a in enumerate(line)],
                            [pa.int64()] * 5, ["skeleton", "kids", "leaves", "own", "parent_on"])

    spread_rows = sums.mapInArrow(spread, "skeleton bigint, kids bigint, leaves bigint, own bigint, parent_on bigint")
    totals = spread_rows.groupBy("skeleton").agg(F.sum("kids").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("own").alias("saved_tokens"), F.max("parent_on").alias("parent_on"))
    ends = _ends(partials.where(F.col("pre").isNull()).select("skeleton", "conv_id", "ends"))
    ups = sums.select(F.col("skeleton").alias("parent_on"), F.col("conv_id").alias("parent_conv_id"))
    # all sides hold the skeleton's nodes only
    both = sums.drop("saved", "n_leaves", "chars").join(totals, "skeleton").join(ends, "skeleton", "left").join(ups, "parent_on", "left")
    return both.select("skeleton", "conv_id", "depth", "parent_conv_id", "n_convs", (F.col("n_children") + F.col("kids")).alias("n_children"),
                       F.col("leaves").alias("n_leaves"), "saved_tokens", F.coalesce("ends_sha256", F.lit(ROOT_HASH)).alias("ends_sha256"))
