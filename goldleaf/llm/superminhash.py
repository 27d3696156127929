"""Near-duplicate documents by SuperMinHash signatures, banding, exact verification and union-find.

SuperMinHash (Ertl 2017): element d draws, level by level, the next place of its own random
permutation of the m components and a uniform number r; component p keeps the smallest
level + r.  The correlated places fill every component evenly, so the estimate of the
Jaccard similarity varies less than with independent permutations, and levels stop as soon
as no component can still fall.  All elements of a text take a level at once, which gives
the values of the sequential algorithm.

1. One pass over whole texts: distinct five-word shingles, their number, a 128-bit digest
   of the set and the bands of the signature.
2. Texts with equal sets are one class; only class representatives go on.
3. Representatives that share a band are candidates.  Each bucket's members are compared
   with its leader, not with one another, and the links are closed to components.  A pair
   that could still join two components holds an outsider: a member outside the leader's
   component.  So the outsiders of each bucket then meet all of its members from other
   components.  They do so in streams: a task holds OUTSIDERS outsiders at a time while the
   members pass by, and only links leave it.  A pair is compared in the first bucket that it
   shares, and not where the outsider has a link to that component already.  Large buckets
   are dealt over several tasks on both sides.  So every pair that matters is compared, a
   group of g copies makes about g rows, and no group is held by a task.
4. Links are confirmed on full shingle sets: 100 * intersection >= 75 * union.

A pair at a similarity of exactly 0.75 shares a band with probability
1 - (1 - 0.75 ** ROWS) ** BANDS = 0.9991, at 0.8 with 0.99998, and a group is joined by
many such pairs.

Null or empty texts and texts without words have no shingles and link with nothing, also
not with one another.  Rows that repeat a doc_id each count with their own text.  Rows with
a null doc_id link with nothing and are kept, with a null component.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import components, map_batches, prepare, stored
from goldleaf.llm.words import mix, shingles_of, stream, words_of

BANDS, ROWS = 36, 6
SIZE = BANDS * ROWS
#: Outsiders that a task holds at a time (the mean; they are dealt by hash).
OUTSIDERS = 192
#: Members of one bucket that pass by in one stream.
STREAM = 1024
#: Buckets of the counts that bound a pair's intersection from above.
COUNTS = 512
THRESHOLD = (75, 100)

_DRAW = stream(11, 2 * SIZE)
_BAND = stream(12, BANDS)


def signature(elements: np.ndarray, size: int = SIZE) -> np.ndarray:
    """SuperMinHash of distinct 64-bit elements: level << 32 | 32 random bits, for each component."""
    out = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    n = len(elements)
    if not n:
        return out
    rows = places = None
    for level in range(size):
        draw = mix(elements ^ _DRAW[level])
        pick = (level + (draw & np.uint64(0xFFFFFFFF)) * np.uint64(size - level) // np.uint64(2**32)).astype(np.int64)
        if level == 0:
            first = target = pick
        else:
            if places is None:  # the permutations after level 0, which swapped places 0 and `first`
                rows = np.arange(n)
                places = np.tile(np.arange(size, dtype=np.int16), (n, 1))
                places[rows, first] = 0
                places[:, 0] = first
            target = places[rows, pick]
            places[rows, pick] = places[:, level]
        np.minimum.at(out, target, (draw >> np.uint64(32)) | np.uint64(level << 32))
        if int(out.max()) < (level + 1) << 32:
            break  # later levels are larger
    return out


def band_hashes(sig: np.ndarray) -> np.ndarray:
    acc = _BAND.copy()
    for r in range(ROWS):
        acc = mix(acc ^ sig[r::ROWS])
    return acc.view(np.int64)


def distinct_shingles(column: pa.Array) -> list[np.ndarray]:
    hashes, first = shingles_of(words_of(column))
    return [np.unique(hashes[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest (null for an empty set) and bands of each row."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = distinct_shingles(batch.column(1))
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        bands = np.concatenate([band_hashes(signature(s)) if len(s) else np.zeros(BANDS, np.int64) for s in sets])
        return pa.RecordBatch.from_arrays([
            batch.column(0).cast(pa.int64()), pa.array(list(map(len, sets)), pa.int64()), pa.array(digests, pa.binary()),
            pa.ListArray.from_arrays(pa.array(np.arange(0, len(bands) + 1, BANDS), pa.int32()), pa.array(bands)),
        ], names=["doc_id", "n_shingles", "digest", "bands"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_shingles long, digest binary, bands array<long>")


def counts(shingles: np.ndarray) -> np.ndarray:
    """How many of the shingles fall into each of COUNTS buckets; smaller counts of two sets add up to no less than they share."""
    return np.bincount((shingles >> np.uint64(64 - COUNTS.bit_length() + 1)).astype(np.int64), minlength=COUNTS).astype(np.uint32)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """node (the doc_id), its sorted distinct shingles as a binary value, and its bands."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = distinct_shingles(batch.column(1))
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()), batch.column(2)], names=["node", "shingles", "bands"])

    return map_batches(docs.select("doc_id", "text", "bands"), run, "node long, shingles binary, bands array<long>")


def similar(a: bytes, b: bytes) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    part, whole = THRESHOLD
    if whole * min(len(x), len(y)) < part * max(len(x), len(y)):
        return False
    both = np.sort(np.concatenate([x, y]))
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return whole * common >= part * (len(both) - common)


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) of `pairs` whose sets reach the threshold."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hold = [similar(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        return batch.select([0, 1]).filter(pa.array(hold))

    sets = sets.select("node", "shingles")
    near = (pairs.join(sets.withColumnRenamed("node", "b").withColumnRenamed("shingles", "sb"), "b")
            .join(sets.withColumnRenamed("node", "a").withColumnRenamed("shingles", "sa"), "a").select("a", "b", "sa", "sb"))
    return map_batches(near, run, "a long, b long").distinct()


def links(docs: DataFrame, sigs: DataFrame) -> DataFrame:
    """(a, b) links between class representatives that have the components of all links."""
    reps = (sigs.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
            .agg(F.min(F.struct("doc_id", "bands")).alias("r")).select(F.col("r.doc_id").alias("node"), F.col("r.bands").alias("bands")))
    members = reps.select(F.explode("bands").alias("bucket"), "node")
    shared = members.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1").select("bucket", "leader")
    members = stored(members.join(shared, "bucket").distinct(), "buckets")
    # the bands come along from the first pass: no signature is computed twice
    met = reps.join(members.select("node").distinct(), "node", "left_semi").withColumnRenamed("node", "doc_id")
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL").join(met, "doc_id")
    sets = stored(shingle_sets(texts), "shingles")
    found = stored(confirm(members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), sets), "links")
    part = components(found)
    own, first = (part.withColumnsRenamed({"node": n, "component": c}) for n, c in (("node", "component"), ("leader", "home")))
    at = stored(members.join(own, "node", "left").join(first, "leader", "left")
                .select("bucket", "node", F.coalesce("component", "node").alias("component"), F.coalesce("home", "leader").alias("home")), "members")
    foreign = F.col("component") != F.col("home")
    open_ = (at.groupBy("bucket").agg(F.count("*").alias("n"), F.count(F.when(foreign, 1)).alias("outside")).where("n > 2 AND outside > 0")
             .select("bucket", F.ceil(F.col("n") / STREAM).alias("streams"), F.ceil(F.col("outside") / OUTSIDERS).alias("blocks")))
    at = stored(at.join(open_, "bucket"), "open")
    dealt = F.xxhash64("node", F.lit(1))
    outside = at.where(foreign).withColumn("block", F.pmod(dealt, "blocks")).withColumn("stream", F.explode(F.sequence(F.lit(0), F.col("streams") - 1)))
    inside = at.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("stream", F.pmod(dealt, "streams"))
    rows = outside.withColumn("role", F.lit(0)).unionByName(inside.withColumn("role", F.lit(1)))
    rows = rows.join(sets, "node").select("bucket", "block", "stream", "role", "node", "component", "shingles", "bands")
    rows = rows.repartition("bucket", "block", "stream").sortWithinPartitions("bucket", "block", "stream", "role")
    return found.unionByName(stored(rows.mapInArrow(_meet, "a long, b long").distinct(), "more-links"))


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the outsiders (role 0, ahead in each group) with the members that follow them."""
    group, held = None, None
    for batch in batches:
        out = []
        for bucket, block, stream_, role, node, component, shingles, bands in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (bucket, block, stream_) != group:
                group, held = (bucket, block, stream_), _Outsiders(bucket)
            if role == 0:
                held.add(node, component, shingles, bands)
            else:
                out += held.links(node, component, shingles, bands)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])


class _Outsiders:
    def __init__(self, bucket: int):
        self.bucket, self.rows, self.bands, self.counts, self.sizes, self.done = bucket, [], None, None, None, {}

    def add(self, node: int, component: int, shingles: bytes, bands: list[int]) -> None:
        self.rows.append((node, component, shingles, bands))

    def links(self, node: int, component: int, shingles: bytes, bands: list[int]) -> list[tuple[int, int]]:
        if not self.rows:  # the hash dealt this block none
            return []
        if self.bands is None:
            self.bands = np.array([r[3] for r in self.rows], np.int64)
            self.counts = np.stack([counts(np.frombuffer(r[2], np.uint64)) for r in self.rows])
            self.sizes = self.counts.sum(1, dtype=np.int64)
        same = self.bands == np.array(bands, np.int64)
        here = np.flatnonzero(self.bands[np.arange(len(same)), same.argmax(1)] == self.bucket)
        own = counts(np.frombuffer(shingles, np.uint64))
        # no pair that reaches the threshold is left out: the sum is at least the intersection
        most = np.minimum(self.counts[here], own).sum(1, dtype=np.int64)
        part, whole = THRESHOLD
        here = here[whole * most >= part * (self.sizes[here] + int(own.sum()) - most)]
        out = []
        for i in here.tolist():
            other, theirs, their_set, _ = self.rows[i]
            if theirs != component and (other, component) not in self.done and similar(their_set, shingles):
                self.done[other, component] = True
                out.append((min(node, other), max(node, other)))
        return out


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of `docs`."""
    prepare(docs.sparkSession)
    sigs = stored(signatures(docs), "signatures")
    part = components(links(docs, sigs))
    classes = (sigs.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("node"))
               .join(part, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id")))
    return (sigs.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")).join(classes, "digest", "left")
            .withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of its group; null ids stay."""
    gone = near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("__llm_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__llm_gone"], "left_anti")
