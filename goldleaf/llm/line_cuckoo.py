"""Reversible line dedup: sharded cuckoo filters over exact reference-count tables.

State, all of it written tables:

* `refs`    one row for each (line key, doc_id): the exact references;
* `counts`  one row for each key: n_docs and the largest doc_id, the exact counts;
* `filters` one row for each shard: a cuckoo filter of the keys that reached `min_docs`.

`insert` adds documents' references, `delete` takes them away; both recount the touched
keys only, and keys that cross the threshold are put into or taken out of their shard's
filter (which a cuckoo filter allows and a Bloom filter does not).  So deleting documents
gives the state, and the cleaned texts, that there would be without them.

Cleaning probes the filters first: the filter rows and the references are dealt by shard,
filters ahead, and streamed, so a task holds one shard's filter at a time.  Only positives
go on to the exact counts, which remove the false positives.  Keys that hold a large share
of all references are at most HEAVY_KEYS by counting, so they are matched with a broadcast
of that proven size before the probe; no shuffle carries them.

A line's key is the line without [\\x20\\x09-\\x0D] at both ends, A-Z lower-cased; keys of at
least `min_chars` code points that `min_docs` documents hold lose their lines in all but the
largest doc_id.  Keys travel as 128-bit digests.  A null or empty text is one empty line.
Rows that repeat a doc_id are one document for the counts and all lose or keep a line
alike.  Rows with a null doc_id count nowhere and stay whole.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.common import map_batches, prepare, stored
from goldleaf.llm.words import mix

MIN_CHARS, MIN_DOCS = 40, 5
#: Keys with over 1 / HEAVY_KEYS of all references each; there are fewer than HEAVY_KEYS.
HEAVY_KEYS = 4096
#: References that a shard is meant for; its filter holds a part of their keys.
SHARD_REFS = 1 << 14
BLANKS = " \t\n\x0b\x0c\r"
_SLOTS, _KICKS = 4, 500


def line_key(line: str, min_chars: int) -> bytes | None:
    line = line.strip(BLANKS)
    return hashlib.blake2b(line.encode().lower(), digest_size=16).digest() if len(line) >= min_chars else None


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key lies in one of two buckets. 0 marks a free slot."""

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.table = np.zeros((buckets, _SLOTS), np.uint16) if table is None else table
        self.mask = np.int64(len(self.table) - 1)

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 16
        while buckets * _SLOTS * 0.8 < keys:
            buckets *= 2
        return cls(buckets)

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter of distinct 64-bit keys, doubled until all fit."""
        out = cls.sized(len(keys))
        while not all(out.insert(k) for k in keys):
            out = cls(len(out.table) * 2)
        return out

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = (keys >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        one = keys.astype(np.int64) & self.mask
        return mark, one, one ^ self._shift(mark)

    def _shift(self, mark):
        return mix(np.asarray(mark, np.uint64).reshape(-1)).astype(np.int64).reshape(np.shape(mark)) & self.mask

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self._places(keys)
        return (self.table[one] == mark[:, None]).any(1) | (self.table[two] == mark[:, None]).any(1)

    def insert(self, key) -> bool:
        mark, one, two = (x[0] for x in self._places(np.array([key], np.uint64)))
        for at in (one, two):
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = mark
                return True
        at = two
        for turn in range(_KICKS):
            slot = turn % _SLOTS
            mark, self.table[at, slot] = self.table[at, slot], mark
            at = at ^ self._shift(mark)
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = mark
                return True
        return False

    def delete(self, key) -> bool:
        """Take out one inserted key."""
        mark, one, two = (x[0] for x in self._places(np.array([key], np.uint64)))
        for at in (one, two):
            held = np.flatnonzero(self.table[at] == mark)
            if len(held):
                self.table[at, held[0]] = 0
                return True
        return False

    def dump(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        table = np.frombuffer(raw, np.uint16).reshape(-1, _SLOTS).copy()
        return cls(len(table), table)


def _numbers(keys: list[bytes]) -> np.ndarray:
    """The upper half of each key, mixed: what the filters hold."""
    return mix(np.frombuffer(b"".join(k[:8] for k in keys), np.uint64))


def references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Distinct (key, doc_id) of the lines that are long enough."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, keys = [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if text:
                found = {line_key(line, min_chars) for line in text.split("\n")} - {None}
                ids += [doc_id] * len(found)
                keys += found
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], names=["key", "doc_id"])

    return map_batches(docs.select("doc_id", "text").where("doc_id IS NOT NULL"), run, "key binary, doc_id long").distinct()


def _shard(key, shards: int):
    """From the lower half of the key, which the filters do not use."""
    return F.pmod(F.conv(F.hex(F.substring(key, 13, 4)), 16, 10).cast("long"), F.lit(shards)).cast("int")


@dataclass
class LineIndex:
    """The written state; insert() and delete() return a new one."""

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS

    @classmethod
    def empty(cls, spark: SparkSession, shards: int = 1, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> LineIndex:
        return cls(spark.createDataFrame([], "key binary, doc_id long"), spark.createDataFrame([], "key binary, n_docs long, last long"),
                   spark.createDataFrame([], "shard int, filter binary"), shards, min_chars, min_docs)

    @classmethod
    def build(cls, docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> LineIndex:
        """The state of one insert into an empty index, with shards for the keys at hand."""
        prepare(docs.sparkSession)
        refs = stored(references(docs, min_chars), "line-refs")
        counts = stored(_count(refs), "line-counts")
        shards = max(1, -(-refs.count() // SHARD_REFS))
        hot = counts.where(F.col("n_docs") >= min_docs)
        return cls(refs, counts, stored(_filters(hot, shards), "line-filters"), shards, min_chars, min_docs)

    def insert(self, docs: DataFrame) -> LineIndex:
        new = references(docs, self.min_chars).join(self.refs, ["key", "doc_id"], "left_anti")
        new = stored(new, "line-new")
        return self._changed(stored(self.refs.unionByName(new), "line-refs"), new.select("key").distinct())

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Take back what the documents of `doc_ids` (a doc_id column) brought."""
        gone = doc_ids.select("doc_id").distinct()
        touched = self.refs.join(gone, "doc_id", "left_semi").select("key").distinct()
        return self._changed(stored(self.refs.join(gone, "doc_id", "left_anti").select("key", "doc_id"), "line-refs"), stored(touched, "line-touched"))

    def _changed(self, refs: DataFrame, touched: DataFrame) -> LineIndex:
        fresh = stored(_count(refs.join(touched, "key", "left_semi")), "line-recount")
        counts = stored(self.counts.join(touched, "key", "left_anti").unionByName(fresh), "line-counts")
        was, now = (t.where(F.col("n_docs") >= self.min_docs).select("key") for t in (self.counts.join(touched, "key", "left_semi"), fresh))
        moves = now.join(was, "key", "left_anti").withColumn("add", F.lit(True)).unionByName(was.join(now, "key", "left_anti").withColumn("add", F.lit(False)))
        moves = moves.withColumn("shard", _shard(F.col("key"), self.shards))
        stale, exact = stored(_moved(self.filters, moves), "line-moved"), counts.where(F.col("n_docs") >= self.min_docs)
        # a shard whose filter had no room is built anew from the exact counts
        full = stale.where("filter IS NULL").select("shard")
        again = _filters(exact.join(full, _shard(F.col("key"), self.shards) == full["shard"], "left_semi"), self.shards)
        return LineIndex(refs, counts, stored(stale.where("filter IS NOT NULL").unionByName(again), "line-filters"), self.shards, self.min_chars, self.min_docs)

    def dropped(self, refs: DataFrame | None = None) -> DataFrame:
        """(doc_id, keys): the line keys that each document loses."""
        refs = self.refs if refs is None else refs
        hot = self.counts.where(F.col("n_docs") >= self.min_docs)
        total = self.counts.agg(F.sum("n_docs")).first()[0] or 0
        heavy = F.broadcast(hot.where(F.col("n_docs") * HEAVY_KEYS > total).select("key", "last"))
        by_heavy = refs.join(heavy, "key").where("doc_id <> last").select("doc_id", "key")
        rest = self._positives(refs.join(heavy, "key", "left_anti"))
        by_rest = rest.join(hot.where(F.col("n_docs") * HEAVY_KEYS <= total), "key").where("doc_id <> last").select("doc_id", "key")
        return by_heavy.unionByName(by_rest).groupBy("doc_id").agg(F.collect_list("key").alias("keys"))

    def _positives(self, refs: DataFrame) -> DataFrame:
        """The references whose key passes its shard's filter."""
        probes = refs.select(_shard(F.col("key"), self.shards).alias("shard"), F.lit(1).alias("part"), "key", "doc_id", F.lit(None).cast("binary").alias("filter"))
        heads = self.filters.select("shard", F.lit(0).alias("part"), F.lit(None).cast("binary").alias("key"), F.lit(None).cast("long").alias("doc_id"), "filter")
        dealt = heads.unionByName(probes).repartition("shard").sortWithinPartitions("shard", "part")
        return dealt.mapInArrow(_probe, "key binary, doc_id long")

    def clean(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_lines, n_dropped and kept (the text without the dropped lines) of each row."""
        return self._rewritten(docs.select("doc_id", "text"), "kept string", lambda kept: kept)

    def digests(self, docs: DataFrame) -> DataFrame:
        """clean() with the SHA-256 of the kept text in its place."""
        return self._rewritten(docs.select("doc_id", "text"), "kept_sha256 string", lambda kept: hashlib.sha256(kept.encode()).hexdigest())

    def _rewritten(self, docs: DataFrame, last: str, shape) -> DataFrame:
        min_chars = self.min_chars

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            lines, lost, out = [], [], []
            for text, keys in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                parts = (text or "").split("\n")
                kept = parts
                if keys:
                    gone = set(keys)
                    kept = [p for p in parts if line_key(p, min_chars) not in gone]
                lines.append(len(parts))
                lost.append(len(parts) - len(kept))
                out.append(shape("\n".join(kept)))
            return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(lines, pa.int64()), pa.array(lost, pa.int64()), pa.array(out, pa.string())], names=names)

        names = ["doc_id", "n_lines", "n_dropped", last.split()[0]]
        return map_batches(docs.join(self.dropped(), "doc_id", "left").select("doc_id", "text", "keys"), run, f"doc_id long, n_lines long, n_dropped long, {last}")


def _count(refs: DataFrame) -> DataFrame:
    return refs.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last"))


def _filters(hot: DataFrame, shards: int) -> DataFrame:
    """A filter for each shard that has keys; a shard has about SHARD_REFS / min_docs of them."""
    import pandas as pd

    def build(part: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.of(np.unique(_numbers(list(part["key"]))))
        return pd.DataFrame({"shard": [part["shard"].iloc[0]], "filter": [made.dump()]})

    return hot.select("key", _shard(F.col("key"), shards).alias("shard")).groupBy("shard").applyInPandas(build, "shard int, filter binary")


def _moved(filters: DataFrame, moves: DataFrame) -> DataFrame:
    """The filters after moves (key, add, shard); null where there was no room."""
    import pandas as pd

    def change(old: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        shard = (old if len(old) else part)["shard"].iloc[0]
        held = CuckooFilter.load(old["filter"].iloc[0]) if len(old) else CuckooFilter.sized(len(part))
        ok = True
        if len(part):
            numbers, add = _numbers(list(part["key"])), part["add"].to_numpy(bool)
            for k in numbers[~add]:
                held.delete(k)
            ok = all(held.insert(k) for k in numbers[add])
        return pd.DataFrame({"shard": [shard], "filter": [held.dump() if ok else None]})

    return filters.groupBy("shard").cogroup(moves.groupBy("shard")).applyInPandas(change, "shard int, filter binary")


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard, held = None, None
    for batch in batches:
        shards = batch.column(0).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if shards[a] != shard:
                shard, held = shards[a], None
            heads = part.column(1).to_numpy(zero_copy_only=False) == 0
            if heads.any():
                held = CuckooFilter.load(part.column(4)[int(np.argmax(heads))].as_py())
            rest = part.filter(pa.array(~heads))
            if held is not None and rest.num_rows:
                hit = held.contains(_numbers(rest.column(2).to_pylist()))
                if hit.any():
                    yield rest.select([2, 3]).filter(pa.array(hit))


def dedup_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of each row."""
    return LineIndex.build(docs).digests(docs)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """`docs` with the dropped lines gone from `text`, all columns kept; n_chars follows where there is one."""
    index = LineIndex.build(docs)
    min_chars = index.min_chars
    own, gone = "__llm_id", "__llm_keys"
    while {own, gone} & set(docs.columns):
        own, gone = own + "_", gone + "_"
    keys = index.dropped().withColumnsRenamed({"doc_id": own, "keys": gone})
    joined = docs.join(keys, docs["doc_id"] == keys[own], "left").drop(own)
    at = joined.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, gone in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
            if gone and text:
                gone = set(gone)
                text = "\n".join(p for p in text.split("\n") if line_key(p, min_chars) not in gone)
            out.append(text)
        return batch.set_column(at, batch.schema.names[at], pa.array(out, pa.string())).select(list(range(batch.num_columns - 1)))

    out = map_batches(joined, run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
