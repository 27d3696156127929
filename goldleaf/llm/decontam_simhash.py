"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming lookup, exact check.

For every benchmark item of L words, every window of L consecutive words of every document
(the whole text where it has fewer words) is compared with the item.  The similarity is the
weighted Jaccard similarity of their five-word shingles, weights being how often a shingle
occurs: sum of minima / sum of maxima >= 0.75.

1. Seeds.  A window that reaches the threshold shares at least 0.75 / 1.75 of the two
   weights' sum with the item, so it holds that many shingles that occur in the benchmark.
   Running counts of such shingles leave only the windows that can reach it; none is lost.
2. SimHash.  Each such window gets a 128-bit fingerprint of its weighted shingles.
3. Multi-index blocks.  Fingerprints are cut into 16 blocks of 8 bits.  Two fingerprints
   within RADIUS = 47 differ by at most two bits in some block, and for each block value a
   table gives the items within two bits of it: so every item within the radius is found.
   At the threshold the expected distance is 22 with a deviation of 4.3, the radius lies
   5.8 deviations beyond.
4. Candidates within the radius are verified exactly on their shingles.

An item of fewer than five words is one shingle, its whole sequence, so a window reaches the
threshold only if it is that sequence: windows of that many words are looked up by its hash.

The benchmark's distinct rows are read in slices of SLICE_BYTES at most (or one row), dealt
by hash and measured before they are fetched, each sent to the tasks as a broadcast of that
size and matched in its own pass, so no benchmark is too large.  Documents are never shuffled.

Items or texts that are null, empty or without words match nothing.  Items of equal text
each give their own rows.  Rows that repeat a doc_id give the best match of the rows; null
doc_ids are reported under null.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import map_batches, prepare
from goldleaf.llm.words import SHINGLE, Words, mix, shingles_of, stream, windows_of, words_of

BITS, BLOCKS = 128, 16
BLOCK_RADIUS = 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
THRESHOLD = (75, 100)
#: Bytes of the benchmark's texts that one pass takes.
SLICE_BYTES = 12_000_000
_SEED_BITS = 22
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_HALF = stream(21, 2)


def simhash(shingles: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """128 bits as 16 bytes, of the last axis of an array of shingle hashes; each occurrence weighs one."""
    bits = np.concatenate([np.unpackbits(mix(shingles ^ h).view(np.uint8).reshape(*shingles.shape, 8), axis=-1) for h in _HALF], axis=-1)
    votes = bits.sum(axis=-2, dtype=np.int32) * 2 - shingles.shape[-1]
    return np.packbits(votes > 0, axis=-1)


class Index:
    """The items of one slice, by number of words, with their multi-index block tables."""

    def __init__(self, items: list[tuple[int, str]]):
        words = words_of(pa.array([text for _, text in items], pa.string()))
        sizes = np.diff(words.first)
        hashes, first = shingles_of(words)
        self.ids = [i for i, _ in items]
        self.items = [hashes[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        self.seeds = np.unique(hashes)
        self.maybe = np.zeros(1 << _SEED_BITS, bool)
        self.maybe[(self.seeds >> np.uint64(64 - _SEED_BITS)).astype(np.int64)] = True
        near = _POP[np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)] <= BLOCK_RADIUS
        self.sizes = {}
        for size in sorted({int(n) for n in sizes if n}):
            which = np.flatnonzero(sizes == size)
            marks = np.stack([simhash(self.items[i]) for i in which])
            # tables[block][value]: which items lie within two bits there
            tables = [near[:, marks[:, b]] for b in range(BLOCKS)]
            self.sizes[size] = which, marks, tables
        #: Items of fewer words than a shingle by their hash, for each number of words.
        self.short: dict[int, dict[int, list[int]]] = {}
        for i in np.flatnonzero((sizes > 0) & (sizes < SHINGLE)).tolist():
            self.short.setdefault(int(sizes[i]), {}).setdefault(int(self.items[i][0]), []).append(i)

    def lookup(self, size: int, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all fingerprints within RADIUS."""
        which, own, tables = self.sizes[size]
        found = tables[0][marks[:, 0]]
        for b in range(1, BLOCKS):
            found |= tables[b][marks[:, b]]
        w, i = np.nonzero(found)
        close = _POP[marks[w] ^ own[i]].sum(1) <= RADIUS
        return w[close], which[i[close]]

    def matches(self, column: pa.Array) -> list[tuple[int, int, float, int]]:
        """(text, item, similarity, first word) of the best window of each text and item that match."""
        words = words_of(column)
        hashes, first = shingles_of(words)
        seed = self.maybe[(hashes >> np.uint64(64 - _SEED_BITS)).astype(np.int64)]
        at = np.flatnonzero(seed)
        seed[at] = np.isin(hashes[at], self.seeds)
        out = self._short_matches(words)
        if not seed.any():
            return out
        count = np.concatenate([[0], np.cumsum(seed)])
        for doc in np.unique(np.searchsorted(first, np.flatnonzero(seed), "right") - 1).tolist():
            a, b = int(first[doc]), int(first[doc + 1])
            out += [(doc, *found) for found in self._best(hashes[a:b], count[a:b + 1], int(words.first[doc + 1] - words.first[doc]))]
        return out

    def _short_matches(self, words: Words) -> list[tuple[int, int, float, int]]:
        """As matches(), of the items of one to four words in longer texts."""
        best: dict[tuple[int, int], int] = {}
        for size, items in self.short.items():
            hashes, start = windows_of(words, size)
            hit = np.isin(hashes, np.fromiter(items, np.uint64))
            text = np.searchsorted(words.first, start[hit], "right") - 1
            for key, doc, at in zip(hashes[hit].tolist(), text.tolist(), start[hit].tolist(), strict=True):
                if words.first[doc + 1] - words.first[doc] > size:
                    for item in items[key]:
                        best.setdefault((doc, item), at - int(words.first[doc]))
        return [(doc, item, 1.0, at) for (doc, item), at in best.items()]

    def _best(self, own: np.ndarray, runs: np.ndarray, n_words: int) -> list[tuple[int, float, int]]:
        """(item, similarity, first word) of one text's best windows; runs: running counts of its seeds."""
        best: dict[int, tuple[float, int]] = {}
        for size, (which, _, _) in self.sizes.items():
            if size < min(SHINGLE, n_words):  # _short_matches() has these
                continue
            width, full = (max(1, n - SHINGLE + 1) for n in (min(size, n_words), size))
            need = -(-THRESHOLD[0] * (width + full) // sum(THRESHOLD))
            starts = np.flatnonzero(runs[width:] - runs[:len(runs) - width] >= need)
            view = np.lib.stride_tricks.sliding_window_view(own, width)
            step = max(1, min(200_000 // width, 4_000_000 // len(which)))
            for lo in range(0, len(starts), step):
                at = starts[lo:lo + step]
                part = view[at]
                for w, item in zip(*self.lookup(size, simhash(part)), strict=True):
                    low, high = overlap(part[w], self.items[item])
                    if THRESHOLD[1] * low >= THRESHOLD[0] * high:
                        value = (low / high, -int(at[w]))
                        if value > best.get(int(item), (0, 0)):
                            best[int(item)] = value
        return [(item, score, -start) for item, (score, start) in sorted(best.items())]


def overlap(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """Sums of the minima and of the maxima of two shingle sequences' weights."""
    a, wa = np.unique(x, return_counts=True)
    b, wb = np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    low = int(np.minimum(wa[i], wb[j]).sum())
    return low, len(x) + len(y) - low


def slices(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in slices of bounded size; a slice is fetched only when it is used."""
    rows = benchmark.select("item_id", "text").where("text IS NOT NULL").distinct()
    size, place = F.sum(F.octet_length("text").cast("long")), F.xxhash64("item_id", "text")
    total, n = rows.agg(size, F.count("*")).first()
    parts = -(-(total or 0) // SLICE_BYTES) or 1
    # a slice holds one row or no more than SLICE_BYTES: its size is known before it is fetched
    while parts > 1:
        held = rows.groupBy(F.pmod(place, F.lit(parts)).alias("k")).agg(size.alias("size"), F.count("*").alias("n"))
        if parts >= 64 * n or not held.where((F.col("size") > SLICE_BYTES) & (F.col("n") > 1)).count():
            break
        parts *= 2
    for k in range(parts):
        part = rows.where(F.pmod(place, F.lit(parts)) == k)
        yield [(r[0], r[1]) for r in part.orderBy("item_id", "text").collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity and start_word of the best window of each matching pair."""
    spark = prepare(docs.sparkSession)
    schema = "doc_id long, item_id long, similarity double, start_word long"
    out = None
    for items in slices(benchmark):
        if not items:
            continue
        index = spark.sparkContext.broadcast(Index(items))

        def run(batch: pa.RecordBatch, index=index) -> pa.RecordBatch | None:
            found = index.value.matches(batch.column(1))
            if not found:
                return None
            ids, held = batch.column(0).to_pylist(), index.value.ids
            rows = [(ids[d], held[i], s, w) for d, i, s, w in found]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.float64(), pa.int64()), strict=True)],
                                              names=["doc_id", "item_id", "similarity", "start_word"])

        found = map_batches(docs.select("doc_id", "text"), run, schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], schema)
    best = F.max(F.struct("similarity", (-F.col("start_word")).alias("back")))
    return (out.groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", "b.similarity", (-F.col("b.back")).alias("start_word")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` whose text holds no benchmark item; all columns, without a shuffle."""
    spark = prepare(docs.sparkSession)
    at, schema = docs.columns.index("text"), docs.schema
    for items in slices(benchmark):
        if not items:
            continue
        index = spark.sparkContext.broadcast(Index(items))

        def run(batch: pa.RecordBatch, index=index) -> pa.RecordBatch:
            keep = np.ones(batch.num_rows, bool)
            keep[[doc for doc, *_ in index.value.matches(batch.column(at))]] = False
            return batch.filter(pa.array(keep))

        docs = map_batches(docs, run, schema)
    return docs
