"""Byte-level BPE encoding and decoding by a hierarchical-bitmap rank queue.

Each pre-token is a linked list of parts.  A bucket for each merge rank holds the list
positions whose pair has that rank; a two-level bitmap over the ranks (words of 256 ranks
below one top word) finds the next non-empty bucket by find-first-set.  Merging a pair touches its two neighbours only and
leaves old entries in their buckets: an entry whose position no longer starts a pair of
that rank is stale and skipped.  So a pre-token of n bytes takes O(n log n) steps, also
when it has many thousands.  The lowest rank wins, then the leftmost position, which is
the order of the public tokenizers.

Pre-tokens that a worker has not seen are merged together: the short ones of a run of texts
lie in one list, with breaks between them, under one queue.  A bucket then gives the leftmost
live position of each pre-token at once, merged in numpy; as pre-tokens do not touch, each
has the same merges in the same order as alone.  Long ones, and few, are merged one by one.

The rank file is given by path and read on the driver; the encoder travels to the tasks
as a broadcast of fixed size (the vocabulary), checked against MAX_VOCABULARY.

Null texts count as empty (no ids, empty decoding).  Rows are independent: ids may be
null or repeated and other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from goldleaf.llm.common import map_batches, prepare

#: Bound of the broadcast vocabulary: entries.
MAX_VOCABULARY = 1_000_000
#: Encoded pre-tokens kept for reuse in a Python worker; the store is emptied when full.
KEPT_PRETOKENS = 700_000
#: Longer pre-tokens are not kept, and each has a queue of its own.
KEPT_BYTES = 64
#: Characters of the texts that are encoded in one run (one text at least), and pre-tokens under one queue.
RUN_CHARS, QUEUED = 4_000_000, 100_000
#: Fewer new pre-tokens are merged one by one.
FEW = 200


class Encoder:
    """Ranks and the pre-token pattern; picklable, with a bounded store of encoded pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self._ready()

    def _ready(self):
        self.find = regex.compile(self.pattern).findall
        self.kept: dict[str, bytes] = {}
        tokens = sorted(self.ranks.items(), key=lambda t: t[1])
        self.bytes = np.frombuffer(b"".join(t for t, _ in tokens), np.uint8)
        self.size = np.zeros(tokens[-1][1] + 1, np.int64)  # of each id, in bytes
        self.size[[r for _, r in tokens]] = [len(t) for t, _ in tokens]
        self.start = np.cumsum(self.size) - self.size
        self.pairs = None

    def __getstate__(self):
        return self.ranks, self.pattern, self._pair_table()

    def __setstate__(self, state):
        self.ranks, self.pattern, pairs = state
        self._ready()
        self.pairs = pairs

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        pair = [ranks.get(piece[i:i + 2], -1) for i in range(n - 1)]  # rank of the pair that starts at each part
        pair += (-1, -1)
        buckets: dict[int, list[int]] = {}
        words: dict[int, int] = {}  # 256 ranks each
        top = 0                     # which words are not empty
        for i in range(n - 1):
            rank = pair[i]
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(i)  # in rising order: a heap
                else:
                    buckets[rank] = [i]
                    w = rank >> 8
                    words[w] = words.get(w, 0) | 1 << (rank & 255)
                    top |= 1 << w
        while top:
            w = (top & -top).bit_length() - 1
            word = words[w]
            low = word & -word
            rank = w << 8 | low.bit_length() - 1
            bucket = buckets[rank]
            i = heappop(bucket)
            if not bucket:
                del buckets[rank]
                word ^= low
                words[w] = word
                if not word:
                    top &= top - 1
            if pair[i] != rank:
                continue  # stale
            j = after[i]
            k = after[i] = after[j]
            before[k] = i
            pair[j] = -1  # no longer a part
            for s in (before[i], i):
                if s < 0:
                    continue
                m = after[s]
                rank = ranks.get(piece[s:after[m]], -1) if m < n else -1
                pair[s] = rank
                if rank >= 0:
                    if rank in buckets:
                        heappush(buckets[rank], s)
                    else:
                        buckets[rank] = [s]
                        w = rank >> 8
                        words[w] = words.get(w, 0) | 1 << (rank & 255)
                        top |= 1 << w
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:after[i]]])
            i = after[i]
        return out

    def _pair_table(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys left * ids + right of the pairs that make a token, and their ranks."""
        if self.pairs is None:
            ranks, ids = self.ranks, len(self.size)
            found = sorted((ranks[t[:k]] * ids + ranks[t[k:]], rank) for t, rank in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks)
            self.pairs = tuple(np.array(c, np.int64) for c in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 2
        return self.pairs

    def _rank_of(self, left, right) -> np.ndarray:
        """Ranks of pairs of ids; -1 where either is -1 or they make no token."""
        keys, values = self._pair_table()
        if not len(keys):
            return np.full(np.broadcast(left, right).shape, -1)
        key = np.where((left >= 0) & (right >= 0), left * len(self.size) + right, -1)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, values[at], -1)

    def merge_together(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each of many short pre-tokens, as little-endian unsigned 32-bit integers."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        n, sizes = len(data), np.array([len(p) for p in pieces])
        owner = np.repeat(np.arange(len(pieces)), sizes)
        ids = np.append(np.array([self.ranks[bytes([b])] for b in range(256)])[data], -1)  # place n stands for no part
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        ends = np.cumsum(sizes)
        after[ends - 1] = before[ends - sizes] = n
        after[n] = n
        pair = self._rank_of(ids, ids[after])
        live = np.ones(n, bool)
        buckets: dict[int, list[int]] = {}
        words: dict[int, int] = {}
        top = 0
        places = np.flatnonzero(pair >= 0)
        new, ranks = places.tolist(), pair[places].tolist()
        while True:
            for i, rank in zip(new, ranks, strict=True):
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    w = rank >> 8
                    words[w] = words.get(w, 0) | 1 << (rank & 255)
                    top |= 1 << w
            if not top:
                break
            w = (top & -top).bit_length() - 1
            word = words[w]
            low = word & -word
            rank = w << 8 | low.bit_length() - 1
            at = np.unique(buckets.pop(rank))
            words[w] = word ^ low
            if word == low:
                top &= top - 1
            at = at[pair[at] == rank]  # the others are stale
            whose = owner[at]
            first = np.ones(len(at), bool)
            first[1:] = whose[1:] != whose[:-1]
            later = at[~first].tolist()  # their turn comes after the first's new pairs
            at = at[first]
            j, left = after[at], before[at]
            k = after[j]
            after[at], before[k] = k, at
            ids[at], pair[j], live[j] = rank, -1, False
            pair[left], pair[at] = self._rank_of(ids[left], rank), self._rank_of(rank, ids[k])
            places = np.concatenate([left, at])
            places = places[pair[places] >= 0]
            new, ranks = places.tolist() + later, pair[places].tolist() + [rank] * len(later)
        counts = np.bincount(owner[live], minlength=len(pieces))
        packed, stops = ids[:n][live].astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        return [packed[a:b] for a, b in zip([0, *stops], stops, strict=False)]

    def learn(self, pretokens: set[str]) -> list[str]:
        """Keep the ids of new pre-tokens; gives back those too long to stay."""
        pieces = {p: p.encode() for p in pretokens}
        whole = {p: self.ranks[b] for p, b in pieces.items() if b in self.ranks}
        self.kept.update((p, struct.pack("<I", i)) for p, i in whole.items())
        rest = [p for p in pieces if p not in whole]
        long_ = [p for p in rest if len(pieces[p]) > KEPT_BYTES]
        short = [p for p in rest if len(pieces[p]) <= KEPT_BYTES]
        alone = long_ + short if len(short) < FEW else long_
        for p in alone:
            found = self.merge(pieces[p])
            self.kept[p] = struct.pack(f"<{len(found)}I", *found)
        for lo in range(0, len(short) if len(short) >= FEW else 0, QUEUED):
            part = short[lo:lo + QUEUED]
            self.kept.update(zip(part, self.merge_together([pieces[p] for p in part]), strict=True))
        return long_

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        lo = 0
        while lo < len(texts):
            run, chars = [], 0
            while lo < len(texts) and (not run or chars < RUN_CHARS):
                run.append(self.find(texts[lo]) if texts[lo] else [])
                chars += len(texts[lo] or "")
                lo += 1
            seen = set(chain.from_iterable(run))
            if len(self.kept) + len(new := seen.difference(self.kept)) > KEPT_PRETOKENS:
                self.kept.clear()
                new = seen
            passing = self.learn(new)
            for found in run:
                yield b"".join(map(self.kept.__getitem__, found))
            for p in passing:
                del self.kept[p]

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def decode(self, ids: bytes) -> bytes:
        ids = np.frombuffer(ids, "<u4")
        out = []
        for lo in range(0, len(ids), RUN_CHARS):
            part = ids[lo:lo + RUN_CHARS]
            size = self.size[part]
            skip = self.start[part] - (np.cumsum(size) - size)
            out.append(self.bytes[np.repeat(skip, size) + np.arange(int(size.sum()))].tobytes())
        return b"".join(out)


def load_ranks(path: str) -> dict[bytes, int]:
    """A public rank file: a base64 token and its rank on each line."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError(f"{len(ranks)} tokens exceed the broadcast bound of {MAX_VOCABULARY}")
    return ranks


def encoder(spark: SparkSession, path: str, pattern: str):
    return spark.sparkContext.broadcast(Encoder(load_ranks(path), pattern))


def encode(docs: DataFrame, path: str, pattern: str, digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit), decoded (binary).

    With `digests`: doc_id, n_tokens, ids_sha256, decoded_sha256 instead of the long columns.
    """
    spark = prepare(docs.sparkSession)
    shared = encoder(spark, path, pattern)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = shared.value
        counts, first, second = [], [], []
        for ids in enc.encode_all(batch.column(1).to_pylist()):
            back = enc.decode(ids)
            counts.append(len(ids) // 4)
            first.append(hashlib.sha256(ids).hexdigest() if digests else ids)
            second.append(hashlib.sha256(back).hexdigest() if digests else back)
        kind = pa.string() if digests else pa.binary()
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(first, kind), pa.array(second, kind)], names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "n_tokens", "ids", "decoded"]
    kind = "string" if digests else "binary"
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id long, n_tokens long, {names[2]} {kind}, {names[3]} {kind}")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and text of (doc_id, ids): the inverse of encode(); bytes outside UTF-8 become U+FFFD."""
    spark = prepare(encoded.sparkSession)
    shared = encoder(spark, path, pattern)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        back = [shared.value.decode(ids or b"").decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(back, pa.string())], names=["doc_id", "text"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, text string")
