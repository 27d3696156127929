"""Words and five-word shingles of whole Arrow batches, as 64-bit hashes.

A word is a run of bytes outside \\x20 and \\x09-\\x0D with A-Z lower-cased.  All texts of
a batch are handled at once on the batch's own UTF-8 buffer, so no Python string is made.
Word hashes are multilinear over the bytes with fixed pseudo-random 64-bit tables.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
_GOLD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    start = (seed * 0xD1342543DE82EF95) & (2**64 - 1)
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_GOLD) + np.uint64(start))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = stream(1, 256)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_PLACE = [stream(2, 256) | np.uint64(1)]
_STEP = stream(3, SHINGLE) | np.uint64(1)


def _places(n: int) -> np.ndarray:
    if len(_PLACE[0]) < n:
        _PLACE[0] = stream(2, 2 * n) | np.uint64(1)
    return _PLACE[0]


class Words(NamedTuple):
    data: np.ndarray    # the batch's bytes
    starts: np.ndarray  # byte offset of each word
    ends: np.ndarray
    hashes: np.ndarray  # uint64 of each word
    first: np.ndarray   # first[d]:first[d + 1] are the words of text d


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1, from 0) of a string array; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    n, (_, places, data) = len(column), column.buffers()
    off = np.frombuffer(places, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def words_of(column: pa.Array) -> Words:
    data, off = buffers(column)
    inside = ~_SPACE[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cut = off[(off > 0) & (off < len(data))]  # texts meet here without a space
    begin[cut] = inside[cut]
    end[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    first = np.searchsorted(starts, off)
    if not len(starts):
        return Words(data, starts, ends, np.empty(0, np.uint64), first)
    sizes = ends - starts
    at = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(at, sizes)
    value = _BYTE[data[inside]] * _places(int(sizes.max()))[place]
    return Words(data, starts, ends, mix(np.add.reduceat(value, at) + sizes.astype(np.uint64) * np.uint64(_GOLD)), first)


def windows_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, start): every run of `size` words inside one text, hashed as the text of just these words."""
    h, start = words.hashes, np.arange(max(0, len(words.hashes) - size + 1))
    text = np.searchsorted(words.first, start, "right")
    start = start[start + size <= words.first[text]]
    total = np.full(len(start), np.uint64(size)) * np.uint64(_GOLD)
    for k in range(size):
        total += h[start + k] * _STEP[k]
    return mix(total), start


def shingles_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): first[d]:first[d + 1] are text d's shingles in order, repeats included.

    A text of one to four words has one shingle, its whole sequence; one without words none.
    """
    h, first = words.hashes, words.first
    count = np.diff(first)
    each = np.where(count >= SHINGLE, count - SHINGLE + 1, (count > 0).astype(count.dtype))
    out_first = np.concatenate([[0], np.cumsum(each)])
    pad = np.concatenate([h, np.zeros(SHINGLE, np.uint64)])
    start = np.arange(int(out_first[-1])) - np.repeat(out_first[:-1] - first[:-1], each)
    size = np.repeat(np.minimum(count, SHINGLE), each)
    total = size.astype(np.uint64) * np.uint64(_GOLD)
    short = bool((size < SHINGLE).any())
    for k in range(SHINGLE):
        part = pad[start + k] * _STEP[k]
        if short:
            part[size <= k] = 0
        total += part
    return mix(total), out_first

