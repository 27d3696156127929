"""Token ids as length-delimited binary records, with a separate offset index.

A shard file is a sequence of records, each framed as

    length (u64) | masked crc32 of the length's bytes (u32) | payload | masked crc32 of the payload (u32)

all little-endian; the mask rotates the checksum and adds a constant, so that checksums of
data that hold checksums stay sound.  A payload is a flag byte (1: the row has an id), the id
(i64), the bytes of a token id (2 where the vocabulary fits, else 4) and the token ids.  The index is a Parquet table with one row per record:
shard, doc_id, offset and length of the frame, the tokens before it in its shard, and its own.

Documents are range-partitioned by doc_id (null first; equal ids by a hash of the text, then
by place in the input) and every partition is one shard, so shards and records ascend.  A
task writes its own file under a fresh name and returns the index rows; the index is written
by Spark, which commits one attempt of each task.  So the index is the commit: files of lost
or repeated attempts are in no row of it and are never read.

read() opens shards at the index's offsets in any order of its rows, which is what shuffled
training reads do (shuffled() gives such an order), and raises on a checksum that differs.
Neighbouring rows are fetched in one read.

Texts are encoded by the tokenizers library.  Its white space step never joins what a blank
or a line feed separates, so a text's ids are those of its pieces between these, one after
the other; ids of short pieces are kept in a bounded store.  Null and empty texts have the
end id alone.  Texts of any length are encoded whole.  A repeated row is a record of its
own; an empty table gives an empty index.  Only doc_id and text are read.

The folder must be reachable from every executor: a mounted path, or any store that
pyarrow.fs.FileSystem.from_uri opens.
"""

from __future__ import annotations

import functools
import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import map_batches, prepare
from goldleaf.session import scratch_path

# Fixed values of the format.
MASK_DELTA = 0xA282EAD8
_HEAD, _FOOT, _ID = struct.Struct("<QI"), struct.Struct("<I"), struct.Struct("<BqB")
INDEX = "shard string, shard_no int, doc_id bigint, offset bigint, length bigint, first bigint, n_tokens bigint"

#: Pieces kept in one half of a worker's store, and the longest of them in characters.
STORE_PIECES, STORE_LENGTH = 400_000, 48
#: Characters encoded at once, and bytes fetched at once.
RUN_CHARS, READ_BYTES = 1 << 22, 1 << 23


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return size + _FOOT.pack(masked(size)) + payload + _FOOT.pack(masked(payload))


def unframe(record: bytes) -> bytes:
    """The payload of one whole frame; ValueError if the frame is damaged."""
    if len(record) < _HEAD.size + _FOOT.size:
        raise ValueError("record too short")
    length, crc = _HEAD.unpack_from(record)
    payload = record[_HEAD.size:_HEAD.size + length]
    if crc != masked(record[:8]) or len(record) != _HEAD.size + length + _FOOT.size or _FOOT.unpack_from(record, _HEAD.size + length)[0] != masked(payload):
        raise ValueError("damaged record")
    return payload


def payload_of(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return _ID.pack(doc_id is not None, doc_id or 0, width) + ids


def parts_of(payload: bytes) -> tuple[int | None, bytes]:
    """The id, and the token ids as u32."""
    has, doc_id, width = _ID.unpack_from(payload)
    return (doc_id if has else None), np.frombuffer(payload, f"<u{width}", offset=_ID.size).astype("<u4").tobytes()


class Encoder:
    """Ids of whole texts by a tokenizer file, as little-endian bytes of `dtype`.

    The distinct pieces of a run are looked up once each, and their ids gathered by number.
    Pieces not in the store are encoded together, as the words of one sequence.  The store has
    two halves; a full new half replaces the old one, whose pieces come back when they are met
    again.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        first, size = 0, 0
        for k, t in enumerate(texts):
            size += len(t)
            if size >= RUN_CHARS or k == len(texts) - 1:
                yield from self._run(texts[first:k + 1])
                first, size = k + 1, 0

    def _run(self, texts: list[str]) -> list[bytes]:
        pieces = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        coded = pieces.flatten().dictionary_encode()
        met = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        missing = [p for p in met if p not in self.new]
        again = [p for p in missing if p in self.old]
        self.new.update((p, self.old[p]) for p in again)
        fresh = [p for p in missing if p not in self.old]
        self.new.update(self._pieces(fresh))
        bodies = list(map(self.new.__getitem__, met))
        out = self._joined(bodies, coded.indices.to_numpy(), pieces.offsets.to_numpy())
        for p in fresh:
            if len(p) > STORE_LENGTH:
                del self.new[p]
        if len(self.new) > STORE_PIECES:
            self.old, self.new = self.new, {}
        return out

    def _joined(self, bodies: list[bytes], pieces: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The ids of each text, whose `pieces` (numbers of `bodies`) lie between two `offsets`."""
        width = self.dtype.itemsize
        sizes = np.fromiter(map(len, bodies), np.int64, len(bodies)) // width
        firsts, counts = (np.cumsum(sizes) - sizes)[pieces], sizes[pieces]
        ends = np.concatenate([[0], np.cumsum(counts)])
        places = np.repeat(firsts - ends[:-1], counts) + np.arange(ends[-1])
        data = np.frombuffer(b"".join(bodies), self.dtype)[places].tobytes()
        at = (ends[offsets] * width).tolist()
        return [data[i:j] for i, j in zip(at, at[1:])]

    def _pieces(self, fresh: list[str]) -> Iterator[tuple[str, bytes]]:
        if not fresh:
            return
        found = self.tokenizer.encode(fresh, is_pretokenized=True, add_special_tokens=False)
        body, width = np.array(found.ids, self.dtype).tobytes(), self.dtype.itemsize
        # a token's word is the number of its piece
        ends = (np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(fresh)), "right") * width).tolist()
        yield from zip(fresh, map(body.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder of a worker process."""
    return Encoder(path)


def _open(folder: str) -> tuple[pa.fs.FileSystem, str]:
    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:"):]
    return pa.fs.FileSystem.from_uri(folder)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Write the records and the index below `folder`; the index with `start`, the tokens of all rows before."""
    prepare(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.select("doc_id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("place"))
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "tie", "place")]
    keyed = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        no, name, out, at, tokens = TaskContext.get().partitionId(), "", None, 0, 0
        try:
            for batch in batches:
                if out is None:
                    name = f"shard-{no:06d}-{uuid.uuid4().hex[:12]}.rec"
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{base}/{name}")
                rows, encode = [], encoder(tokenizer)
                width, end = encode.dtype.itemsize, np.array([end_id], encode.dtype).tobytes()
                for doc_id, body in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist()), strict=True):
                    record = frame(payload_of(doc_id, body + end, width))
                    out.write(record)
                    n = len(body) // width + 1
                    rows.append((name, no, doc_id, at, len(record), tokens, n))
                    at, tokens = at + len(record), tokens + n
                yield _batch(rows)
        finally:
            if out is not None:
                out.close()

    keyed.mapInArrow(shard, INDEX).write.parquet(f"{folder}/index")
    return read_index(docs.sparkSession, folder)


_INDEX_ARROW = pa.schema([("shard", pa.string()), ("shard_no", pa.int32()), ("doc_id", pa.int64()), ("offset", pa.int64()),
                          ("length", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _INDEX_ARROW.types, strict=True)], schema=_INDEX_ARROW)


def read_index(spark, folder: str) -> DataFrame:
    """The index with `start`: the tokens of all rows before, in the order of shards and records."""
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    # one row for each shard
    sizes = index.groupBy("shard_no").agg(F.sum("n_tokens").alias("n")).orderBy("shard_no").collect()
    before = [0, *accumulate(r["n"] for r in sizes)]
    starts = spark.createDataFrame([(r["shard_no"], b) for r, b in zip(sizes, before)], "shard_no int, before bigint")
    return index.join(F.broadcast(starts), "shard_no").select(*index.columns, (F.col("before") + F.col("first")).alias("start"))


def shuffled(index: DataFrame, seed: int) -> DataFrame:
    """The index's rows in an order that depends on `seed` alone."""
    return index.orderBy(F.xxhash64(F.lit(seed), "shard_no", "offset"), "shard_no", "offset")


def _spans(rows: Iterable[tuple[str, int, int]]) -> Iterator[list[tuple[str, int, int]]]:
    """Runs of rows that lie next to each other in one shard, READ_BYTES at most unless one row is longer."""
    run: list[tuple[str, int, int]] = []
    for row in rows:
        if run and (row[0] != run[-1][0] or row[1] != run[-1][1] + run[-1][2] or row[1] + row[2] - run[0][1] > READ_BYTES):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def read(index: DataFrame, folder: str) -> DataFrame:
    """The rows of `index` with what their records hold: found_id, ids (u32 little-endian) and ids_crc32."""
    def fetch(batch: pa.RecordBatch) -> pa.RecordBatch:
        fs, base = _open(folder)
        places = zip(*(batch.column(c).to_pylist() for c in ("shard", "offset", "length")), strict=True)
        found, ids, name, file = [], [], None, None
        for run in _spans(places):
            if run[0][0] != name:
                if file is not None:
                    file.close()
                name, file = run[0][0], fs.open_input_file(f"{base}/{run[0][0]}")
            data = file.read_at(run[-1][1] + run[-1][2] - run[0][1], run[0][1])
            for _, offset, length in run:
                try:
                    payload = unframe(data[offset - run[0][1]:offset - run[0][1] + length])
                except ValueError as e:
                    raise ValueError(f"{e} in {name} at {offset}") from e
                doc_id, own = parts_of(payload)
                found.append(doc_id)
                ids.append(own)
        if file is not None:
            file.close()
        more = [pa.array(found, pa.int64()), pa.array(ids, pa.binary()), pa.array([zlib.crc32(x) for x in ids], pa.int64())]
        return pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "found_id", "ids", "ids_crc32"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in index.schema.fields)
    return map_batches(index, fetch, f"{fields}, found_id bigint, ids binary, ids_crc32 bigint")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the records of `docs` to the shared folder and read them back: doc_id, start, n_tokens, ids_crc32."""
    folder = scratch_path(docs.sparkSession, "llm-records")
    found = read(write(docs, folder, tokenizer, end_id), folder)
    return found.select(F.col("found_id").alias("doc_id"), "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), "ids_crc32")
