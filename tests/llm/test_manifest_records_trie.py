"""Manifest, token records and prefix trie against brute force, the tokenizers library and the edge cases of their docstrings."""

import random
import struct
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from goldleaf.llm import merkle_manifest, prefix_trie, token_records
from goldleaf.llm.common import prepare
from goldleaf.session import scratch_path

from conftest import SMOKE_DIR

WORDS = public_tokenizers.path("word_bpe_49k.json")
LONG = "Lorem ipsum dolor " * 20000


def same(df, want):
    got = sorted((tuple(r) for r in df.collect()), key=str)
    assert got == sorted(want, key=str)


# --- 11 manifest -----------------------------------------------------------------

# clashing names that the operator uses inside
DOCS = "doc_id long, source string, lang string, n_chars long, text string, grp int, rank int, top string, kids int, path string"


def docs_of(rows):
    return [(*r, 1, 2, "t", 3, "p") for r in rows]


@pytest.mark.parametrize("sizes", [[1], [16, 1], [17, 2, 1], [4096, 1], [4097, 257, 16, 15], [1] * 40])
def test_manifest_of_trees_of_many_shapes(spark, sizes):
    rows = [(i * 7 + s, f"s{s}", None if i % 5 else "en", i, f"Text {i}") for s, n in enumerate(sizes) for i in range(n)]
    same(merkle_manifest.tamper_check(spark.createDataFrame(docs_of(rows), DOCS)), brute.manifest(rows))


def test_manifest_of_nulls_ties_and_long_texts(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, None, "en", 3, "A"), (1, None, "en", 3, "A"), (1, None, "en", 3, "B"),
            (2, "", "", 0, ""), (3, "é", "fr", 1, LONG), (4, "z", None, None, "É A"), (-5, "z", "de", -1, "x:y")]
    df = spark.createDataFrame(docs_of(rows), DOCS)
    same(merkle_manifest.tamper_check(df), brute.manifest(rows))
    assert merkle_manifest.tamper_check(df.limit(0)).count() == 0


def test_manifest_proofs_verify_and_change_with_any_field(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    leaf = merkle_manifest.digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    found = merkle_manifest.manifest(docs, "source", "doc_id", leaf, F.col("doc_id")).cache()
    folded = merkle_manifest.fold(F.col("path"), F.col("leaf"))
    assert found.where(folded != F.col("root")).count() == 0
    wrong = merkle_manifest.fold(F.col("path"), F.sha2("leaf", 256))
    assert found.where(wrong == F.col("root")).count() == 0
    assert found.select("root").distinct().count() == 1


def test_manifest_plan_nests_without_row_joins(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    plan = merkle_manifest.tamper_check(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" in plan


# --- 12 token records --------------------------------------------------------------

def expected(rows):
    tokenizer, at, out = Tokenizer.from_file(WORDS), 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_records_equal_the_tokenizers_library(spark):
    prepare(spark)
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    same(token_records.round_trip(docs, WORDS, 2), expected(rows))


def test_records_of_nulls_ties_and_long_texts(spark):
    prepare(spark)
    rows = [(None, "a b"), (-3, None), (1, ""), (2, "<|endoftext|> x"), (3, LONG), (3, LONG), (4, "漢字 " * 50), (5, "x" * 30000)]
    df = spark.createDataFrame([(*r, 1, "s", 2) for r in reversed(rows)], "doc_id long, text string, tie int, shard string, place int")
    same(token_records.round_trip(df, WORDS, 2), expected(rows))
    assert token_records.round_trip(df.limit(0), WORDS, 2).count() == 0


def test_pieces_give_the_ids_of_whole_texts():
    rnd = random.Random(5)
    pool = " \x01\n\t\r\x0b\x0c\x1c\x85\xa0\u3000\u0301\u0300éÉΣσς\'sS<|endoftext|>漢한각İŒ🙂\u200d1Ⅷ\u0308 a"
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 30))) for _ in range(20000)] + ["a \u0301b", "A\n\u0301", "x<|endoftext|> <|startoftext|>"]
    encode, tokenizer = token_records.Encoder(WORDS), Tokenizer.from_file(WORDS)
    want = [np.array(e.ids, "<u2").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert list(encode(texts)) == want
    # again from the store, and with a store that fills up
    assert list(encode(texts)) == want
    token_records.STORE_PIECES, kept = 100, token_records.STORE_PIECES
    try:
        small = token_records.Encoder(WORDS)
        assert [x for k in range(0, len(texts), 50) for x in small(texts[k:k + 50])] == want and len(small.old) + len(small.new) < 2000
    finally:
        token_records.STORE_PIECES = kept


def test_a_repeated_piece_is_looked_up_once():
    class Counted(dict):
        reads = 0

        def __getitem__(self, key):
            Counted.reads += 1
            return super().__getitem__(key)

    encode = token_records.Encoder(WORDS)
    encode.new = Counted()
    whole = Tokenizer.from_file(WORDS).encode("word other " * 5000, add_special_tokens=False)
    assert list(encode(["word other " * 5000, ""])) == [np.array(whole.ids, "<u2").tobytes(), b""] and Counted.reads < 10


def test_shuffled_reads_find_every_record_and_damage_is_seen(spark):
    prepare(spark)
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    folder = scratch_path(spark, "test-records")
    index = token_records.write(docs, folder, WORDS, 2)
    order = [r.doc_id for r in token_records.shuffled(index, 3).select("doc_id").collect()]
    assert order != sorted(order) and order == [r.doc_id for r in token_records.shuffled(index, 3).select("doc_id").collect()]
    mixed = token_records.read(token_records.shuffled(index, 3), folder)
    assert mixed.where("found_id <> doc_id").count() == 0 and mixed.count() == docs.count()
    # files of attempts that were not committed are in no row of the index
    (local := folder.removeprefix("file:"))
    with open(f"{local}/shard-000000-lost.rec", "wb") as f:
        f.write(b"half a record")
    assert token_records.read(index, folder).count() == docs.count()
    row = index.first()
    with open(f"{local}/{row.shard}", "r+b") as f:
        f.seek(row.offset + row.length - 6)
        f.write(b"\xff\xff")
    with pytest.raises(Exception, match="damaged record"):
        token_records.read(index, folder).collect()


def test_frames():
    for payload in (b"", b"x", bytes(range(256)) * 9):
        record = token_records.frame(payload)
        assert len(record) == len(payload) + 16 and token_records.unframe(record) == payload
        for k in range(len(record)):
            bad = bytearray(record)
            bad[k] ^= 1
            with pytest.raises(ValueError):
                token_records.unframe(bytes(bad))
    assert struct.unpack("<Q", token_records.frame(b"abc")[:8])[0] == 3


# --- 13 prefix trie ----------------------------------------------------------------

CHATS = "conv_id long, turn long, role string, text string, base int, path string, shard int, skeleton int, depth int, ts int"


def chats_of(rows):
    return [(*r, 1, "p", 2, 3, 4, 5) for r in rows]


@pytest.mark.parametrize("shards", [1, 3, 16, 90])
def test_trie_of_random_conversations(spark, shards):
    rnd = random.Random(shards)
    rows = []
    for c in range(-120, 400):
        kind = rnd.random()
        if kind < 0.2:
            continue
        n = 1 if kind < 0.3 else rnd.randint(1, 9)
        rows += [(c, t if rnd.random() < 0.97 else None, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "bb", "", None, "é🙂"])) for t in range(n)]
    df = spark.createDataFrame(chats_of(rows), CHATS).repartition(5)
    same(prefix_trie.trie(prefix_trie.rebuilt(df), shards), brute.trie(rows))


@pytest.mark.parametrize("shards", [2, 24])
def test_trie_of_equal_and_long_conversations(spark, shards):
    # most conversations equal, their ids in several pieces and shards; some longer than a splitter
    long = [(t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(prefix_trie.SPLITTER_TURNS + 20)]
    rows = [(c, *t) for c in range(0, 9) for t in long] + [(c, 0, "user", "hi") for c in range(1000, 9000, 1)] + [(9500, *t) for t in long * 3]
    same(prefix_trie.trie(prefix_trie.rebuilt(spark.createDataFrame(chats_of(rows), CHATS)), shards), brute.trie(rows))


def test_trie_of_nulls_and_no_rows(spark):
    rows = [(None, 0, "user", "x"), (5, None, None, None), (5, None, None, None), (7, 1, "user", "q"), (7, 1, "assistant", "q"), (7, None, "user", "z")]
    df = spark.createDataFrame(chats_of(rows), CHATS)
    same(prefix_trie.trie(prefix_trie.rebuilt(df)), brute.trie(rows))
    assert prefix_trie.trie(prefix_trie.rebuilt(df.limit(0))).count() == 0
