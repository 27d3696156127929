"""Registered queries of the subpackage against their SQL, and the pipeline against its stages by brute force."""

import hashlib

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from check_oracle import digest
from goldleaf.llm import bpe_bitmap, langid_svm
from goldleaf.llm import queries as Q

from conftest import SMOKE_DIR


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = Q.QUERIES[name](spark, SMOKE_DIR)
    res = duck.execute(Q.ORACLE[name])
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    srows = [tuple(r) for r in sdf.collect()]
    assert sorted(sdf.columns) == sorted(dcols) and len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES) == list(range(1, 14))


def without_repeated_lines(docs):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(brute.UPPER)
    held = {}
    for i, t in docs:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 40:
                held.setdefault(k, set()).add(i)
    last = {k: max(s) for k, s in held.items() if len(s) >= 5}
    return [(i, "\n".join(x for x in t.split("\n") if last.get(key(x), i) == i)) for i, t in docs]


def test_pipeline_equals_its_stages_by_brute_force(spark):
    table = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet").collect()]
    first = corpus_pipeline.language(spark, table, SMOKE_DIR)
    assert first.columns == table.columns
    docs = [(r.doc_id, r.text) for r in first.collect()]
    assert len(docs) >= 0.99 * table.count() and all(langid_svm.grams(t) is not None for _, t in docs)
    docs = without_repeated_lines(docs)
    near = brute.near_duplicates(docs)
    docs = [(i, t) for i, t in docs if near[i][1] == i]
    bad = {i for i, _ in brute.contaminated(docs, items)}
    docs = [(i, t) for i, t in docs if i not in bad]
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe_bitmap.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    want = {i: (np.array(enc.encode_ordinary(t), "<u4").tobytes(), hashlib.sha256(t.encode()).hexdigest()) for i, t in docs}
    got = {r.doc_id: (bytes(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, SMOKE_DIR).collect()}
    assert got == want


def test_pipeline_passes_extra_columns_and_empty_tables(spark):
    table = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").selectExpr("*", "1 AS node", "'x' AS key", "2 AS shard")
    for docs in (table, table.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SMOKE_DIR)
            assert docs.columns == table.columns
        assert docs.select("node", "key", "shard").distinct().count() <= 1
