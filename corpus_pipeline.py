"""Corpus pipeline: language ID, line dedup, near-dedup, decontamination, tokens.

Each stage is (name, function) with function(spark, docs, sf_dir) -> DataFrame; run() writes
each result as Parquet in the shared folder and rereads it as the next stage's docs.  All
but the last return the columns of docs.

* language       rejects texts without a letter and those unlike the language they are judged
                 to be, by a cut of each language's own (langid_svm); the model is learnt from
                 docs with a language.
* line_dedup     takes repeated long lines out of all documents but the largest doc_id.
* near_dedup     keeps the smallest doc_id of each group of near copies.
* decontaminate  drops documents that hold a benchmark item.
* tokens         doc_id, n_tokens, ids (little-endian unsigned 32-bit) and decoded_sha256.

Rows with nulls are judged like empty texts by each operator's own rules; tables without
rows give no rows.  Extra columns pass through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm import bpe_bitmap, decontam_simhash, langid_svm, line_cuckoo, superminhash
from goldleaf.llm.common import held_out, prepare, read_table, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = langid_svm.fit(docs.where(~held_out(F.col("doc_id"), 4, 2)).select("doc_id", "text", "lang"))
    return langid_svm.keep_known(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return line_cuckoo.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return superminhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontam_simhash.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe_bitmap.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("tokens", tokens)]

#: The trained, hashed and tokenizing stages have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
