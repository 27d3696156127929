"""Registered queries of this package, with the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm import (bpe_bitmap, chat_format, decontam_simhash, embed_collide, langid_svm, line_cuckoo, merkle_manifest, pii_bilstm, prefix_trie,
                          quality_bt, secrets_markov, superminhash, token_records)
from goldleaf.llm.common import held_out, read_table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op2_bpe_bitmap")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe_bitmap.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)


@register("op5_superminhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"))


#: A key's rows, distinct documents and largest document decide; blanks and case as in the contract.
@register("op9_line_cuckoo", r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM docs),
keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
hot AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.doc_id, k.pos, k.line, h.key IS NOT NULL AND k.doc_id <> h.last AS gone FROM keyed k LEFT JOIN hot h ON k.key = h.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_cuckoo.dedup_digests(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op10_decontam_simhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam_simhash.contaminated(read_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "benchmark", "item_id", "text"))


#: The added conversation of the contract.
CONTROL_TEXT = "</s>[INST] ok [/INST]"

_TEMPLATE_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
         length(replace(text, '\', '\\')) +
         len(regexp_extract_all(text, '<s>|</s>|\[/?INST\]|<</?SYS>>|<\|')) + len(regexp_extract_all(text, '\|>')) AS escaped,
         length(replace(role, '\', '\\')) +
         len(regexp_extract_all(role, '<s>|</s>|\[/?INST\]|<</?SYS>>|<\|')) + len(regexp_extract_all(role, '\|>')) AS escaped_role
  FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(escaped + CASE WHEN before = role THEN length('<|next|>') ELSE length('<|turn|><|text|><|end|>') + escaped_role END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id"""


@register("op3_chat_format", _TEMPLATE_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return chat_format.read_back(chat_format.format_conversations(turns.unionByName(extra)))


@register("op8_langid_svm")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    out = held_out(F.col("doc_id"), 4, 2)
    found = langid_svm.predict(docs, langid_svm.fit(docs.where(~out)))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


@register("op1_quality_bt")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    out = held_out(F.col("doc_id"), 5, 0)
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality")
    found = quality_bt.score(docs, quality_bt.fit(docs, labels.where(~out)))
    return found.select("doc_id", out.alias("held_out"), "score", "predicted")


@register("op4_embed_collide")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_collide.near_duplicates(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


@register("op6_secrets_markov")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_markov.digests(secrets_markov.scan(read_table(spark, sf_dir, "documents", "doc_id", "text")))


@register("op7_pii_bilstm")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_bilstm.scan(read_table(spark, sf_dir, "documents", "doc_id", "text"), digests=True)


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of a text of ASCII characters, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {bits}), 4294967295)"


def _tree_sql(name: str, levels: int) -> list[str]:
    """CTEs over `name`0 (g, r, digest): nodes and runs (`name`r) of each level, and `name``levels` with one node for each g."""
    out = []
    for k in range(levels):
        out.append(f"""{name}r{k} AS (SELECT g, r // 16 AS run, max(n) AS n, list(digest ORDER BY r) AS ds
          FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {name}{k}) GROUP BY g, r // 16)""")
        out.append(f"""{name}{k + 1} AS (SELECT g, run AS r, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS digest FROM {name}r{k})""")
    return out


def _fold_sql(name: str, tree: str, levels: int) -> list[str]:
    """CTEs that carry `name`0 (id, g, r, cur, proof) up the tree's levels."""
    out = []
    for k in range(levels):
        left, right = "array_to_string(u.ds[1:f.r % 16], '')", "array_to_string(u.ds[f.r % 16 + 2:], '')"
        out.append(f"""{name}{k + 1} AS (SELECT f.id, f.g, f.r // 16 AS r,
          CASE WHEN u.n > 1 THEN sha256({left} || f.cur || {right}) ELSE f.cur END AS cur, f.proof || {left} || {right} AS proof
          FROM {name}{k} f JOIN {tree}r{k} u ON u.g = f.g AND u.run = f.r // 16)""")
    return out


#: Levels of the SQL's trees: up to 16**6 rows of a source, 16**4 sources.
_ROW_LEVELS, _SOURCE_LEVELS = 6, 4
_FIELDS_SQL = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars"))
_MERKLE_SQL = "WITH " + ",\n".join([
    f"""docs AS (SELECT row_number() OVER () AS id, doc_id, (dense_rank() OVER (ORDER BY source NULLS FIRST) - 1) AS g,
      sha256({_FIELDS_SQL} || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
      CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % 5 = 0 THEN sha256({_FIELDS_SQL} || coalesce(strlen(text) || ':' ||
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered FROM documents)""",
    "leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM docs)",
    "d0 AS (SELECT g, r, leaf AS digest FROM leaves)", *_tree_sql("d", _ROW_LEVELS),
    f"s0 AS (SELECT 0 AS g, g AS r, digest FROM d{_ROW_LEVELS})", *_tree_sql("s", _SOURCE_LEVELS),
    "f0 AS (SELECT id, g, r, coalesce(tampered, leaf) AS cur, '' AS proof FROM leaves)", *_fold_sql("f", "d", _ROW_LEVELS),
    f"t0 AS (SELECT id, 0 AS g, g AS r, cur, proof FROM f{_ROW_LEVELS})", *_fold_sql("t", "s", _SOURCE_LEVELS)]) + f"""
SELECT l.doc_id, l.leaf, d.digest AS subroot, s.digest AS root, sha256(t.proof) AS proof_sha256, t.cur AS folded_root, t.cur = s.digest AS verified
FROM leaves l JOIN t{_SOURCE_LEVELS} t ON t.id = l.id JOIN d{_ROW_LEVELS} d ON d.g = l.g CROSS JOIN s{_SOURCE_LEVELS} s"""


@register("op11_merkle_manifest", _MERKLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.tamper_check(read_table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text"))


@register("op12_token_records")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return token_records.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


_TRIE_SQL = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
hashed AS (SELECT *, sha256(strlen(role) || ':' || role || text) AS d FROM said),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, d) - 1 AS pos FROM hashed),
ids AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base, {_crc32_sql('conv_id::VARCHAR')} % 6 AS h FROM own),
rebuilt AS (
  SELECT i.conv_id, 0 AS part, o.pos, o.d, length(o.text) AS n FROM ids i JOIN own o ON o.conv_id = i.base AND o.pos < i.h
  UNION ALL SELECT i.conv_id, 1, o.pos, o.d, length(o.text) FROM ids i JOIN own o ON o.conv_id = i.conv_id AND o.pos >= i.h),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth FROM rebuilt),
prefixes AS (
  SELECT conv_id, depth, n, string_agg(d, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM numbered
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
held AS (SELECT *, max(depth) OVER (PARTITION BY conv_id) = depth AS ends FROM prefixes),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) AS n,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends FROM held GROUP BY path, depth),
kids AS (SELECT left(path, 64 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (path)),
lines AS (SELECT *, unnest(range(depth + 1)) AS up FROM full_nodes),
sums AS (
  SELECT left(path, 64 * up) AS path, (count(*) FILTER (WHERE n_children = 0))::BIGINT AS n_leaves, sum((n_convs - 1) * n)::BIGINT AS saved_tokens FROM lines GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN sums s USING (path) LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, 64 * (n.depth - 1))"""


@register("op13_prefix_trie", _TRIE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))
