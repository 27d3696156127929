"""Merkle manifest of a dataset: 16-ary hash trees over rows, with a proof for each row.

A leaf is a row's digest.  Leaves of a group (a source) are ranked; while a group has more
than one node, every 16 consecutive nodes (the last run: fewer, even one) become the digest
of their digests' concatenation.  What remains is the group's subroot, and the subroots,
ordered by group, give the root by the same rule.

The rank's base-16 digits are columns.  Inside a block of 4,096 ranks they are grouped away
one after the other, each grouping nesting the child structs, so a block is one row of
bounded size; the blocks' digests are the next tier's nodes, until a group has one block.
On the way down every tier's block meets its own proof in a grouping of the two rows, and
transform and explode hand each child the digests left and right of it.  No join, no group
larger than a block: a source with a third of all rows is many blocks.

Ranks need no window over a group: rows are range-partitioned by (group, order) and
numbered inside each partition; only the first group of a partition can have begun before,
so one number per partition passes through the driver.

Groups: null comes first, then by UTF-8 bytes.  Rows of a group: null order values first,
ties by digest; a repeated row is a leaf of its own.  An empty table gives no rows.  Only
the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import stored

#: Children of a node are 2**BITS; a block nests LEVELS levels, so it holds 4,096 ranks.
BITS, LEVELS = 4, 3
_PATH = "array<struct<l:string,r:string>>"


def field(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the fields' concatenation."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _ranked(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """`rows` (grp, ...) with `rank`, the position inside its grp by `order`; without the order."""
    keys = [F.col(c).asc_nulls_first() for c in ("grp", *order)]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, pos, at, last = TaskContext.get().partitionId(), 0, -1, object()
        for batch in batches:
            ats = []
            for g in batch.column("grp").to_pylist():
                at = at + 1 if g == last else 0
                last = g
                ats.append(at)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([pid] * n, pa.int32()), pa.array(range(pos, pos + n), pa.int64()), pa.array(ats, pa.int64())],
                [*batch.schema.names, "pid", "pos", "at"])
            pos += n

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    fixed = stored(rows.mapInArrow(number, f"{fields}, pid int, pos bigint, at bigint"), f"{name}-rows")
    spark = rows.sparkSession
    # one row for each partition: where its first and last groups stand
    parts = fixed.groupBy("pid").agg(
        F.count("*").alias("n"), F.count_if(F.col("at") == F.col("pos")).alias("first_n"), F.max_by("at", "pos").alias("last_at"),
        F.min_by(F.struct("grp"), "pos").alias("first"), F.max_by(F.struct("grp"), "pos").alias("last")).orderBy("pid").collect()
    offsets, grp, seen = [], None, 0
    for p in parts:
        offset = seen if grp is not None and grp == p["first"] else 0
        offsets.append((p["pid"], offset))
        seen = offset + p["n"] if p["first_n"] == p["n"] else p["last_at"] + 1
        grp = p["last"]
    # as many rows as the table has partitions
    starts = F.broadcast(spark.createDataFrame(offsets, "pid int, offset bigint"))
    rank = F.col("at") + F.when(F.col("at") == F.col("pos"), F.col("offset")).otherwise(F.lit(0))
    return fixed.join(starts, "pid").select("grp", rank.alias("rank"), *[c for c in rows.columns if c not in ("grp", *order)])


def _tier(nodes: DataFrame, first_level: int) -> DataFrame:
    """grp, block, and the block's node: nodes (grp, rank, digest, top, height, data) nested by rank digits.

    `top` is the digest that stands for the node if it is the only one of its group, that is
    without the levels at which it has no neighbour; `height` counts the levels in `top`.
    """
    digit = lambda k: F.shiftright("rank", BITS * k).bitwiseAND(2**BITS - 1).cast("int")
    digits = [f"d{k}" for k in range(LEVELS)]
    out = nodes.select("grp", F.shiftright("rank", BITS * LEVELS).alias("block"), *[digit(k).alias(d) for k, d in enumerate(digits)],
                       "digest", "top", "height", "data").repartition("grp", "block")
    inner = "data"
    for k, d in enumerate(digits):
        kids = F.sort_array(F.collect_list(F.struct(d, "digest", "top", "height", inner)))
        grouped = out.groupBy("grp", "block", *digits[k + 1:]).agg(kids.alias("kids"))
        many = F.size("kids") > 1
        joined = F.sha2(F.array_join(F.transform("kids", lambda x: x["digest"]), ""), 256)
        only = F.element_at("kids", 1)
        out = grouped.withColumn("digest", joined).withColumns({
            "top": F.when(many, F.col("digest")).otherwise(only["top"]),
            "height": F.when(many, F.lit(first_level + k)).otherwise(only["height"])})
        inner = "kids"
    return out


def _up(leaves: DataFrame, order: Sequence[str], name: str) -> list[DataFrame]:
    """The tiers over `leaves` (grp, order, digest, data), lowest first; the last has one block for each grp."""
    nodes = _ranked(leaves, order, name).select("grp", "rank", "digest", F.col("digest").alias("top"), F.lit(0).alias("height"), "data")
    tiers: list[DataFrame] = []
    while True:
        tier = stored(_tier(nodes, 1 + LEVELS * len(tiers)), f"{name}-tier{len(tiers)}")
        tiers.append(tier)
        if not tier.agg(F.max("block")).first()[0]:
            return tiers
        nodes = tier.select("grp", F.col("block").alias("rank"), "digest", "top", "height", F.lit(None).cast("int").alias("data"))


def _down(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """Leaves (grp, data, path, up): `above` (grp, path, up) holds each grp's path beyond its top."""
    height = tiers[-1].select("grp", "height")
    # the group's height travels with its path
    paths = _met(height.select("grp", F.lit(0).cast("bigint").alias("block"), F.struct("height").alias("a")),
                 above.select("grp", F.lit(0).cast("bigint").alias("block"), F.struct("path", "up").alias("b")))
    paths = paths.select("grp", "block", F.struct(F.col("b.path").alias("path"), F.col("b.up").alias("up"), F.col("a.height").alias("height")).alias("b"))
    for t in range(len(tiers) - 1, -1, -1):
        met = _met(tiers[t].select("grp", "block", F.struct("kids").alias("a")), paths)
        df = met.select("grp", "block", F.col("a.kids").alias("kids"), F.col("b.path").alias("path"), F.col("b.up").alias("up"), F.col("b.height").alias("height"))
        for k in range(LEVELS - 1, -1, -1):
            digests = F.transform("kids", lambda x: x["digest"])
            df = df.select("grp", "block", "path", "up", "height", digests.alias("ds"), F.posexplode("kids").alias("i", "kid"))
            beside = F.struct(F.array_join(F.slice("ds", F.lit(1), F.col("i")), "").alias("l"),
                              F.array_join(F.slice("ds", F.col("i") + 2, F.lit(2**BITS)), "").alias("r"))
            path = F.when(F.col("height") >= 1 + LEVELS * t + k, F.concat(F.array(beside), "path")).otherwise(F.col("path"))
            child = (F.col("block") * 2**BITS + F.col(f"kid.d{k}")).alias("block")
            df = df.select("grp", child, path.alias("path"), "up", "height", F.col("kid.kids" if k else "kid.data").alias("kids"))
        if t:
            paths = df.select("grp", "block", F.struct("path", "up", "height").alias("b"))
    return df.select("grp", F.col("kids").alias("data"), "path", "up")


def _met(a: DataFrame, b: DataFrame) -> DataFrame:
    """The two rows of each (grp, block), one of `a` and one of `b`, as one row: a grouping, not a join."""
    kinds = {f.name: f.dataType for df in (a, b) for f in df.schema.fields}
    both = a.withColumn("b", F.lit(None).cast(kinds["b"])).unionByName(b.withColumn("a", F.lit(None).cast(kinds["a"])))
    return both.groupBy("grp", "block").agg(F.first("a", ignorenulls=True).alias("a"), F.first("b", ignorenulls=True).alias("b"))


def manifest(rows: DataFrame, group: str, order: str, leaf: Column, *carried: Column) -> DataFrame:
    """One row for each row of `rows`: `leaf`, `subroot`, `root`, `path` and the `carried` columns.

    `path` holds, from the leaf to the root, the digests left and right of the row's node
    at each level, concatenated: fold() over it gives the root.
    """
    leaves = rows.select(F.col(group).alias("grp"), F.col(order).alias("ord"), leaf.alias("digest"), *carried)
    data = F.struct(F.col("digest").alias("leaf"), *[c for c in leaves.columns if c not in ("grp", "ord", "digest")])
    leaves = leaves.select("grp", "ord", "digest", F.col("digest").alias("tie"), data.alias("data"))
    tiers = _up(leaves, ["ord", "tie"], "merkle")
    subroots = tiers[-1].select(F.lit(0).alias("grp"), F.col("grp").alias("ord"), F.col("top").alias("digest"),
                                F.struct(F.col("grp").alias("source"), F.col("top").alias("subroot")).alias("data"))
    tops = _up(subroots, ["ord"], "merkle-top")
    above = tops[-1].select("grp", F.array().cast(_PATH).alias("path"), F.col("top").alias("up"))
    groups = _down(tops, above)
    ups = groups.select(F.col("data.source").alias("grp"), "path", F.struct(F.col("data.subroot").alias("subroot"), F.col("up").alias("root")).alias("up"))
    return _down(tiers, ups).select("data.*", "up.subroot", "up.root", "path")


def fold(path: Column, leaf: Column) -> Column:
    """The root that `leaf` and the digests beside its path give."""
    return F.aggregate(path, leaf, lambda node, beside: F.sha2(F.concat(beside["l"], node, beside["r"]), 256))


def beside_sha256(path: Column) -> Column:
    """Digest of all digests beside the path, from the leaf upwards."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["l"], p["r"])), ""), 256)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def tamper_check(docs: DataFrame) -> DataFrame:
    """The manifest of documents by source, with every fifth row (by its id's crc32) tampered and checked.

    doc_id, leaf, subroot, root and proof_sha256 are those of the untampered rows; folded_root
    is recomputed from the leaf as it is after lower-casing A-Z of the text.
    """
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tampered = F.when(chosen, digest(*columns, F.translate(text, _UPPER, _UPPER.lower())))
    found = manifest(docs, "source", "doc_id", digest(*columns, text), F.col("doc_id"), tampered.alias("tampered"))
    folded = found.select("doc_id", "leaf", "subroot", "root", beside_sha256(F.col("path")).alias("proof_sha256"),
                          fold(F.col("path"), F.coalesce("tampered", "leaf")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
