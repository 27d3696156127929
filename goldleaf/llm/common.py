"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from goldleaf.session import ensure_checkpoint_dir, scratch_path

#: Rows of one Arrow batch: texts can be long, so batches are kept small.
ARROW_ROWS = 1024


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that the Arrow operators rely on."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: cuts the lineage."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """mapInArrow with a function of one batch; None drops the batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


def held_out(doc_id, parts: int, rest: int):
    """The contract's fold: crc32 of the id's text, modulo `parts`; null ids are held out of nothing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == rest, F.lit(False))


def hash_share(rows: DataFrame, key, most: int) -> DataFrame:
    """About `most` of the rows, those whose hash of `key` lies in a share set by their number.

    The share makes the chosen rows few before anything is sorted or sent on, at any size.
    """
    n = rows.count()
    share = min(1.0, most / n) if n else 1.0
    return rows.where(F.pmod(F.xxhash64(key), F.lit(2**31)) < F.lit(int(share * 2**31)))


def bounded_sample(labelled: DataFrame, label: str, key: str, most: int) -> DataFrame:
    """Distinct (key, label), at most `most` of each label, by a hash of the key: the bounded training sample.

    Each label's share of the hash range leaves a few rows over `most`; a rank over those
    few cuts the rest.  Labels are few (a learnt model's classes).
    """
    h = F.pmod(F.xxhash64(key), F.lit(2**31))
    limit = F.lit(-1)
    for value, n in labelled.groupBy(label).count().collect():
        limit = F.when(F.col(label) == F.lit(value), int(min(1.0, 1.3 * most / n) * 2**31)).otherwise(limit)
    few = labelled.where(h < limit).select(key, label).distinct()
    rank = F.row_number().over(Window.partitionBy(label).orderBy(h, key))
    return few.withColumn("__llm_rank", rank).where(F.col("__llm_rank") <= most).drop("__llm_rank")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of undirected (a, b) links: (node, component = smallest node).

    Alternating large-star and small-star steps (Kiveris et al. 2014).  Each step is a
    partially aggregated minimum and an equi-join, so neither a large group nor the link
    set is ever held by one task or the driver; each round is written to the shared folder.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    state = None
    while True:
        # large star: neighbours above u, and u itself, point to u's smallest neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        # small star: neighbours below u, and u itself, point to u's smallest neighbour
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = stored(small, name)
        seen = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if seen == state:
            break
        state = seen
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
