"""File sources and sinks: raw CSV extracts, partitioned Parquet, staging, snapshots."""

from __future__ import annotations

import csv
import urllib.parse
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.session import scratch_path, scratch_scope

# CSV dialect of the raw extracts: header row, comma, JSON inside quoted
# fields with doubled quotes, blanks are data.  One record per line keeps
# files splittable (many tasks per large file); set ``multi_line`` only for
# extracts whose quoted values contain line breaks (each file is then read by
# one task).
CSV_READ_OPTIONS = {
    "header": "true", "sep": ",", "quote": '"', "escape": '"', "multiLine": "false",
    "recursiveFileLookup": "true", "mode": "PERMISSIVE",
}
CSV_WRITE_OPTIONS = {
    "header": "true", "sep": ",", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    # JSON as text is many times its compressed size; a writing task's file is read by one task
    "compression": "gzip",
}


def csv_files(spark: SparkSession, path: str) -> DataFrame:
    """`path` and `length` of the data files below ``path`` that hold bytes; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", "length").filter(F.col("length") > 0))


def _first_line(path: str) -> str:
    """The first line of a file, decompressed by its extension."""
    name = f"file://{path[len('file:'):]}" if path.startswith("file:") and not path.startswith("file://") else path
    fs, at = pa.fs.FileSystem.from_uri(urllib.parse.quote(name, safe=":/%"))
    with fs.open_input_stream(at, compression="detect") as stream:
        data = b""
        while b"\n" not in data and (more := stream.read(1 << 16)):
            data += more
    return data.partition(b"\n")[0].decode("utf-8").rstrip("\r")


def csv_headers(paths: DataFrame) -> DataFrame:
    """`path` and `header` (its column names) of each file, opened in tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column("path").to_pylist()
            names = [next(csv.reader([_first_line(f).lstrip("\ufeff")]), []) for f in files]
            yield pa.RecordBatch.from_arrays([pa.array(files), pa.array(names, pa.list_(pa.string()))], ["path", "header"])

    # a file each is little work, but a slow one on object stores: dealt over all cores
    return paths.select("path").repartition(paths.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, "path string, header array<string>")


def read_raw_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
                 multi_line: bool = False) -> DataFrame:
    """Raw extract under ``path`` (subfolders included; or a list of files); every column is text.

    Columns go by each file's own header: files may order them differently or lack some,
    which read as NULL.  With ``schema`` (all-string) the result has its columns, and a
    header that names any other raises ValueError.  An empty field reads as NULL (``''`` is
    a null token, so cleaning treats both alike).  Headers are found in tasks; the driver sees
    the distinct ones, and the names of files only where there is more than one.  Files with
    equal headers are one scan.
    """
    one_root = isinstance(path, str)
    files = csv_files(spark, path) if one_root else spark.createDataFrame([(p,) for p in path], "path string")
    found = csv_headers(files).checkpoint(eager=True)
    headers = [tuple(r["header"]) for r in found.groupBy("header").count().orderBy("header").collect()]
    known = set(schema.fieldNames()) if schema is not None else None
    out = spark.createDataFrame([], schema) if schema is not None else None
    for header in headers:
        mine = found.filter(F.col("header") == F.array(*[F.lit(c) for c in header]).cast("array<string>"))
        if len(set(header)) < len(header) or known is not None and not set(header) <= known:
            raise ValueError(f"unexpected header {list(header)} in {mine.agg(F.min('path')).first()[0]}")
        group = path if len(headers) == 1 else [r["path"] for r in mine.orderBy("path").collect()]
        own = T.StructType([T.StructField(c, T.StringType()) for c in header])
        part = (spark.read.options(**CSV_READ_OPTIONS).option("multiLine", str(multi_line).lower())
                .option("enforceSchema", "false").schema(own).csv(group if isinstance(group, str) else list(group)))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no files under {path}")
    return out


def write_raw_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write an extract in the dialect ``read_raw_csv`` expects (blanks preserved)."""
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)


def read_parquet(spark: SparkSession, path: str, partition_types: dict[str, T.DataType] | None = None) -> DataFrame:
    """Parquet table; partition values are read as text unless typed here."""
    df = spark.read.parquet(path)
    for c, t in (partition_types or {}).items():
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast(t))
    return df


def cluster_for_write(df: DataFrame, keys: Sequence[str], sort_by: Sequence[str] = ()) -> DataFrame:
    """Group rows by ``keys`` before a partitioned write.

    ``REBALANCE`` asks AQE for partitions of a sensible size clustered by the
    keys: a folder holding a third of all rows is split across many tasks
    (instead of one task writing it all) and small folders are merged, so
    neither stragglers nor a flood of small files appear.  Sorting inside each
    task makes every task write its folders one after the other.
    """
    return df.hint("rebalance", *keys).sortWithinPartitions(*keys, *sort_by)


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], mode: str = "append",
                      sort_by: Sequence[str] = ()) -> None:
    """Hive-partitioned Parquet (``key=value`` folders); NULL goes to the default folder."""
    cluster_for_write(df, keys, sort_by).write.mode(mode).partitionBy(*keys).parquet(path)


# Settings of write_partitioned_in_place: a task's input, and the folders it may write to at a time.
IN_PLACE_CONF = {"spark.sql.files.maxPartitionBytes": "128m", "spark.sql.maxConcurrentOutputFileWriters": "200"}


def write_partitioned_in_place(df: DataFrame, path: str, keys: Sequence[str], mode: str = "append") -> None:
    """``write_partitioned`` without a shuffle or sort: each task writes its rows to all their folders.

    For wide rows that lie in stored files: a folder gets a file from each task, so tasks read
    more at a time (a small table still has one for each core).  Beyond the writers that
    may be open at once Spark sorts the rest of the task's rows.
    """
    conf = df.sparkSession.conf
    before = {k: conf.get(k, None) for k in IN_PLACE_CONF}
    try:
        for k, v in IN_PLACE_CONF.items():
            conf.set(k, v)
        df.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(*keys).parquet(path)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def write_snapshot(df: DataFrame, root: str, table: str) -> str:
    """Write ``df`` as a new immutable snapshot folder; returns its path."""
    path = f"{root.rstrip('/')}/{table}/snapshot={uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").parquet(path)
    return path


def store(df: DataFrame, name: str = "stored") -> DataFrame:
    """``df`` computed once into a fresh Parquet folder of the shared scratch folder, and read back.

    Like a checkpoint this cuts the lineage, but the rows are compressed and later reads take
    only the columns they need; partitions and their order are not kept.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_of(spark: SparkSession, build: Callable[[], DataFrame], name: str = "stored") -> DataFrame:
    """``store(build())``; what ``build`` itself stores on the way is deleted once the rows are written."""
    path = scratch_path(spark, name)
    with scratch_scope(spark):
        df = build()
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_staging(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Staging table: ``overwrite`` replaces it (truncate + load); ``append`` adds."""
    df.write.mode(mode).parquet(path)
    return path


def initialize_table(spark: SparkSession, path: str, schema: T.StructType,
                     partition_by: Sequence[str] = ()) -> str:
    """Create an empty table with a fixed schema (drop-and-create)."""
    writer = spark.createDataFrame([], schema).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_clustered_fact(df: DataFrame, path: str, mode: str = "append", presorted: bool = False) -> None:
    """Fact layout: folders by year/month, rows sorted by date key then merchant
    inside each file (min/max statistics make date and merchant filters prune).

    ``presorted``: ``df`` is already range-partitioned and sorted in that order
    (as keyed fact rows are), so no shuffle is added; each task writes its
    contiguous slice.
    """
    keys, order = ["year", "month"], ["transaction_date_key", "merchant_key"]
    if presorted:
        (df.sortWithinPartitions(*keys, *order).write.mode(mode)
         .option("partitionOverwriteMode", "static").partitionBy(*keys).parquet(path))
    else:
        write_partitioned(df, path, keys, mode, sort_by=order)


def run_if_nonempty(df: DataFrame, action: Callable[[DataFrame], object], name: str = "source"):
    """Skip ``action`` when ``df`` has no rows (checked with ``isEmpty``: one row read)."""
    if df.isEmpty():
        print(f"no data for {name}; skipped")
        return None
    return action(df)


def source_counts(sources: dict[str, DataFrame]) -> DataFrame:
    """One row per source: name, row count, whether a run would skip it."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("source"), "row_count")
             for name, df in sources.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("skipped", F.col("row_count") == 0)
