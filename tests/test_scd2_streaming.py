"""SCD2 semantics on hand-made batches; incremental ingest, late data, partition pruning."""

import datetime as dt

from pyspark.sql import functions as F

from goldleaf import contracts as C
from goldleaf.operators.quality import scd2_violations
from goldleaf.operators.scd2 import scd2_apply
from goldleaf.session import scratch_path
from goldleaf.sources import files as IO
from goldleaf.streaming import ingest as ING
from goldleaf.streaming.late import partition_scoped_merge

D = dt.date
TS = dt.datetime


def stage(spark, rows):
    """rows: (op, merchant_id, valid_from date, name)."""
    schema = ", ".join(f"{c} {C.MERCHANT_STAGE_TYPES[c].simpleString()}" for c in C.MERCHANT_STAGE_COLUMNS)
    data = []
    for op, mid, vf, name in rows:
        t = TS(vf.year, vf.month, vf.day, 12)
        rec = {c: None for c in C.MERCHANT_STAGE_COLUMNS}
        rec.update(cdc_op=op, cdc_timestamp=t, merchant_id=mid, merchant_name=name, valid_from=vf,
                   valid_to=D(9999, 12, 31), is_active=True, created_at=TS(2023, 1, 1), updated_at=t)
        data.append(tuple(rec[c] for c in C.MERCHANT_STAGE_COLUMNS))
    return spark.createDataFrame(data, schema)


def versions(dim, mid):
    return [(r["merchant_key"], r["merchant_name"], r["valid_from"], r["valid_to"], r["is_active"])
            for r in dim.filter(F.col("merchant_id") == mid).orderBy("merchant_key").collect()]


def test_scd2_compat_quirks(spark):
    dim0 = scd2_apply(None, stage(spark, [("I", 1, D(2024, 1, 1), "a"), ("I", 2, D(2024, 1, 1), "b"),
                                          ("D", 3, D(2024, 1, 1), "c")]))
    assert dim0.count() == 2  # deletes are ignored
    batch = stage(spark, [("U", 1, D(2024, 2, 1), "a2"), ("U", 1, D(2024, 3, 1), "a3"),  # two updates
                          ("I", 2, D(2024, 2, 1), "b2"),                                  # repeated insert
                          ("U", 4, D(2024, 2, 1), "d")])                                  # unknown merchant
    dim1 = scd2_apply(dim0, batch)
    # the earliest update closes the old row; both updates become active versions
    assert versions(dim1, 1) == [(1, "a", D(2024, 1, 1), D(2024, 1, 31), False),
                                 (3, "a2", D(2024, 2, 1), D(9999, 12, 31), True),
                                 (4, "a3", D(2024, 3, 1), D(9999, 12, 31), True)]
    # a repeated I does not expire: two active rows
    assert [v[-1] for v in versions(dim1, 2)] == [True, True]
    assert versions(dim1, 4) == [(6, "d", D(2024, 2, 1), D(9999, 12, 31), True)]
    # same-day update: valid_to ends before valid_from
    dim2 = scd2_apply(dim1, stage(spark, [("U", 4, D(2024, 2, 1), "d2")]))
    closed = [v for v in versions(dim2, 4) if not v[-1]]
    assert closed == [(6, "d", D(2024, 2, 1), D(2024, 1, 31), False)]


def test_scd2_strict_chains_versions(spark):
    dim0 = scd2_apply(None, stage(spark, [("I", 1, D(2024, 1, 1), "a"), ("I", 2, D(2024, 1, 1), "b")]), "strict")
    batch = stage(spark, [("U", 1, D(2024, 2, 1), "a2"), ("U", 1, D(2024, 3, 1), "a3"),
                          ("I", 2, D(2024, 2, 1), "b2"), ("U", 1, D(2024, 3, 1), "a3")])
    dim1 = scd2_apply(dim0, batch, "strict")
    assert versions(dim1, 1) == [(1, "a", D(2024, 1, 1), D(2024, 1, 31), False),
                                 (3, "a2", D(2024, 2, 1), D(2024, 2, 29), False),
                                 (4, "a3", D(2024, 3, 1), D(9999, 12, 31), True)]
    assert [v[-1] for v in versions(dim1, 2)] == [False, True]  # repeated I acts as an update
    assert scd2_violations(dim1).count() == 0
    compat = scd2_apply(scd2_apply(None, stage(spark, [("I", 1, D(2024, 1, 1), "a")])),
                        stage(spark, [("U", 1, D(2024, 2, 1), "a2"), ("U", 1, D(2024, 3, 1), "a3")]))
    assert scd2_violations(compat).count() == 1


def test_stream_processes_only_new_files(spark):
    root = scratch_path(spark, "t-stream")
    schema = C.all_string_schema(["id", "v"])
    src, target, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    transform = lambda b: b.withColumn("v", F.col("v").cast("int"))
    IO.write_raw_csv(spark.createDataFrame([("1", "10"), ("2", "20")], schema), f"{src}/d1")
    ING.ingest_available(ING.csv_stream(spark, src, schema), transform, target, ckpt)
    ING.ingest_available(ING.csv_stream(spark, src, schema), transform, target, ckpt)  # nothing new
    assert ING.read_ingested(spark, target).count() == 2
    IO.write_raw_csv(spark.createDataFrame([("3", "30")], schema), f"{src}/d2")
    ING.ingest_available(ING.csv_stream(spark, src, schema), transform, target, ckpt)
    assert sorted(r[0] for r in ING.read_ingested(spark, target).select("id").collect()) == ["1", "2", "3"]


def test_dedup_stream_within_watermark(spark):
    root = scratch_path(spark, "t-dedup")
    schema = C.all_string_schema(["id", "ts"])
    src = f"{root}/in"
    rows = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-03 00:00:00"), ("b", "2024-01-02 00:00:00")]
    IO.write_raw_csv(spark.createDataFrame(rows, schema), f"{src}/d1")
    stream = ING.csv_stream(spark, src, schema).withColumn("ts", ING.event_time("ts"))
    q = (ING.dedup_stream(stream, ["id"], "ts", "7 days").writeStream.format("memory").queryName("dedup_out")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r[0] for r in spark.sql("SELECT id FROM dedup_out").collect()) == ["a", "b"]


def test_partition_scoped_merge_reads_only_touched_partitions(spark):
    path = scratch_path(spark, "t-t4")
    schema = "id string, v int, year string, month string"
    existing = spark.createDataFrame([("1", 1, "2024", "01"), ("2", 1, "2024", "02")], schema)
    IO.write_partitioned(existing, path, ["year", "month"])
    batch = spark.createDataFrame([("2", 1, "2024", "02"), ("3", 1, "2024", "02")], schema)
    parts = partition_scoped_merge(spark, path, batch, ["year", "month"], ["id"], schema=batch.schema)
    assert parts == [("2024", "02")]
    out = spark.read.schema(batch.schema).parquet(path)
    assert sorted(tuple(r) for r in out.collect()) == [("1", 1, "2024", "01"), ("2", 1, "2024", "02"),
                                                        ("3", 1, "2024", "02")]
    # the merge reads the target through this predicate: it must prune to the touched folder
    from goldleaf.streaming.late import partition_predicate
    scan = spark.read.schema(batch.schema).parquet(path).filter(partition_predicate(["year", "month"], parts))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    pf = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in pf and "month" in pf and "2024" in pf and "02" in pf


def test_lookup_reads_push_filter_and_projection(spark):
    from goldleaf.sources import warehouse as W
    path = scratch_path(spark, "t-dim")
    spark.createDataFrame([(1, 10, True, "x"), (1, 9, False, "y")],
                          "merchant_id long, merchant_key long, is_active boolean, merchant_name string") \
        .write.parquet(path)
    df = W.active_merchant_keys(spark, path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(is_active), EqualTo(is_active,true)]" in plan
    assert "merchant_name" not in plan.split("ReadSchema:")[1].split("\n")[0]
    assert [tuple(r) for r in df.collect()] == [(1, 10)]


def test_scd2_strict_same_day_supersedes_without_overlap(spark):
    dim0 = scd2_apply(None, stage(spark, [("I", 1, D(2024, 1, 1), "a")]), "strict")
    dim1 = scd2_apply(dim0, stage(spark, [("U", 1, D(2024, 1, 1), "a2")]), "strict")
    assert versions(dim1, 1) == [(1, "a", D(2024, 1, 1), D(2023, 12, 31), False),
                                 (2, "a2", D(2024, 1, 1), D(9999, 12, 31), True)]
    assert scd2_violations(dim1).count() == 0
