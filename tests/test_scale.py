"""What keeps the table queries within disk and time on larger tables: compressed extracts, one evaluation, narrow stored rows."""

import random

from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from goldleaf.operators.dedup import dedup_by, dedup_wide, row_hash_anti
from goldleaf.operators.joins import BROADCAST_BUDGET_CONF
from goldleaf.operators.keys import assign_surrogate_keys
from goldleaf.session import DEFAULT_CONF, TABLE_CONF, scratch_path
from goldleaf.sources import files as IO
from goldleaf.sources.state import _fs


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_extracts_are_compressed_and_read_back_whole(spark):
    rows = [(str(k), '{"a": "x, y", "b": "say \\"z\\""}' * 20, None if k % 3 else "  ") for k in range(500)]
    df = spark.createDataFrame(rows, "id string, doc string, note string")
    path = scratch_path(spark, "t-gz")
    IO.write_raw_csv(df, f"{path}/d1")
    names = [s.getPath().getName() for s in _fs(spark, f"{path}/d1")[0].listStatus(_fs(spark, f"{path}/d1")[1])]
    assert [n for n in names if n.startswith("part-")] and all(n.endswith(".csv.gz") for n in names if n.startswith("part-"))
    assert sorted(map(tuple, IO.read_raw_csv(spark, path, df.schema).collect()), key=str) == sorted(rows, key=str)


def test_keys_are_dense_and_rows_are_kept_as_parquet(spark):
    df = spark.range(1000, numPartitions=7).select((F.col("id") % 37).alias("a"), F.col("id").alias("b"), F.lit(None).cast("string").alias("n"))
    keyed = assign_surrogate_keys(df, "k", ["a", "b"], start=11, num_partitions=5)
    got = [tuple(r) for r in keyed.orderBy("k").collect()]
    assert [(a, b) for _, a, b, _ in got] == sorted((b % 37, b) for b in range(1000)) and [r[0] for r in got] == list(range(11, 1011))
    assert "parquet" in _plan(keyed)
    assert keyed.columns == ["k", "a", "b", "n"] and assign_surrogate_keys(df.limit(0), "k", ["a"]).count() == 0


def test_gold_queries_parse_silver_once_and_store_it_narrow(spark):
    from goldleaf.plans import catalog as K
    for name in ("fact_stage", "junk_lookup_two_deliveries"):
        plan = _plan(K.QUERIES[name](spark, SMOKE_DIR))
        assert "json_tuple" not in plan and "transaction_metadata" not in plan, name
    # one pass needs no stored silver
    assert "LogicalRDD" not in _plan(K.QUERIES["fact_derive"](spark, SMOKE_DIR))
    assert "json_tuple" not in _plan(K.QUERIES["dim_date_incremental"](spark, SMOKE_DIR))


def test_late_deliveries_are_cleaned_once(spark):
    from goldleaf.plans import catalog as K
    plan = _plan(K.QUERIES["late_dedup_7d"](spark, SMOKE_DIR))
    assert plan.count("json_tuple(gateway_response") <= 1


def test_table_settings_reach_table_queries_only(spark):
    from __spark_entry__ import queries
    conf = "spark.sql.codegen.hugeMethodLimit"
    assert conf in TABLE_CONF and conf not in DEFAULT_CONF
    before = {k: spark.conf.get(k, None) for k in TABLE_CONF}
    try:
        queries()["null_tokens"](spark, SMOKE_DIR)
        assert all(spark.conf.get(k) == v for k, v in TABLE_CONF.items())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- round 3: wide rows are chosen by narrow ones -----------------------------------------------

def _wide(spark, rows):
    return spark.createDataFrame(rows, "id string, at string, a string, b int, c string, d string")


def test_dedup_wide_equals_dedup_by(spark):
    rnd = random.Random(3)
    pick = lambda *v: rnd.choice(v)
    made = [(pick(None, "x", "y", str(k // 3)), pick(None, "t", "u"), pick(None, "", "p"), pick(None, 1, 2), pick("c", None), pick("d", "e"))
            for k in range(600)]
    df = _wide(spark, made + made[:50])
    order = ["id", "at"]
    want = sorted(map(str, dedup_by(df, order).collect()))
    for lead in (0, 1, 2, 9):
        found = dedup_wide(df, order, lead)
        assert found.columns == df.columns and sorted(map(str, found.collect())) == want
    assert dedup_wide(df.limit(0), order).count() == 0


def test_dedup_wide_without_broadcasts(spark):
    df = _wide(spark, [(str(k % 7), None, str(k % 3), k % 2, "c", str(k % 5)) for k in range(100)])
    want = sorted(map(str, dedup_by(df, ["id", "at"]).collect()))
    spark.conf.set(BROADCAST_BUDGET_CONF, "0")
    try:
        assert sorted(map(str, dedup_wide(df, ["id", "at"]).collect())) == want
    finally:
        spark.conf.unset(BROADCAST_BUDGET_CONF)


def test_dedup_shuffles_no_whole_rows_of_single_keys(spark):
    """rows whose key is alone stay where they are; they were all sent through the window's shuffle."""
    df = dedup_wide(_wide(spark, [(str(k), "t", "a", k, "c", "d") for k in range(50)]), ["id", "at"])
    plan = _plan(df)
    assert plan.index("Union") < plan.index("Window") and df.count() == 50


def test_row_hash_anti_shuffles_hashes_only(spark):
    """whole incoming rows are not shuffled by their hash."""
    cols = ["id", "at", "a", "b", "c", "d"]
    stored = _wide(spark, [("1", None, "a", 1, "c", "d"), ("2", "t", "a", 2, "c", "d")])
    incoming = _wide(spark, [("1", None, "a", 1, "c", "d"), ("1", "", "a", 1, "c", "d"), ("2", "t", "a", 2, "c", "d"), ("3", "t", None, 3, "c", "d"),
                             ("3", "t", None, 3, "c", "d")])
    found = row_hash_anti(incoming, stored, cols)
    assert sorted(r.id for r in found.collect()) == ["1", "3", "3"] and found.columns == cols
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_partitions_written_in_place(spark):
    """F16: the layout is written without a shuffle or sort of the rows, and the settings are put back."""
    keys = [None, "2023", "2024"]
    df = spark.createDataFrame([(k, keys[k % 3], f"{k % 12:02d}") for k in range(400)], "k int, year string, month string")
    before = {k: spark.conf.get(k, None) for k in IO.IN_PLACE_CONF}
    path = scratch_path(spark, "in-place")
    IO.write_partitioned_in_place(df, path, ["year", "month"])
    assert {k: spark.conf.get(k, None) for k in IO.IN_PLACE_CONF} == before
    back = spark.read.schema(df.schema).parquet(path)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert back.filter("year = '2023' and month = '01'").count() == sum(k % 3 == 1 and k % 12 == 1 for k in range(400))


# --- round 4: nothing wide is shuffled or kept longer than it is needed -------------------------

def _exists(spark, path):
    fs, at = _fs(spark, path)
    return fs.exists(at)


def test_semi_join_numbered_shuffles_keys_only(spark):
    """known values beyond a broadcast made the referential filter a shuffled join of whole rows."""
    from goldleaf.operators.row_marks import numbered, semi_join_numbered
    df = _wide(spark, [(None if k % 9 == 0 else str(k % 700), "t", "a", k, "c", "d") for k in range(900)]).coalesce(1)
    known = spark.createDataFrame([(str(k),) for k in range(0, 800, 2) for _ in "ab"] + [(None,)], "id string")
    rows = numbered(df)
    want = sorted(map(str, df.join(known, "id", "left_semi").collect()))
    for budget in (None, "10000", "0"):
        if budget:
            spark.conf.set(BROADCAST_BUDGET_CONF, budget)
        try:
            found = semi_join_numbered(rows, rows, known, "id")
            assert sorted(map(str, found.drop("__goldleaf_at").collect())) == want and found.columns[0] == "id"
            if budget == "10000":
                assert "LeftSemi" not in _plan(found)
        finally:
            spark.conf.unset(BROADCAST_BUDGET_CONF)


def test_late_dedup_chooses_on_keys_and_times(spark):
    """whole incoming rows went through the join with stored rows and the window."""
    import datetime as dt
    from goldleaf.operators.dedup import late_dedup
    rnd, day = random.Random(4), dt.datetime(2024, 1, 1)
    made = [(rnd.choice(["x", "y", None, str(k // 2)]), rnd.choice([None, day + dt.timedelta(days=rnd.randrange(30))]), rnd.choice([None, 1, 2]), "w")
            for k in range(300)]
    df = spark.createDataFrame(made, "id string, ts timestamp_ntz, v int, w string")
    stored = df.filter("v = 1").limit(40)
    recent = stored.select(F.col("id").alias("i"), F.col("ts").alias("t"))
    week = F.expr("INTERVAL 7 days")
    want = dedup_by(df.join(recent, [df.id == recent.i, recent.t.between(df.ts - week, df.ts + week)], "left_anti"), ["id", "ts"])
    found = late_dedup(stored, df, ["id"], "ts")
    assert found.columns == df.columns and sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    plan = _plan(found)
    assert plan.index("Union") < plan.index("Window") and "LeftAnti" not in plan


def test_tables_stored_on_the_way_are_deleted(spark):
    """the numbered extract of a delivery stayed beside its cleaned rows."""
    paths = []

    def build():
        way = IO.store(spark.range(20), "t-way")
        paths.append(way.inputFiles()[0].rpartition("/")[0])
        return way.filter("id > 4")

    kept = IO.store_of(spark, build, "t-kept")
    assert kept.count() == 15
    assert not _exists(spark, paths[0])


def test_a_micro_batch_leaves_its_table_alone_and_is_written_in_place(spark):
    """Intermediate tables of a micro-batch go when it is written, and its rows are not shuffled for the layout."""
    from goldleaf.streaming import ingest as ING
    root, made = scratch_path(spark, "t-batch"), []
    rows = spark.range(40, numPartitions=4).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("p"))
    IO.write_raw_csv(rows, f"{root}/in")

    def transform(batch):
        made.append(scratch_path(spark, "t-aside"))
        batch.write.parquet(made[0])
        return spark.read.schema(batch.schema).parquet(made[0]).repartition(3, "k")

    ING.ingest_available(ING.csv_stream(spark, f"{root}/in", rows.schema), transform, f"{root}/out", f"{root}/ckpt", ["p"], in_place=True)
    back = ING.read_ingested(spark, f"{root}/out", rows.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    assert made and not _exists(spark, made[0])


def test_versioned_partitions_are_written_in_place(spark):
    """whole rows were shuffled for the layout, and again for the copies of a merge."""
    from goldleaf.sources import versioned as VS
    from goldleaf.streaming.late import partition_scoped_merge
    path = scratch_path(spark, "t-versioned")
    df = spark.createDataFrame([(k // 2, k % 4, None if k % 3 else "n", "p") for k in range(60)], "id int, v int, n string, p string").repartition(3, "v", "n")
    VS.replace_partitions(spark, path, df, ["p"])
    back = VS.read_version(spark, path, df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect())) and len(back.inputFiles()) > 1
    batch = spark.createDataFrame([(1, 9, None, "p"), (77, 0, "n", "p")], df.schema)
    want = dedup_by(df.unionByName(batch), ["id"])
    assert partition_scoped_merge(spark, path, batch, ["p"], ["id"], schema=df.schema) == [("p",)]
    assert sorted(map(str, VS.read_version(spark, path, df.schema).collect())) == sorted(map(str, want.collect()))


def test_stream_carries_no_derived_columns(spark):
    """what the documents hold was shuffled a second time as columns."""
    from goldleaf import contracts as C
    from goldleaf.operators.clean import clean_nulls
    from goldleaf.plans import silver as S
    doc = ['{"gateway_fee": 1.5, "gateway_status": " OK "}', '{"gateway_fee": -1}', None, "broken"]
    stamp = ["2024-01-02 03:04:05", "2024-01-02T03:04:05+02:00", "bad-ts", None]
    raw = [tuple({"transaction_id": str(k), "merchant_id": "7", "transaction_timestamp": stamp[k % 4], "gateway_response": doc[k // 4 % 4],
                  "transaction_metadata": '{"risk_score": "x", "device_type": "Mobile"}', "gross_amount": "-1" if k % 11 == 0 else "2.345"}.get(c, "1")
                 for c in C.TRANSACTION_SOURCE_COLUMNS) for k in range(64)]
    df = clean_nulls(spark.createDataFrame(raw, C.RAW_TRANSACTION_SCHEMA))
    want, sound = S.clean_transaction_rows(df), S.sound_transactions(df)
    assert sound.columns == df.columns
    found = S.with_derived(sound)
    assert found.schema == want.schema and sorted(map(str, found.collect())) == sorted(map(str, want.collect())) and want.count() > 0


def test_numbered_rows_are_loaded_like_others_and_not_read_when_known(spark):
    """each further load shuffled all staged rows whole, also where it adds none."""
    from goldleaf.operators import known_ids as K
    from goldleaf.operators.row_marks import numbered
    table = scratch_path(spark, "t-known")
    ids = lambda *v: spark.createDataFrame([(x, "w") for x in v], "id string, w string")
    for batch, rows in (("a", ids("1", "2", None)), ("b", ids("3"))):
        rows.write.parquet(f"{table}/batch={batch}")
        K.write_sketch(spark, table, batch, "id")
    staged = ids("1", "3", "4", "4", None)
    plain, _ = K.absent(spark, staged, table, "id")
    found, read = K.absent(spark, numbered(staged), table, "id")
    assert sorted(map(str, found.drop("__goldleaf_at").collect())) == sorted(map(str, plain.collect())) and read == ["a", "b"]
    assert "LeftAnti" not in _plan(found)
    none, _ = K.absent(spark, numbered(ids("1", "2", "3")), table, "id")
    assert none.count() == 0 and "parquet" not in _plan(none)
    spark.conf.set(BROADCAST_BUDGET_CONF, "0")
    try:
        found, _ = K.absent(spark, numbered(staged), table, "id")
        assert sorted(map(str, found.drop("__goldleaf_at").collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.unset(BROADCAST_BUDGET_CONF)


def test_keys_follow_all_order_columns_whatever_finds_the_ranges(spark):
    """the ranges of the fact's keys were sampled from all its columns."""
    df = spark.createDataFrame([(k % 5, None if k % 7 == 0 else k % 3, (k * 37) % 200) for k in range(200)], "a int, b int, c int")
    want = [tuple(r) for r in assign_surrogate_keys(df, "k", ["a", "b", "c"], num_partitions=4).orderBy("k").collect()]
    for lead in (1, 2):
        assert [tuple(r) for r in assign_surrogate_keys(df, "k", ["a", "b", "c"], num_partitions=4, lead=lead).orderBy("k").collect()] == want
