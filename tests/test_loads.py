"""Pruned NOT EXISTS, keys and quarantine: what is read, and what no shortcut may lose."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.operators import known_ids as K
from goldleaf.operators.keys import assign_surrogate_keys, combinations
from goldleaf.operators.quality import breach_report, key_report, split_breaches, with_breaches
from goldleaf.session import scratch_path


def ids(spark, *values):
    return spark.createDataFrame([(v, f"x{v}") for v in values], "id string, v string")


def stored(spark, name, **batches):
    table = scratch_path(spark, name)
    for batch, values in batches.items():
        ids(spark, *values).write.parquet(f"{table}/batch={batch}")
        K.write_sketch(spark, table, batch, "id")
    return table


def keys_of(df):
    return sorted((r.id or "") for r in df.collect())


def test_only_folders_with_possible_hits_are_read(spark):
    table = stored(spark, "t-known", a=[f"{k:05d}" for k in range(0, 400)], b=[f"{k:05d}" for k in range(400, 800)], c=[f"{k:05d}" for k in range(100, 700, 2)])
    staged = ids(spark, "00401", "00403", "99999", None, None, "99999")
    fresh, read = K.absent(spark, staged, table, "id")
    assert keys_of(fresh) == ["", "", "99999", "99999"] and "b" in read and "a" not in read
    fresh, read = K.absent(spark, ids(spark, "x", "y", None), table, "id")
    assert read == [] and fresh.count() == 3
    fresh, _ = K.absent(spark, staged, table, "id", but="b")      # the batch that is being replaced
    assert keys_of(fresh) == ["", "", "00401", "00403", "99999", "99999"]
    assert K.absent(spark, staged.limit(0), table, "id")[0].count() == 0
    assert K.absent(spark, staged, f"{table}-none", "id") [1] == []


def test_false_positives_and_missing_sketches_lose_no_row(spark, monkeypatch):
    have, new = [f"k{k}" for k in range(0, 3000, 3)], [f"k{k}" for k in range(3000)]
    table = stored(spark, "t-fp", a=have[:500], b=have[500:])
    want = sorted(set(new) - set(have))
    assert keys_of(K.absent(spark, ids(spark, *new), table, "id")[0]) == want
    ids(spark, "k1").write.parquet(f"{table}/batch=c")              # a folder without a sketch
    assert keys_of(K.absent(spark, ids(spark, *new), table, "id")[0]) == sorted(set(want) - {"k1"})
    monkeypatch.setattr(K, "_has_bit", lambda bits, at: F.lit(True))  # every probe hits
    assert keys_of(K.absent(spark, ids(spark, *new), table, "id")[0]) == sorted(set(want) - {"k1"})


def test_sketch_holds_its_ids_and_few_others(spark):
    rows = spark.range(20000).select(F.concat(F.lit("id-"), "id").alias("id"))
    sketches = K.sketch(rows, "id").withColumn("batch", F.lit("a")).checkpoint()
    assert sketches.first().blocks == 16 and sketches.agg(F.max(F.octet_length("bits"))).first()[0] == K.BLOCK_BITS // 8
    assert K.possible_folders(rows, sketches, "id").count() == 20000
    others = spark.range(20000).select(F.concat(F.lit("id-"), F.col("id") + 20000).alias("id"))
    assert K.possible_folders(others, sketches.withColumns({"lo": F.lit("a"), "hi": F.lit("z")}), "id").count() < 200


def test_keys_of_many_partitions_have_no_literals_in_the_plan(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    for n in (1, 40, None):
        keyed = assign_surrogate_keys(df, "k", ["v"], start=5, num_partitions=n)
        assert [tuple(r) for r in keyed.orderBy("v").collect()] == [(5 + v, v) for v in range(1000)]
        assert "element_at" not in keyed._jdf.queryExecution().optimizedPlan().toString()
    assert assign_surrogate_keys(df.limit(0), "k", ["v"]).count() == 0


def test_new_keys_are_checked_without_reading_old_ones(spark):
    path = scratch_path(spark, "t-keys")
    spark.createDataFrame([(k,) for k in (1, 2, 2, 10, 11, 11, 12)], "k long").repartitionByRange(3, "k").write.parquet(path)
    table = spark.read.parquet(path)
    count = lambda *b: key_report(table, "t", "k", *b).first().violations
    assert (count(), count(10), count(12), count(2, 9), count(50)) == (4, 2, 0, 2, 0)
    plan = key_report(table, "t", "k", 10, 12)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,10)" in plan and "LessThanOrEqual(k,12)" in plan


def test_breaches_are_found_once_and_split(spark):
    df = spark.createDataFrame([("a", "12", 1), (None, "1234", 2), ("abc", "x", 3), (None, None, 4)], "n string, d string, i int")
    contract = {"not_null": ["n", "absent"], "widths": {"n": 2, "d": 3}, "narrowing": {"d": T.IntegerType()}}
    checked = with_breaches(df, **contract).checkpoint()
    assert {r.i: list(r.breaches) for r in checked.collect()} == {
        1: [], 2: ["not_null:n", "varchar_width:d"], 3: ["varchar_width:n", "numeric_narrowing:d"], 4: ["not_null:n"]}
    kept, refused = split_breaches(checked)
    assert [r.i for r in kept.collect()] == [1] and kept.columns == df.columns and sorted(r.i for r in refused.collect()) == [2, 3, 4]
    report = {(r.check_name, r.column_name): r.violations for r in breach_report(checked, "t", ["not_null:n", "varchar_width:d", "numeric_narrowing:d", "not_null:i"]).collect()}
    assert report == {("not_null", "n"): 2, ("varchar_width", "d"): 1, ("numeric_narrowing", "d"): 1, ("not_null", "i"): 0}
    assert with_breaches(checked, not_null=["d"]).where("i = 4").first().breaches == ["not_null:n", "not_null:d"]


@pytest.mark.parametrize("sets", [[["a", "b"], ["c"]], [["a"], ["a", "c"], ["b"]]])
def test_combinations_keep_nulls_apart(spark, sets):
    rows = [(x, y, z) for x in (None, 1) for y in (None, "p", "q") for z in (None, True)] * 2
    df = spark.createDataFrame(rows, "a int, b string, c boolean")
    for attrs, found in zip(sets, combinations(df, sets), strict=True):
        assert sorted(map(str, found.collect())) == sorted(map(str, df.select(*attrs).distinct().collect()))
