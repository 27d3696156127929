"""Batches applied twice, replayed and broken off: changes, commits and hashes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from goldleaf import contracts as C
from goldleaf.functions import row_hash
from goldleaf.operators.scd2 import scd2_apply_once
from goldleaf.plans.jobs import run_gold_incremental, run_silver_incremental
from goldleaf.session import scratch_path
from goldleaf.sources import commits
from goldleaf.sources import files as IO
from goldleaf.sources import fixtures as FX
from goldleaf.streaming import ingest as ING

from conftest import SMOKE_DIR
from test_scd2_streaming import stage, versions

D = dt.date


def applied(spark, batches, mode="strict"):
    dim = ledger = None
    for b in batches:
        dim, ledger = (df.checkpoint() for df in scd2_apply_once(dim, b, ledger, mode))
    return dim, ledger


@pytest.mark.parametrize("mode", ["strict", "compat"])
def test_batches_applied_again_change_nothing(spark, mode):
    first = stage(spark, [("I", 1, D(2024, 1, 1), "a"), ("I", 2, D(2024, 1, 1), "b"), ("U", None, D(2024, 1, 1), "n")])
    second = stage(spark, [("U", 1, D(2024, 2, 1), "a2"), ("U", 1, D(2024, 2, 1), "a3"), ("D", 2, D(2024, 2, 1), "b")])
    once, _ = applied(spark, [first, second], mode)
    for order in ([first, second, second, first], [first, first, second], [first, second, first.unionByName(second)]):
        dim, ledger = applied(spark, order, mode)
        assert sorted(map(str, dim.collect())) == sorted(map(str, once.collect()))
        assert ledger.count() == ledger.distinct().count()


def test_a_change_back_to_an_earlier_content_is_a_new_version(spark):
    days = [stage(spark, [("U", 1, D(2024, m, 1), name)]) for m, name in ((1, "a"), (2, "b"), (3, "a"))]
    dim, _ = applied(spark, days + days)
    assert [v[1:3] for v in versions(dim, 1)] == [("a", D(2024, 1, 1)), ("b", D(2024, 2, 1)), ("a", D(2024, 3, 1))]


def test_resent_files_leave_dimension_and_fact_as_they_are(spark):
    root = scratch_path(spark, "t-resent")
    raw_m, raw_t = FX.raw_merchants(spark, SMOKE_DIR), FX.raw_transactions(spark, SMOKE_DIR)
    runs = []
    for k, v in enumerate((0, 1, 1, 0)):
        IO.write_raw_csv(FX.merchant_batch(raw_m, v), f"{root}/raw/merchants/x{k}")
        if k != 1:
            IO.write_raw_csv(raw_t, f"{root}/raw/transactions/x{k}")
        run_silver_incremental(spark, f"{root}/raw", f"{root}/silver", f"{root}/ckpt")
        state = run_gold_incremental(spark, f"{root}/silver", f"{root}/gold", f"{root}/ckpt")
        runs.append({t: sorted(map(str, spark.read.parquet(state[t]).collect())) for t in ("dim_merchant", "fact_transactions")})
    assert runs[1] == runs[2] == runs[3]
    assert len(runs[1]["dim_merchant"]) > len(runs[0]["dim_merchant"]) and runs[0]["fact_transactions"] == runs[1]["fact_transactions"]


def test_only_committed_attempts_are_read_and_streamed(spark):
    target, ckpt = f"{scratch_path(spark, 't-commits')}/t", scratch_path(spark, "t-commits-ckpt")
    rows = lambda *ids: spark.createDataFrame([(i, f"p{i % 2}") for i in ids], "id int, p string")
    commits.start_table(spark, target)
    seen = []
    take = lambda df, _: seen.append(sorted(r.id for r in df.collect()))
    ids = lambda: sorted(r.id for r in ING.read_ingested(spark, target, rows(1).schema).collect())
    assert ids() == []
    lost = ING.write_attempt(rows(1, 2), target, 0, ["p"])
    assert ids() == [] and commits.live_folders(spark, target) == {}
    commits.commit(spark, target, 0, ING.write_attempt(rows(2), target, 0, ["p"]))
    assert ids() == [2] and not (spark.read.option("basePath", target).parquet(f"{target}/batch=*").where("p = 'p1'").count())
    ING.for_each_new(spark, target, take, ckpt)
    ING.write_attempt(rows(7), target, 1, ["p"])          # broken off
    ING.for_each_new(spark, target, take, ckpt)
    commits.commit(spark, target, 1, ING.write_attempt(rows(8), target, 1, ["p"]))
    commits.commit(spark, target, 2, ING.write_attempt(rows(9), target, 2, ["p"]))
    ING.for_each_new(spark, target, take, ckpt)
    assert seen == [[2], [8, 9]] and ids() == [2, 8, 9] and lost not in commits.live_folders(spark, target)
    commits.commit(spark, target, 1, ING.write_attempt(rows(), target, 1, ["p"]))   # replayed with nothing in it
    assert ids() == [2, 9]


def test_a_crash_between_write_and_commit_is_replayed_whole(spark, monkeypatch):
    root, schema = scratch_path(spark, "t-broken"), C.all_string_schema(["id", "p"])
    IO.write_raw_csv(spark.createDataFrame([("1", "x"), ("2", "y")], schema), f"{root}/in/d1")
    run = lambda f: ING.ingest_available(ING.csv_stream(spark, f"{root}/in", schema), f, f"{root}/out", f"{root}/ckpt", ["p"])

    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(commits, "commit", lost)
    with pytest.raises(Exception, match="lost"):
        run(lambda df: df)
    monkeypatch.undo()
    run(lambda df: df.where("p = 'x'"))
    assert [tuple(r) for r in ING.read_ingested(spark, f"{root}/out").collect()] == [("1", "x")]
    assert spark.read.option("basePath", f"{root}/out").parquet(f"{root}/out/batch=*").count() == 1


def test_row_hash_keeps_neighbouring_values_apart(spark):
    rows = [("a\u001fb", "c"), ("a", "b\u001fc"), ("␀", ""), (None, ""), ("", None), ("-", ""), ("1:a", ""), ("", "1:a"), ("ab", "c"), ("a", "bc")]
    df = spark.createDataFrame(rows, "x string, y string").select(row_hash(["x", "y"]).alias("h"))
    assert df.distinct().count() == len(rows)
