"""Versioned partitions, headers found in tasks, and the late-data options of the silver job."""

import gzip

import pytest

from goldleaf import contracts as C
from goldleaf.plans.jobs import run_silver_incremental
from goldleaf.session import scratch_path
from goldleaf.sources import files as IO
from goldleaf.sources import fixtures as FX
from goldleaf.sources import versioned as VS
from goldleaf.streaming import ingest as ING
from goldleaf.streaming.late import partition_scoped_merge

from conftest import SMOKE_DIR

SCHEMA = "id string, v int, year string, month string"


def contents(spark, table, schema):
    return sorted(tuple(r) for r in VS.read_version(spark, table, schema).collect())


def test_partitions_are_replaced_together_or_not_at_all(spark, monkeypatch):
    table = f"{scratch_path(spark, 't-versioned')}/t"
    rows = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    first = rows(("1", 1, "2024", "01"), ("2", 1, "2024", "02"), ("3", 1, "2024", None))
    VS.replace_partitions(spark, table, first, ["year", "month"])
    before = contents(spark, table, first.schema)
    assert len(before) == 3
    batch = rows(("1", 2, "2024", "01"), ("4", 2, "2024", "02"), ("5", 2, "2025", "01"))
    merge = lambda: partition_scoped_merge(spark, table, batch, ["year", "month"], ["id"], schema=first.schema)

    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(VS, "write_atomic", lost)      # all files are written, the pointer is not
    with pytest.raises(RuntimeError, match="lost"):
        merge()
    monkeypatch.undo()
    assert contents(spark, table, first.schema) == before
    monkeypatch.setattr(VS, "_leaf_folders", lost)
    with pytest.raises(RuntimeError, match="lost"):
        merge()
    monkeypatch.undo()
    assert contents(spark, table, first.schema) == before
    old = VS.read_version(spark, table, first.schema)
    assert len(merge()) == 3
    after = [("1", 2, "2024", "01"), ("2", 1, "2024", "02"), ("3", 1, "2024", None), ("4", 2, "2024", "02"), ("5", 2, "2025", "01")]
    assert sorted(map(str, contents_of(VS.read_version(spark, table, first.schema)))) == sorted(map(str, after))
    assert sorted(map(str, contents_of(old))) == sorted(map(str, before))   # a reader that began before
    assert VS.drop_unused(spark, table) == 2                          # the two lost attempts; the first write still holds a partition
    assert sorted(map(str, contents_of(VS.read_version(spark, table, first.schema)))) == sorted(map(str, after))
    scan = VS.read_version(spark, table, first.schema, [VS.partition_folder(["year", "month"], ("2024", "02"))])
    assert sorted(r.id for r in scan.collect()) == ["2", "4"] and len(scan.inputFiles()) <= 2


def contents_of(df):
    return [tuple(r) for r in df.collect()]


def test_headers_of_odd_files(spark):
    local = scratch_path(spark, "t-headers").removeprefix("file:")
    import os
    os.makedirs(f"{local}/a b/x=1")
    files = {"a b/one.csv": "id,v\n1,x\n", "x.csv": "\ufeffv,id\r\ny,2\r\n", "a b/x=1/three.csv": "id\n3\n", "empty.csv": "", "only.csv": "id,v\n"}
    for name, text in files.items():
        with open(f"{local}/{name}", "w", newline="") as f:
            f.write(text)
    with gzip.open(f"{local}/four.csv.gz", "wt") as f:
        f.write("id,v\n4,z\n")
    schema = C.all_string_schema(["id", "v"])
    got = sorted(tuple(r) for r in IO.read_raw_csv(spark, local, schema).collect())
    assert [g[0] for g in got] == ["1", "2", "3", "4"] and got[2][1] is None and got[3] == ("4", "z")


@pytest.mark.parametrize("late", ["lookback", "resends", "watermark"])
def test_a_transaction_sent_again_lands_once(spark, late):
    root = scratch_path(spark, f"t-late-{late}")
    raw = FX.raw_transactions(spark, SMOKE_DIR).dropDuplicates(["transaction_id"]).where("created_at >= '2026-06-01'").checkpoint()
    IO.write_raw_csv(FX.raw_merchants(spark, SMOKE_DIR), f"{root}/raw/merchants/x")
    counts = []
    for k in range(3):
        # the second delivery is the last week's alone, the third is all of it again
        IO.write_raw_csv(raw if k != 1 else raw.where("created_at >= '2026-07-25'"), f"{root}/raw/transactions/x{k}")
        if k == 2 and late == "watermark":
            break   # rows older than the watermark are dropped by then, as the docstring says
        tables = run_silver_incremental(spark, f"{root}/raw", f"{root}/silver", f"{root}/ckpt", late=late)
        counts.append(ING.read_ingested(spark, tables["transactions"]).select("transaction_id").count())
    assert counts[0] > 0 and len(set(counts)) == 1


def test_unknown_late_option_is_refused(spark):
    with pytest.raises(ValueError, match="late"):
        run_silver_incremental(spark, "a", "b", "c", late="sometimes")
