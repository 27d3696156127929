"""Every registered query against its DuckDB oracle (row count, columns, value hash)."""

import pytest

import __spark_entry__ as entry
from check_oracle import digest

from conftest import SMOKE_DIR

from goldleaf.plans import catalog

# the core catalogue; optional subpackages test their own queries
QUERIES = {n: q for n, q in entry.queries().items() if n in catalog.QUERIES}
ORACLE = {n: q for n, q in entry.oracle_sql().items() if n in catalog.ORACLE}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "transaction_id" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SMOKE_DIR)
    scols, srows = sdf.columns, [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLE[name])
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(scols, srows)[0] == digest(dcols, drows)[0]
