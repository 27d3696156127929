"""

Raw extracts are first written as CSV (untimed) so that parsing is part of
every silver run.  Each stage's result is forced with a write to the ``noop``
sink; one warm-up run, then the median of three.  Prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from goldleaf import contracts as C  # noqa: E402
from goldleaf.operators.fact import build_fact, derive_fact_columns  # noqa: E402
from goldleaf.operators.scd2 import scd2_apply, stage_merchants  # noqa: E402
from goldleaf.plans import gold as G  # noqa: E402
from goldleaf.plans import silver as S  # noqa: E402
from goldleaf.session import build_session, scratch_path  # noqa: E402
from goldleaf.sources import files as IO  # noqa: E402
from goldleaf.sources import fixtures as FX  # noqa: E402
from goldleaf.sources import warehouse as W  # noqa: E402


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, runs: int) -> float:
    fn()  # warm-up
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t0)
    return round(statistics.median(samples), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, app_name="goldleaf-bench")
    work = scratch_path(spark, "bench")

    # --- untimed setup: raw CSV extracts, silver and the initial dimension as Parquet
    raw_m_csv, raw_t_csv = f"{work}/raw/merchants", f"{work}/raw/transactions"
    IO.write_raw_csv(FX.raw_merchants(spark, sf_dir), raw_m_csv)
    IO.write_raw_csv(FX.raw_transactions(spark, sf_dir), raw_t_csv)

    def raw_m():
        return IO.read_raw_csv(spark, raw_m_csv, C.RAW_MERCHANT_SCHEMA)

    def raw_t():
        return IO.read_raw_csv(spark, raw_t_csv, C.RAW_TRANSACTION_SCHEMA)

    silver_m_path = f"{work}/silver/merchants"
    IO.write_partitioned(S.silver_merchants(raw_m()), silver_m_path, C.MERCHANT_PARTITION)
    silver_m = spark.read.parquet(silver_m_path)
    silver_t_path = f"{work}/silver/transactions"
    IO.write_partitioned(S.silver_transactions(raw_t(), silver_m), silver_t_path, C.TRANSACTION_PARTITION)
    silver_t = spark.read.parquet(silver_t_path)

    s0 = stage_merchants(S.silver_merchants(FX.merchant_batch(raw_m(), 0)))
    s1 = stage_merchants(S.silver_merchants(FX.merchant_batch(raw_m(), 1)))
    dim0_path = f"{work}/gold/dim_merchant0"
    scd2_apply(None, s0).write.parquet(dim0_path)
    dim0 = spark.read.parquet(dim0_path)
    s1_path = f"{work}/gold/stg_merchant1"
    s1.write.parquet(s1_path)
    s1 = spark.read.parquet(s1_path)
    dim1_path = f"{work}/gold/dim_merchant1"
    scd2_apply(dim0, s1).write.parquet(dim1_path)
    derived = derive_fact_columns(silver_t)
    jp_path, jc_path = f"{work}/gold/junk_payment", f"{work}/gold/junk_card"
    G.junk_payment(derived).write.parquet(jp_path)
    G.junk_card(derived).write.parquet(jc_path)

    def fact_stage():
        return build_fact(derive_fact_columns(silver_t), W.active_merchant_keys(spark, dim1_path),
                          W.payment_junk(spark, jp_path), W.card_junk(spark, jc_path), current_only=False)

    def junk_dims():
        force(G.junk_payment(derived))
        force(G.junk_card(derived))

    fact_path = f"{work}/gold/fact"
    staged0 = fact_stage()
    G.load_fact(staged0, None).write.parquet(fact_path)
    fact = spark.read.parquet(fact_path)
    stg_path = f"{work}/gold/stg_fact"
    staged0.write.parquet(stg_path)
    staged = spark.read.parquet(stg_path)

    stages = {
        "silver_merchants": lambda: force(S.silver_merchants(raw_m())),
        "silver_transactions": lambda: force(S.silver_transactions(raw_t(), silver_m)),
        "dim_date": lambda: force(G.dim_date_for(spark, silver_t)),
        "scd2_apply": lambda: force(scd2_apply(dim0, s1)),
        "junk_dims": junk_dims,
        "fact_stage": lambda: force(fact_stage()),
        "fact_reload_0_new": lambda: force(G.load_fact(staged, fact)),
    }
    times = {name: timed(fn, runs) for name, fn in stages.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "pipeline_stage_seconds_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
