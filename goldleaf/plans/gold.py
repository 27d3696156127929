"""Silver -> gold: calendar, SCD2 merchant dimension, junk dimensions, transaction fact.

``run_gold`` is the job: it writes every gold table as a new snapshot
directory below ``root`` and returns their paths.  The functions before it
are the same steps as composable DataFrame builders, used by the query
catalogue and the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf import contracts as C
from goldleaf.operators.calendar import build_dim_date
from goldleaf.operators.fact import build_fact, derive_fact_columns
from goldleaf.operators.keys import assign_surrogate_keys, build_junk_dimension, combinations, extend_junk_dimension, next_key
from goldleaf.operators.known_ids import absent, write_sketch
from goldleaf.operators.load import incremental_load, insert_absent
from goldleaf.operators.row_marks import AT
from goldleaf.operators.quality import (BREACHES, REPORT_SCHEMA, breach_report, contract_checks, contract_report, key_report,
                                        split_breaches, with_breaches)
from goldleaf.operators.scd2 import change_ledger, opens_version, scd2_apply_once, stage_merchants, unapplied
from goldleaf.sources import warehouse as W
from goldleaf.sources.compact import compact, open_name
from goldleaf.sources.files import read_parquet, store, write_clustered_fact, write_snapshot
from goldleaf.sources.state import BATCH, complete_batches, read_batches, read_state, write_state

# Order that makes fact keys deterministic.  It starts with the fact's physical
# clustering (year, month, date key, merchant), so the range shuffle that orders
# the keys also lays out the files: no second shuffle before the write.
FACT_LAYOUT = ["year", "month", "transaction_date_key", "merchant_key"]
MERCHANT_TABLES = ["dim_merchant", "merchant_ledger"]
FACT_KEY_ORDER = FACT_LAYOUT + [c for c in C.FACT_COLUMNS if c not in FACT_LAYOUT]
# The order columns that ranges are found by: the layout and the transaction id, which comes next.
FACT_KEY_LEAD = FACT_KEY_ORDER.index("transaction_id") + 1


def junk_payment(derived: DataFrame) -> DataFrame:
    return build_junk_dimension(derived, C.PAYMENT_JUNK_ATTRS, C.PAYMENT_JUNK_KEY)


def junk_card(derived: DataFrame) -> DataFrame:
    return build_junk_dimension(derived, C.CARD_JUNK_ATTRS, C.CARD_JUNK_KEY)


def _fact_inputs(derived: DataFrame) -> list[str]:
    """The derived columns that the fact and its lookups read, and the breaches found so far."""
    return [c for c in derived.columns if c in {*C.FACT_COLUMNS, *C.PAYMENT_JUNK_ATTRS, *C.CARD_JUNK_ATTRS, "merchant_id", BREACHES}]


def fact_from_silver(silver_txn: DataFrame, dim_merchant: DataFrame,
                     jp: DataFrame | None = None, jc: DataFrame | None = None) -> DataFrame:
    derived = derive_fact_columns(silver_txn)
    if jp is None or jc is None:
        # read once for each junk dimension and for the lookups: the documents are parsed once, only what the fact needs is kept
        derived = store(derived.select(*_fact_inputs(derived)), "derived")
    jp = jp if jp is not None else junk_payment(derived)
    jc = jc if jc is not None else junk_card(derived)
    return build_fact(derived, dim_merchant, jp, jc)


def load_fact(staged: DataFrame, target: DataFrame | None, start: int | None = None,
              scope: list[str] | None = None) -> DataFrame:
    """Rows appended to the fact: new transaction ids, keyed after the current maximum."""
    return incremental_load(staged, target, "transaction_id", "transaction_key", FACT_KEY_ORDER,
                            start=start, scope=scope, lead=FACT_KEY_LEAD)


def load_fact_batch(spark: SparkSession, staged: DataFrame, table: str, batch: str, start: int | None = None) -> DataFrame:
    """Write the staged rows that no other batch folder of ``table`` holds as its folder ``batch``, and its sketch.

    The sketches choose the folders that are read (``operators.known_ids``); returns the keyed rows.
    Numbers of the staged rows (``row_marks``) keep the shuffles narrow and are not written.
    If ``batch`` was merged by a compaction since, its rows are in another folder and what is new goes to one beside it.
    """
    batch = open_name(spark, table, batch)
    fresh, _ = absent(spark, staged, table, "transaction_id", but=batch)
    others = read_batches(spark, table, but=batch)
    first = next_key(others, "transaction_key", hint=start) if others is not None else start or 1
    keyed = assign_surrogate_keys(fresh.drop(AT), "transaction_key", order_by=FACT_KEY_ORDER, start=first, lead=FACT_KEY_LEAD)
    write_clustered_fact(keyed, f"{table}/{BATCH}={batch}", mode="overwrite", presorted=True)
    write_sketch(spark, table, batch, "transaction_id")
    return keyed


def compact_fact(spark: SparkSession, table: str, keep: list[str] | None = None, **bounds) -> str | None:
    """C5 over many loads: merge the fact's small batch folders in the fact's layout (``sources.compact``)."""
    return compact(spark, table, ["year", "month"], ["transaction_date_key", "merchant_key", "transaction_key"], key="transaction_id",
                   keep=keep or (), **bounds)


def compact_gold(spark: SparkSession, root: str, **bounds) -> str | None:
    """compact_fact() of the table that the state below ``root`` names, without the last run's batch, which may be repeated."""
    state = read_state(spark, root)
    return compact_fact(spark, state["fact_transactions"], [b for b in [state.get("fact_batch")] if b], **bounds) if "fact_transactions" in state else None


def dim_date_for(spark: SparkSession, facts: DataFrame | None = None, ts_col: str = "transaction_timestamp"):
    """Default 2020-2030 calendar, widened to cover every fact date."""
    return build_dim_date(spark, cover=facts, cover_col=ts_col if facts is not None else None)


def _narrowed(df: DataFrame, types: dict[str, T.DataType]) -> dict[str, T.DataType]:
    """Columns of ``df`` that a numeric contract type may cut."""
    return {c: t for c, t in types.items() if c in df.columns and df.schema[c].dataType != t
            and isinstance(t, T.NumericType) and isinstance(df.schema[c].dataType, (T.NumericType, T.StringType))}


def apply_merchant_changes(spark: SparkSession, changes: DataFrame, root: str, state: dict, mode: str) -> dict:
    """The next merchant and ledger snapshots after one CDC batch; its report and rejected rows beside them.

    Rows that the warehouse would refuse (NOT NULL, widths) are set aside with their reasons.

    Changes that the ledger holds are not applied again; a batch of such changes alone leaves
    both snapshots as they are.
    """
    required = [c for c in C.NOT_NULL["dim_merchant"] if c != "merchant_key"]
    checked = with_breaches(stage_merchants(changes), not_null=required, widths=C.VARCHAR_WIDTHS["dim_merchant"])
    staged_path = write_snapshot(checked, root, "stg_merchants")
    staged, refused = split_breaches(read_parquet(spark, staged_path))
    dim, ledger = (read_parquet(spark, state[t]) if state.get(t) else None for t in MERCHANT_TABLES)
    narrowed = _narrowed(changes, C.MERCHANT_STAGE_TYPES)
    out = {
        "stg_merchants": staged_path,
        "merchant_report": write_snapshot(contract_report(changes, "silver_merchants", narrowing=narrowed), root, "merchant_report"),
        "rejected_merchants": write_snapshot(refused.filter(opens_version()), root, "rejected_merchants"),
    }
    if dim is not None and change_ledger(unapplied(staged, ledger)).isEmpty():
        return out | {t: state[t] for t in MERCHANT_TABLES if state.get(t)}
    snapshots = scd2_apply_once(dim, staged, ledger, mode)
    return out | {t: write_snapshot(df, root, t) for t, df in zip(MERCHANT_TABLES, snapshots)}


def _key_reports(spark: SparkSession, state: dict, batch: str, fact_start: int | None) -> DataFrame:
    """Uniqueness of the fact's and the calendar's keys that this batch added, against the whole tables."""
    reports = spark.createDataFrame([], REPORT_SCHEMA)
    fact, calendar = (read_batches(spark, state[t]) for t in ("fact_transactions", "dim_date"))
    if fact is not None:
        reports = reports.unionByName(key_report(fact, "fact_transactions", C.PRIMARY_KEYS["fact_transactions"], fact_start))
    if complete_batches(spark, state["dim_date"]).get(batch):
        key = C.PRIMARY_KEYS["dim_date"]
        low, high = spark.read.parquet(f"{state['dim_date']}/{BATCH}={batch}").agg(F.min(key), F.max(key)).first()
        reports = reports.unionByName(key_report(calendar, "dim_date", key, low, high))
    return reports


def run_gold(spark: SparkSession, silver_merchant_batches: list[DataFrame], silver_txn: DataFrame,
             root: str, previous: dict | None = None, mode: str = "compat",
             batch: str | None = None) -> dict:
    """Build and write every gold table; returns the new state {table: path}.

    ``previous`` is the state of the last run.  Dimensions are new snapshots; the fact
    and the calendar grow by a folder ``batch=<batch>``, written in overwrite mode and
    compared with every other complete batch found below the table's path.  A run that
    broke off anywhere can be repeated: the same ``batch`` replaces its own folders, and
    a later one finds the rows that are there.  The dimensions' paths are saved before
    the fact is written, so a repeated run gives its rows the same keys.
    The NOT EXISTS check of the fact reads the batch folders that their sketches choose.
    """
    root = root.rstrip("/")
    out = {k: v for k, v in (previous or {}).items() if v is not None}
    for changes in silver_merchant_batches:
        out |= apply_merchant_changes(spark, changes, root, out, mode)
    if "dim_merchant" not in out:
        raise ValueError("no merchant dimension: give merchant batches or a previous snapshot")
    dim = read_parquet(spark, out["dim_merchant"])
    out |= {t: out.get(t) or f"{root}/{t}" for t in ("fact_transactions", "dim_date")}
    batch = batch or f"r{len(complete_batches(spark, out['dim_date'])):06d}"

    # silver is read and its documents are parsed once: checks and fact attributes are stored together
    narrowed = _narrowed(silver_txn, C.FACT_TYPES)
    derived = derive_fact_columns(with_breaches(silver_txn, narrowing=narrowed))
    out["stg_derived"] = write_snapshot(derived.select(*_fact_inputs(derived)), root, "stg_derived")
    derived = read_parquet(spark, out["stg_derived"])
    # junk dimensions keep their keys across runs: built once, then extended with
    # the combinations first seen in this batch (keyed after the maximum)
    junk = {"junk_dim_payment_context": (C.PAYMENT_JUNK_ATTRS, C.PAYMENT_JUNK_KEY), "junk_dim_card_device": (C.CARD_JUNK_ATTRS, C.CARD_JUNK_KEY)}
    for (table, (attrs, key)), seen in zip(junk.items(), combinations(derived, [attrs for attrs, _ in junk.values()])):
        if table in out:
            dim_j = extend_junk_dimension(read_parquet(spark, out[table]), seen, attrs, key)
        else:
            dim_j = build_junk_dimension(seen, attrs, key)
        out[table] = write_snapshot(dim_j, root, table)
    write_state(spark, root, out)

    staged = build_fact(derived.drop(BREACHES), W.active_merchant_keys(spark, out["dim_merchant"]),
                        W.payment_junk(spark, out["junk_dim_payment_context"]),
                        W.card_junk(spark, out["junk_dim_card_device"]), current_only=False)
    # rows that the warehouse would refuse (NOT NULL, widths) are set aside with their reasons, not loaded
    contract = {"not_null": [c for c in C.NOT_NULL["fact_transactions"] if c != "transaction_key"], "widths": C.VARCHAR_WIDTHS["fact_transactions"]}
    checked = with_breaches(staged, **contract)
    out["stg_fact_transactions"] = write_snapshot(checked, root, "stg_fact_transactions")
    checked = read_parquet(spark, out["stg_fact_transactions"])
    staged, refused = split_breaches(checked)
    report = (breach_report(checked, "stg_fact_transactions", [f"{check}:{col}" for check, col, _ in contract_checks(checked, **contract)])
              .unionByName(contract_report(dim, "dim_merchant", C.NOT_NULL["dim_merchant"], C.VARCHAR_WIDTHS["dim_merchant"],
                                           primary_key=C.PRIMARY_KEYS["dim_merchant"]))
              .unionByName(breach_report(derived, "silver_transactions", [f"numeric_narrowing:{c}" for c in narrowed])))
    out["contract_report"] = write_snapshot(report, root, "contract_report")
    out["rejected_transactions"] = write_snapshot(refused, root, "rejected_transactions")

    start = out.get("fact_batch_start") if out.get("fact_batch") == batch else out.get("fact_next_key")
    load_fact_batch(spark, staged, out["fact_transactions"], batch, start)
    # the next free key is carried in the state, so later runs never scan the whole key column
    loaded = read_batches(spark, out["fact_transactions"])
    out |= {"fact_batch": batch, "fact_batch_start": start, "fact_next_key": next_key(loaded, "transaction_key", hint=start) if loaded is not None else start}

    calendar = dim_date_for(spark, staged)
    have = read_batches(spark, out["dim_date"], but=batch)
    calendar = calendar if have is None else insert_absent(calendar, have, "date_key")
    calendar.write.mode("overwrite").parquet(f"{out['dim_date']}/{BATCH}={batch}")
    out["key_report"] = write_snapshot(_key_reports(spark, out, batch, start), root, "key_report")
    write_state(spark, root, out)
    return out
