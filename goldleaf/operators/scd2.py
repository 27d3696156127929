"""Slowly changing (type 2) merchant dimension.

The dimension is a versioned snapshot: applying a CDC batch returns the
complete next snapshot (expired old versions + untouched rows + new
versions), which the caller writes to a *new* directory.  Expire and insert
therefore land in one write; there is no window in which a merchant has no
active row, and no path is overwritten while it is being read.

Two modes:

* ``compat`` — every ``I``/``U`` row becomes an active version; each ``U``
  closes the merchant's active rows at (earliest ``U`` valid_from − 1 day).
  Deletes (``D``) are ignored.
* ``strict`` — per merchant and day only the last change of a batch counts; a
  merchant's stored and new versions are chained by ``valid_from``
  (``valid_to`` = next ``valid_from`` − 1 day), so at most one row per merchant
  is active and intervals never overlap, also when a change arrives late; a
  repeated ``I`` acts like ``U``.

``scd2_apply_once`` makes either mode idempotent: a ledger holds the digest of every
change that was applied, and a change found in it is left out, whichever batch or file
brings it again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.contracts import (MERCHANT_CODE_RENAMES, MERCHANT_STAGE_COLUMNS, MERCHANT_STAGE_TYPES,
                                OPEN_END_DATE)
from goldleaf.operators.clean import (conform, drop_existing, rename_existing, require_columns,
                                      select_existing)
from goldleaf.operators.dedup import dedup_by
from goldleaf.operators.joins import bounded_broadcast, semi_join_known
from goldleaf.operators.keys import assign_surrogate_keys, next_key
from goldleaf.functions import parse_date, row_hash

DIM_KEY = "merchant_key"
DIM_COLUMNS = [DIM_KEY] + [c for c in MERCHANT_STAGE_COLUMNS if c not in ("cdc_op", "cdc_timestamp")]
# a total order: the remaining columns break ties, so tied rows get the same keys in every run
VERSION_ORDER = ["merchant_id", "valid_from", "cdc_timestamp", "updated_at"]
VERSION_ORDER += [c for c in MERCHANT_STAGE_COLUMNS if c not in VERSION_ORDER]
_DATE_KEY_COLUMNS = ["onboarding_date", "contract_start_date", "contract_end_date"]


def stage_merchants(silver: DataFrame) -> DataFrame:
    """Silver merchants -> typed staging rows (one CDC batch)."""
    require_columns(silver, ["op", "cdc_timestamp"], "merchant CDC batch")
    df = rename_existing(silver, {"op": "cdc_op", **MERCHANT_CODE_RENAMES})
    df = df.withColumns({
        "valid_from": parse_date("cdc_timestamp"),
        "valid_to": F.lit(OPEN_END_DATE).cast(T.DateType()),
        "is_active": F.lit(True),
    })
    # the dates themselves give way to their yyyyMMdd keys, under the date's name
    df = drop_existing(df, _DATE_KEY_COLUMNS + ["#"])
    df = rename_existing(df, {f"{c}_date_key": c for c in _DATE_KEY_COLUMNS})
    df = select_existing(df, MERCHANT_STAGE_COLUMNS)
    return conform(df, MERCHANT_STAGE_TYPES)


def _closing_changes(stage: DataFrame, ops: list[str]) -> DataFrame:
    """Per merchant: the earliest change among ``ops`` (valid_from, updated_at)."""
    first = F.min(F.struct("valid_from", "updated_at"))
    return (stage.filter(F.col("cdc_op").isin(ops)).groupBy("merchant_id")
            .agg(first.alias("chg"))
            .select("merchant_id", F.col("chg.valid_from").alias("__chg_from"),
                    F.col("chg.updated_at").alias("__chg_updated")))


def scd2_expire(dim: DataFrame, stage: DataFrame, mode: str = "compat") -> DataFrame:
    """Close the active versions of merchants changed by the batch."""
    ops = ["U"] if mode == "compat" else ["I", "U"]
    changes = _closing_changes(stage, ops)
    joined = dim.join(bounded_broadcast(changes), on="merchant_id", how="left")
    hit = F.col("is_active") & F.col("__chg_from").isNotNull()
    # a version superseded on its own first day gets an empty interval
    # (valid_to = valid_from - 1): never current, overlapping nothing, key kept
    close = F.date_sub(F.col("__chg_from"), 1)
    return joined.withColumns({
        "valid_to": F.when(hit, close).otherwise(F.col("valid_to")),
        "updated_at": F.when(hit, F.col("__chg_updated")).otherwise(F.col("updated_at")),
        "is_active": F.when(hit, F.lit(False)).otherwise(F.col("is_active")),
    }).select(*dim.columns)


def _new_versions(stage: DataFrame, mode: str) -> DataFrame:
    rows = stage.filter(F.col("cdc_op").isin("I", "U"))
    if mode == "compat":
        return rows
    # strict: the day's last change wins, then versions are chained
    order = [F.col("cdc_timestamp").desc_nulls_last(), F.col("updated_at").desc_nulls_last()] + \
            [F.col(c).desc_nulls_last() for c in rows.columns]
    rows = dedup_by(rows, ["merchant_id", "valid_from"], order)
    nxt = F.lead("valid_from").over(Window.partitionBy("merchant_id").orderBy("valid_from"))
    return rows.withColumn("__next", nxt).withColumns({
        "valid_to": F.coalesce(F.date_sub(F.col("__next"), 1), F.col("valid_to")),
        "is_active": F.col("__next").isNull(),
    }).drop("__next")


def scd2_insert(stage: DataFrame, start_key: int = 1, mode: str = "compat") -> DataFrame:
    """New dimension rows for the batch, keyed from ``start_key`` in version order."""
    rows = _new_versions(stage, mode)
    keyed = assign_surrogate_keys(rows, DIM_KEY, order_by=VERSION_ORDER, start=start_key)
    return keyed.select(*DIM_COLUMNS)


def opens_version() -> Column:
    """The change is one that makes a version: an insert or an update."""
    return F.col("cdc_op").isin("I", "U")


def rejected_versions(stage: DataFrame) -> DataFrame:
    """Changes without a valid_from: no interval can hold them, and the table's NOT NULL refuses them."""
    return stage.filter(opens_version() & F.col("valid_from").isNull())


def _chained(dim: DataFrame, inserted: DataFrame) -> DataFrame:
    """Strict: the merchants of the batch with their stored versions, as one chain each by valid_from.

    So a change that is older than the current version takes its place in the past.
    Versions whose interval changes take the successor's updated_at.
    """
    both = dim.withColumn("__new", F.lit(0)).unionByName(inserted.withColumn("__new", F.lit(1)))
    w = Window.partitionBy("merchant_id").orderBy("valid_from", "__new", DIM_KEY)
    nxt = F.lead(F.struct("valid_from", "updated_at")).over(w)
    moved = ~F.col("valid_to").eqNullSafe(F.col("__to")) | (F.col("is_active") != F.col("__on"))
    return both.withColumn("__next", nxt).withColumns({
        "__to": F.coalesce(F.date_sub(F.col("__next.valid_from"), 1), F.lit(OPEN_END_DATE).cast(T.DateType())),
        "__on": F.col("__next").isNull(),
    }).withColumns({
        "updated_at": F.when((F.col("__new") == 0) & moved & F.col("__next").isNotNull(), F.col("__next.updated_at")).otherwise(F.col("updated_at")),
        "valid_to": F.col("__to"), "is_active": F.col("__on"),
    }).select(*DIM_COLUMNS)


def scd2_apply(dim: DataFrame | None, stage: DataFrame, mode: str = "compat") -> DataFrame:
    """Next snapshot of the dimension after one staged CDC batch (rejected_versions() left out)."""
    if mode not in ("compat", "strict"):
        raise ValueError("mode must be 'compat' or 'strict'")
    stage = stage.filter(F.col("valid_from").isNotNull())
    if dim is None:
        return scd2_insert(stage, 1, mode)
    inserted = scd2_insert(stage, next_key(dim, DIM_KEY), mode)
    if mode == "compat":
        return scd2_expire(dim, stage, mode).select(*DIM_COLUMNS).unionByName(inserted)
    ids = inserted.select("merchant_id").distinct()
    dim = dim.select(*DIM_COLUMNS)
    return dim.join(ids, "merchant_id", "left_anti").select(*DIM_COLUMNS).unionByName(_chained(dim.join(ids, "merchant_id", "left_semi"), inserted))


def change_ledger(stage: DataFrame) -> DataFrame:
    """The ledger rows of a staged batch: one for each distinct change that opens a version."""
    rows = stage.filter(opens_version() & F.col("valid_from").isNotNull())
    digest = row_hash([c for c in MERCHANT_STAGE_COLUMNS if c in stage.columns])
    return rows.select("merchant_id", "valid_from", digest.alias("change_hash")).distinct()


def unapplied(stage: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """The staged rows whose change is not in the ledger.

    The digest covers every column, so it alone decides; the ledger's rows of the batch's own
    changes are found first, by a size-checked broadcast of the batch's digests.
    """
    if ledger is None:
        return stage
    keyed = stage.withColumn("change_hash", row_hash([c for c in MERCHANT_STAGE_COLUMNS if c in stage.columns]))
    known = semi_join_known(ledger, keyed, "change_hash").select("change_hash")
    return keyed.join(known, "change_hash", "left_anti").select(*stage.columns)


def scd2_apply_once(dim: DataFrame | None, stage: DataFrame, ledger: DataFrame | None,
                    mode: str = "strict") -> tuple[DataFrame, DataFrame]:
    """The next snapshots of the dimension and of its ledger; changes in ``ledger`` are left out.

    ``stage`` is read several times: give a stored one.  Within one batch nothing is
    collapsed beyond what ``mode`` does.
    """
    fresh = unapplied(stage, ledger)
    added = change_ledger(fresh)
    return scd2_apply(dim, fresh, mode), added if ledger is None else ledger.unionByName(added)


def active_members(dim: DataFrame) -> DataFrame:
    """Current versions only (``is_active``)."""
    return dim.filter(F.col("is_active"))
