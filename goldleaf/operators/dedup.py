"""De-duplication operators.

``dedup_by`` keeps one row per key chosen by an explicit total order, so the
survivor is deterministic.  It is written as ``row_number() = 1``; Spark plans
that as a partial per-task top-1 (``WindowGroupLimit``) *before* the shuffle,
so a hot key sends at most one row per map task across the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.functions import row_hash
from goldleaf.operators.joins import bounded_broadcast
from goldleaf.operators.row_marks import AT, numbered, with_marked
from goldleaf.sources.files import store

_RN = "__goldleaf_rn"


def order_desc(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in cols]


def dedup_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per ``keys`` (NULL keys form one group); the first row by ``order`` wins.

    Default order: every column descending, NULLs last.
    """
    if not order:
        # the keys are constant inside a group: ordering by them would add work, not meaning
        order = order_desc([c for c in df.columns if c not in set(keys)] or keys[:1])
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def dedup_wide(df: DataFrame, keys: Sequence[str], lead: int = 2) -> DataFrame:
    """``dedup_by`` in its default order for wide rows, few of which are shuffled.

    The rows are numbered (see ``row_marks``; rows that come with a number keep it, and must
    be cheap to read again).  The keys, the first ``lead`` columns of the order and the number
    find the first two rows of each key, again limited per task before the shuffle.  Where these
    columns tell them apart the number of the first is enough; the rows of other keys (copies,
    above all) are told apart whole.
    """
    rows, keys = numbered(df), list(keys)
    front = [c for c in rows.columns if c not in keys and c != AT][:lead]
    w = Window.partitionBy(*keys).orderBy(*order_desc(front), AT)
    two = rows.select(*keys, *front, AT).withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) <= 2)
    value, first = F.struct(*front) if front else F.lit(0), F.col(_RN) == 1
    tied = (F.count(F.lit(1)) == 2) & F.max(F.when(first, value)).eqNullSafe(F.max(F.when(~first, value)))
    best = two.groupBy(*keys).agg(F.max(F.when(first, F.col(AT))).alias(AT), tied.alias("__tied"))
    told = F.when(F.col("__tied"), F.struct(*keys)).alias("__key")
    best = store(best.select(F.when(~F.col("__tied"), F.col(AT)).alias(AT), told), "best")
    sole = with_marked(rows, best.filter(F.col(AT).isNotNull()))
    open_keys = best.filter(F.col(AT).isNull()).select(*[F.col("__key")[k].alias(f"__key_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys]
    whole = rows.join(bounded_broadcast(open_keys), same, "left_semi")
    return sole.unionByName(dedup_by(whole, keys)).select(*df.columns)


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def late_dedup(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], ts_col: str,
               lookback: str = "7 days", horizon=None) -> DataFrame:
    """Drop late copies of rows already stored (batch form of a 7-day dedup).

    An incoming row is dropped when a stored row with the same ``keys`` has an
    event time within ``lookback`` of it; copies inside the batch collapse to
    one row per (keys, event time).  Only stored rows newer than ``horizon``
    (default: earliest incoming event time minus ``lookback``) are read; a stored
    table partitioned by ``year`` and ``month`` of that time is pruned to the
    folders from the horizon's month on.  Only keys, times and row numbers are shuffled;
    incoming rows that come with a number (see ``row_marks``) must be cheap to read again.
    """
    rows = numbered(incoming, "incoming")
    if horizon is None:
        first = rows.agg(F.min(ts_col) - F.expr(f"INTERVAL {lookback}")).first()[0]
        if first is None:  # empty batch: nothing to keep
            return incoming.filter(F.lit(False))
        horizon = F.lit(first)
        if {"year", "month"} <= set(existing.columns):
            year, month = F.col("year").cast("int"), F.col("month").cast("int")
            existing = existing.filter((year > first.year) | ((year == first.year) & (month >= first.month)))
    span = F.expr(f"INTERVAL {lookback}")
    recent = existing.filter(F.col(ts_col) >= horizon).select(
        *[F.col(k).alias(f"__old_{k}") for k in keys], F.col(ts_col).alias("__old_ts"))
    cond = [F.col(k) == F.col(f"__old_{k}") for k in keys]
    cond.append(F.col("__old_ts").between(F.col(ts_col) - span, F.col(ts_col) + span))
    fresh = with_marked(rows, rows.select(*dict.fromkeys([*keys, ts_col, AT])).join(recent, on=cond, how="left_anti"))
    return dedup_wide(fresh, list(dict.fromkeys([*keys, ts_col]))).select(*incoming.columns)


def with_row_hash(df: DataFrame, cols: Sequence[str], name: str = "row_hash") -> DataFrame:
    return df.withColumn(name, row_hash(cols))


def row_hash_anti(incoming: DataFrame, existing: DataFrame, cols: Sequence[str],
                  stored_hash: str | None = None) -> DataFrame:
    """Incoming rows whose content hash is not stored yet (exact re-sends are dropped).

    With ``stored_hash`` naming a hash column kept in ``existing`` (see
    ``with_row_hash``), the stored side is read as one narrow column instead
    of being re-hashed.  Only hashes and row numbers are shuffled; incoming rows
    that come with a number (see ``row_marks``) must be cheap to read again.
    """
    if stored_hash is not None and stored_hash in existing.columns:
        stored = existing.select(F.unhex(stored_hash).alias("__h"))
    else:
        stored = existing.select(F.unhex(row_hash(cols)).alias("__h"))
    rows = numbered(incoming, "incoming")
    sent = rows.select(F.unhex(row_hash(cols)).alias("__h"), AT).join(stored, on="__h", how="left_semi")
    return with_marked(rows, sent, keep=False).select(*incoming.columns)
