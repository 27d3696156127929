"""Joins against dimensions: size-checked broadcast, lookups, referential filters.

``bounded_broadcast`` only hints a broadcast after proving the side is small:
one partial aggregate sums the real bytes of its rows (a number from each
task).  Beyond the budget no hint is given and
Catalyst/AQE choose a shuffled join (AQE may still switch to a broadcast at
run time from real sizes, and splits skewed partitions).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BUDGET_CONF = "goldleaf.broadcast.maxBytes"
DEFAULT_BROADCAST_BUDGET = 64 * 1024 * 1024


def _budget(df: DataFrame) -> int:
    try:
        return int(df.sparkSession.conf.get(BROADCAST_BUDGET_CONF, str(DEFAULT_BROADCAST_BUDGET)))
    except Exception:
        return DEFAULT_BROADCAST_BUDGET


def row_bytes(df: DataFrame) -> F.Column:
    """Bytes of one row in a hash relation: real lengths of texts, 16 for any fixed-width value, 16 overhead."""
    total = F.lit(16)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + 16 + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + 16 + F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
        else:
            total = total + 16
    return total


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether the rows' real bytes, summed by a distributed aggregate, stay within the budget."""
    budget = max_bytes if max_bytes is not None else _budget(df)
    size = df.agg(F.sum(row_bytes(df).cast("long")).alias("n")).first()["n"]
    return (size or 0) <= budget


def bounded_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` if its size is proven under the budget, else ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def semi_join_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs in ``known`` (referential filter, no fan-out)."""
    ids = known.select(key)
    small = fits_broadcast(ids)
    ids = ids.distinct()
    return df.join(F.broadcast(ids) if small else ids, on=key, how="left_semi")


def lookup_key(df: DataFrame, dim: DataFrame, on: str, key_col: str, how: str = "inner") -> DataFrame:
    """Attach ``key_col`` from ``dim`` by equality on ``on``."""
    side = dim.select(on, key_col)
    return df.join(bounded_broadcast(side), on=on, how=how)


def null_safe_lookup(df: DataFrame, dim: DataFrame, attrs: Sequence[str], key_col: str,
                     default=None) -> DataFrame:
    """Left lookup of ``key_col`` where NULL matches NULL on every attribute.

    A miss leaves ``key_col`` NULL, or ``default`` when given (unknown member).
    Catalyst rewrites ``<=>`` into hashable keys, so this stays a hash join.
    """
    side = dim.select(key_col, *[F.col(a).alias(f"__lk_{a}") for a in attrs])
    cond = reduce(lambda a, b: a & b, [df[a].eqNullSafe(side[f"__lk_{a}"]) for a in attrs])
    out = df.join(bounded_broadcast(side), on=cond, how="left").drop(*[f"__lk_{a}" for a in attrs])
    if default is not None:
        out = out.withColumn(key_col, F.coalesce(F.col(key_col), F.lit(default).cast(dim.schema[key_col].dataType)))
    return out


def plain_lookup(df: DataFrame, dim: DataFrame, attrs: Sequence[str], key_col: str) -> DataFrame:
    """Left lookup with ordinary equality (NULL never matches) — the contrast case."""
    side = dim.select(key_col, *attrs)
    return df.join(bounded_broadcast(side), on=list(attrs), how="left")
