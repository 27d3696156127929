"""Cleaning operators (``DataFrame -> DataFrame``).

Every per-column operator tolerates absent columns: a name that is not in the
frame is skipped, so one pipeline serves extracts with optional columns.  Each
operator is a single projection or filter, so Catalyst collapses a chain of
them into one whole-stage-codegen span.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.contracts import NULL_TOKENS
from goldleaf.functions import (date_key, normalise, null_if_token, parse_date, parse_timestamp,
                                try_decimal)


def present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


def transform_columns(df: DataFrame, cols: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Replace each present column ``c`` of ``cols`` by ``fn(col(c))`` in one projection."""
    targets = present(df, cols)
    if not targets:
        return df
    return df.withColumns({c: fn(F.col(c)) for c in targets})


def clean_nulls(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS, trim_first: bool = False) -> DataFrame:
    """Every string column: exact null tokens become NULL (before any trimming).

    With ``trim_first`` blanks around a value are dropped first, so a padded token
    becomes NULL too.
    """
    string_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return transform_columns(df, string_cols, lambda c: null_if_token(F.trim(c) if trim_first else c, tokens))


def drop_required(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``cols`` is NULL.

    One predicate for each column, so those on a window's keys move below its shuffle.
    """
    for c in present(df, cols):
        df = df.filter(F.col(c).isNotNull())
    return df


def drop_negative(df: DataFrame, cols: Sequence[str], keep_nulls: bool = False) -> DataFrame:
    """Keep rows with ``c >= 0`` for each present column.

    As in SQL three-valued logic, a NULL value also drops the row unless
    ``keep_nulls`` is set.
    """
    targets = present(df, cols)
    if not targets:
        return df
    preds = [(F.col(c) >= 0) | F.col(c).isNull() if keep_nulls else F.col(c) >= 0 for c in targets]
    return df.filter(reduce(lambda a, b: a & b, preds))


def trim_lower(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return transform_columns(df, cols, normalise)


def to_dates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return transform_columns(df, cols, parse_date)


def to_timestamps(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return transform_columns(df, cols, parse_timestamp)


def cast_decimals(df: DataFrame, cols: Sequence[str], precision: int = 12, scale: int = 2) -> DataFrame:
    return transform_columns(df, cols, lambda c: try_decimal(c, precision, scale))


def add_date_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """For each present date/timestamp column ``c`` add text ``c_date_key`` (yyyyMMdd)."""
    targets = present(df, cols)
    if not targets:
        return df
    return df.withColumns({f"{c}_date_key": date_key(c) for c in targets})


def rename_existing(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename present columns; absent ones are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*present(df, cols))


def select_existing(df: DataFrame, cols: Sequence[str], strict: bool = False) -> DataFrame:
    """Select ``cols`` in that order; absent ones are omitted (or raise if ``strict``)."""
    if strict:
        missing = [c for c in cols if c not in df.columns]
        if missing:
            raise ValueError(f"missing columns: {missing}")
    return df.select(*present(df, cols))


def conform(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """Cast present columns to the contract types (leniently) and keep contract order."""
    cols = present(df, list(types))
    return df.select(*[F.col(c) if df.schema[c].dataType == types[c]
                       else F.col(c).try_cast(types[c]).alias(c) for c in cols])


def require_columns(df: DataFrame, cols: Sequence[str], what: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: required columns missing: {missing}")
