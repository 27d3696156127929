"""Bronze -> silver pipelines for merchants (D10) and transactions.

Step order is part of the semantics and is kept: null tokens are removed
before trimming (so ``' NA '`` survives), de-duplication runs before the
required-field check, JSON is read after the token cleaning (a JSON value
``"NA"`` is kept) and the required check runs after the timestamp parse (so
unparseable times drop the row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.contracts import (MERCHANT_DATE_COLUMNS, MERCHANT_DECIMAL_COLUMNS, MERCHANT_REQUIRED,
                                MERCHANT_STRING_COLUMNS, SILVER_JSON_FIELDS,
                                TRANSACTION_DEDUP_KEYS, TRANSACTION_MONEY_COLUMNS,
                                TRANSACTION_REQUIRED, TRANSACTION_STRING_COLUMNS,
                                TRANSACTION_TIMESTAMP_COLUMNS)
from goldleaf.functions import with_json_fields
from goldleaf.operators.clean import (add_date_keys, cast_decimals, clean_nulls, drop_negative,
                                      drop_required, present, to_dates, to_timestamps, trim_lower)
from goldleaf.operators.dedup import dedup_by, dedup_wide, order_desc
from goldleaf.operators.row_marks import AT, numbered, semi_join_numbered


def merchant_order(df: DataFrame):
    """Survivor order for merchant duplicates: latest change first, then all other columns."""
    first = present(df, ["cdc_timestamp", "updated_at"])
    return order_desc(first + [c for c in df.columns if c not in first and c != "merchant_id"])


def dedup_merchants(df: DataFrame) -> DataFrame:
    return dedup_by(df, ["merchant_id"], merchant_order(df))


def dedup_transactions(df: DataFrame) -> DataFrame:
    """One row per (id, raw timestamp text); survivor: all columns descending."""
    return dedup_wide(df, TRANSACTION_DEDUP_KEYS)


def extract_silver_json(df: DataFrame, fields=SILVER_JSON_FIELDS) -> DataFrame:
    """Typed columns from the two JSON documents (each parsed once)."""
    for source in dict.fromkeys(src for _, src, _, _ in fields):
        if source in df.columns:
            df = with_json_fields(df, source, [(n, f, t) for n, s, f, t in fields if s == source])
    return df


def partition_columns(df: DataFrame, ts_col: str = "transaction_timestamp") -> DataFrame:
    """``year`` (yyyy) and ``month`` (MM) text columns for the partitioned layout."""
    return df.withColumns({"year": F.date_format(ts_col, "yyyy"), "month": F.date_format(ts_col, "MM")})


def silver_merchants(raw: DataFrame) -> DataFrame:
    df = clean_nulls(raw)
    df = dedup_merchants(df)
    df = drop_required(df, MERCHANT_REQUIRED)
    df = trim_lower(df, MERCHANT_STRING_COLUMNS)
    df = to_dates(df, MERCHANT_DATE_COLUMNS)
    df = add_date_keys(df, MERCHANT_DATE_COLUMNS)
    df = cast_decimals(df, MERCHANT_DECIMAL_COLUMNS, 10, 2)
    return drop_negative(df, MERCHANT_DECIMAL_COLUMNS)


def clean_transactions(raw: DataFrame) -> DataFrame:
    """D11 up to (not including) the referential filter."""
    return clean_transaction_rows(dedup_transactions(clean_nulls(raw)))


def sound_transactions(df: DataFrame) -> DataFrame:
    """The rows that ``clean_transaction_rows`` keeps, without the columns that it adds (see ``with_derived``)."""
    return clean_transaction_rows(df).select(*df.columns)


def with_derived(sound: DataFrame) -> DataFrame:
    """``clean_transaction_rows`` of rows that passed ``sound_transactions``: its added columns, nothing filtered."""
    df = add_date_keys(extract_silver_json(sound), TRANSACTION_TIMESTAMP_COLUMNS)
    return cast_decimals(trim_lower(df, TRANSACTION_STRING_COLUMNS), TRANSACTION_MONEY_COLUMNS, 12, 2)


def clean_transaction_rows(df: DataFrame) -> DataFrame:
    """The steps of D11 after null tokens and duplicates: each looks at one row, so a stream can take them."""
    df = extract_silver_json(df)
    df = to_timestamps(df, TRANSACTION_TIMESTAMP_COLUMNS)
    df = drop_required(df, TRANSACTION_REQUIRED)
    df = add_date_keys(df, TRANSACTION_TIMESTAMP_COLUMNS)
    df = trim_lower(df, TRANSACTION_STRING_COLUMNS)
    df = cast_decimals(df, TRANSACTION_MONEY_COLUMNS, 12, 2)
    return drop_negative(df, TRANSACTION_MONEY_COLUMNS)


def silver_transactions(raw: DataFrame, known_merchants: DataFrame) -> DataFrame:
    """Full D11: cleaned transactions of known merchants, with partition columns."""
    rows = numbered(clean_nulls(raw))
    df = clean_transaction_rows(dedup_transactions(rows))
    df = semi_join_numbered(df, rows, known_merchants, "merchant_id")
    return partition_columns(df if AT in raw.columns else df.drop(AT))
