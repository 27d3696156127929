"""Transaction fact: derived columns, dimension lookups, final contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.contracts import (CARD_JUNK_ATTRS, CARD_JUNK_KEY, FACT_COLUMNS, FACT_RENAMES, FACT_TYPES,
                                GOLD_JSON_FIELDS, GOLD_NORMALISED_JSON, PAYMENT_JUNK_ATTRS,
                                PAYMENT_JUNK_KEY, UNKNOWN_MEMBER_KEY)
from goldleaf.functions import date_key_int, normalise, try_bool, try_int, try_long, with_json_fields
from goldleaf.operators.clean import (conform, rename_existing, require_columns, select_existing,
                                      transform_columns)
from goldleaf.operators.joins import lookup_key, null_safe_lookup
from goldleaf.operators.scd2 import active_members


def extract_gold_json(df: DataFrame) -> DataFrame:
    sources = [s for s in ("gateway_response", "transaction_metadata") if s in df.columns]
    if not sources:
        return df
    for source in sources:
        df = with_json_fields(df, source, [(n, f, t) for n, s, f, t in GOLD_JSON_FIELDS if s == source])
    df = transform_columns(df, GOLD_NORMALISED_JSON, normalise)
    if "transaction_metadata" in df.columns:
        ua = F.col("user_agent")
        df = df.withColumns({
            "is_online_flag": F.coalesce(F.col("is_online_flag"), F.lit(False)),
            # unanchored, case-sensitive match; NULL agent -> NULL flag
            "is_mac": F.when(ua.isNull(), F.lit(None).cast(T.BooleanType())).otherwise(ua.rlike("Mac")),
        })
    return df


# silver columns the fact derivation relies on (checked up front, with a clear message)
FACT_INPUT_COLUMNS = ["transaction_id", "merchant_id", "transaction_timestamp", "discount_amount",
                      "transaction_timestamp_date_key", "processed_timestamp_date_key",
                      "year", "month", "emi_enabled"]


def derive_fact_columns(silver: DataFrame) -> DataFrame:
    """Silver transactions -> fact attributes before the lookups."""
    require_columns(silver, FACT_INPUT_COLUMNS, "silver transactions")
    df = extract_gold_json(silver)
    gts = F.col("gateway_timestamp")
    df = df.withColumns({
        "discount_applied": F.col("discount_amount") > 0,
        "gateway_date_key": F.when(gts.isNotNull(), date_key_int(gts)).otherwise(F.lit(None).cast(T.IntegerType())),
        "transaction_date_key": try_int("transaction_timestamp_date_key"),
        "processed_date_key": try_int("processed_timestamp_date_key"),
        "year": try_int("year"),
        "month": try_int("month"),
        "emi_enabled": try_bool("emi_enabled"),
        # ids and codes arrive as text: cast once, leniently
        "merchant_id": try_long("merchant_id"),
        "customer_id": try_long("customer_id"),
        "payment_method": try_int("payment_method"),
        "transaction_status": try_int("transaction_status"),
        "currency": try_int("currency"),
    })
    return rename_existing(df, FACT_RENAMES)


def build_fact(derived: DataFrame, dim_merchant: DataFrame, junk_payment: DataFrame,
               junk_card: DataFrame, current_only: bool = True) -> DataFrame:
    """Lookups (current merchant version, both junk keys with -1 default) and the fact contract.

    ``current_only=False`` means ``dim_merchant`` is already the active
    (merchant_id, merchant_key) projection, e.g. read with the filter pushed
    into the scan.
    """
    merchants = active_members(dim_merchant) if current_only else dim_merchant
    merchants = merchants.select("merchant_id", "merchant_key")
    df = lookup_key(derived, merchants, "merchant_id", "merchant_key", how="inner")
    df = null_safe_lookup(df, junk_payment, PAYMENT_JUNK_ATTRS, PAYMENT_JUNK_KEY, default=UNKNOWN_MEMBER_KEY)
    df = null_safe_lookup(df, junk_card, CARD_JUNK_ATTRS, CARD_JUNK_KEY, default=UNKNOWN_MEMBER_KEY)
    return conform(select_existing(df, FACT_COLUMNS), FACT_TYPES)
