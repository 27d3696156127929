"""Table contracts: column lists and typed schemas for bronze, silver and gold.

Bronze is all-string (CSV); silver passes columns through and adds typed ones;
gold tables have fixed column lists and types.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's for identical results).
# ---------------------------------------------------------------------------

# Literal text tokens that mean "no value" in the raw extracts (exact match,
# before any trimming).
NULL_TOKENS = ["NULL", "null", "Null", "N/A", "NA", "", "  ", "None", "none"]

# Raw merchant extract: source columns plus the change-capture columns.
MERCHANT_SOURCE_COLUMNS = [
    "merchant_id", "merchant_name", "legal_entity_name", "tax_id",
    "business_category", "merchant_tier", "onboarding_status",
    "region", "city", "state", "country", "postal_code", "timezone",
    "onboarding_date", "contract_start_date", "contract_end_date",
    "commission_rate", "monthly_fee", "created_at", "updated_at",
]
CDC_COLUMNS = ["op", "cdc_timestamp"]

# Raw transaction extract.
TRANSACTION_SOURCE_COLUMNS = [
    "transaction_id", "merchant_id", "customer_id",
    "transaction_timestamp", "processed_timestamp",
    "payment_method", "transaction_status", "currency",
    "gross_amount", "discount_amount", "tax_amount", "net_amount", "refund_amount",
    "emi_enabled", "emi_tenure_months", "emi_interest_rate",
    "gateway_response", "transaction_metadata", "created_at", "updated_at",
]

# Silver merchants.
MERCHANT_REQUIRED = ["merchant_id", "tax_id"]
MERCHANT_STRING_COLUMNS = [
    "merchant_name", "legal_entity_name", "business_category",
    "merchant_tier", "onboarding_status", "region", "city",
    "state", "country", "postal_code", "timezone",
]
MERCHANT_DATE_COLUMNS = [
    "onboarding_date", "contract_start_date", "contract_end_date", "last_transaction_date",
]
MERCHANT_DECIMAL_COLUMNS = ["commission_rate", "monthly_fee"]
MERCHANT_PARTITION = ["country"]

# Silver transactions.
TRANSACTION_DEDUP_KEYS = ["transaction_id", "transaction_timestamp"]
TRANSACTION_TIMESTAMP_COLUMNS = ["transaction_timestamp", "processed_timestamp"]
TRANSACTION_REQUIRED = ["transaction_id", "merchant_id", "transaction_timestamp"]
TRANSACTION_STRING_COLUMNS = [
    "gateway_status", "gateway_transaction_id", "gateway_name", "payment_channel", "device_type",
]
TRANSACTION_MONEY_COLUMNS = [
    "gross_amount", "discount_amount", "tax_amount", "net_amount", "refund_amount", "gateway_fee",
]
TRANSACTION_PARTITION = ["year", "month"]

# JSON fields pulled into silver: (output column, JSON column, field, type).
SILVER_JSON_FIELDS = [
    ("gateway_fee", "gateway_response", "gateway_fee", T.DecimalType(10, 2)),
    ("gateway_status", "gateway_response", "gateway_status", T.StringType()),
    ("gateway_transaction_id", "gateway_response", "gateway_transaction_id", T.StringType()),
    ("gateway_name", "gateway_response", "gateway_name", T.StringType()),
    ("risk_score", "transaction_metadata", "risk_score", T.IntegerType()),
    ("processing_time_ms", "transaction_metadata", "processing_time_ms", T.IntegerType()),
    ("payment_channel", "transaction_metadata", "payment_channel", T.StringType()),
    ("device_type", "transaction_metadata", "device_type", T.StringType()),
    ("payment_latitude", "transaction_metadata", "payment_latitude", T.DecimalType(10, 8)),
    ("payment_longitude", "transaction_metadata", "payment_longitude", T.DecimalType(11, 8)),
]

# JSON fields pulled in gold (the fact build).
GOLD_JSON_FIELDS = [
    ("gateway_retry_count", "gateway_response", "gateway_retry_count", T.IntegerType()),
    ("gateway_timestamp", "gateway_response", "gateway_timestamp", T.TimestampNTZType()),
    ("ip_address", "transaction_metadata", "ip_address", T.StringType()),
    ("card_type", "transaction_metadata", "card_type", T.StringType()),
    ("card_brand_name", "transaction_metadata", "card_brand", T.StringType()),
    ("user_agent", "transaction_metadata", "user_agent", T.StringType()),
    ("is_online_flag", "transaction_metadata", "is_online", T.BooleanType()),
]
GOLD_NORMALISED_JSON = ["card_type", "card_brand_name"]

# Merchant staging / dimension column order.
MERCHANT_STAGE_COLUMNS = [
    "cdc_op", "cdc_timestamp",
    "merchant_id", "merchant_name", "legal_entity_name", "tax_id",
    "business_category_code", "merchant_tier_code", "onboarding_status_code",
    "region", "city", "state", "country", "postal_code", "timezone",
    "commission_rate", "monthly_fee",
    "onboarding_date", "contract_start_date", "contract_end_date",
    "valid_from", "valid_to", "is_active",
    "created_at", "updated_at",
]
MERCHANT_CODE_RENAMES = {
    "business_category": "business_category_code",
    "merchant_tier": "merchant_tier_code",
    "onboarding_status": "onboarding_status_code",
}
OPEN_END_DATE = "9999-12-31"

# Fact column order.
FACT_COLUMNS = [
    "transaction_id", "merchant_key", "customer_id",
    "payment_junk_key", "card_device_junk_key",
    "transaction_timestamp", "transaction_date_key",
    "processed_timestamp", "processed_date_key",
    "gateway_timestamp", "gateway_date_key",
    "gross_amount", "discount_amount", "tax_amount",
    "net_amount", "refund_amount",
    "emi_enabled", "emi_tenure_months", "emi_interest_rate",
    "ip_address", "payment_latitude", "payment_longitude",
    "processing_time_ms", "gateway_fee",
    "gateway_status", "gateway_retry_count",
    "discount_applied",
    "created_at",
    "year", "month",
]
FACT_RENAMES = {
    "payment_method": "payment_method_code",
    "transaction_status": "transaction_status_code",
    "currency": "currency_code",
    "device_type": "device_type_desc",
}

# Junk dimensions: key column and attribute columns (null-safe lookup keys).
PAYMENT_JUNK_KEY = "payment_junk_key"
PAYMENT_JUNK_ATTRS = [
    "payment_method_code", "transaction_status_code", "currency_code", "gateway_name", "is_online_flag",
]
CARD_JUNK_KEY = "card_device_junk_key"
CARD_JUNK_ATTRS = ["card_type", "card_brand_name", "device_type_desc", "is_mac"]
UNKNOWN_MEMBER_KEY = -1

# Calendar defaults.
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"
WEEKEND_DAYS = [1, 7]  # dayofweek(): Sunday = 1 ... Saturday = 7
FISCAL_START_MONTH = 4  # April; fiscal year labelled by its ending calendar year

DIM_DATE_COLUMNS = [
    "date_key", "full_date", "day_of_week", "day_of_week_name", "day_of_month",
    "day_of_year", "week_of_year", "month_number", "month_name", "quarter", "year",
    "is_weekend", "is_holiday", "fiscal_year", "fiscal_quarter",
]

# ---------------------------------------------------------------------------
# Typed schemas
# ---------------------------------------------------------------------------


def all_string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


RAW_MERCHANT_SCHEMA = all_string_schema(CDC_COLUMNS + MERCHANT_SOURCE_COLUMNS)
RAW_TRANSACTION_SCHEMA = all_string_schema(TRANSACTION_SOURCE_COLUMNS)

MERCHANT_STAGE_TYPES = {
    "cdc_op": T.StringType(), "cdc_timestamp": T.TimestampNTZType(),
    "merchant_id": T.LongType(), "merchant_name": T.StringType(),
    "legal_entity_name": T.StringType(), "tax_id": T.StringType(),
    "business_category_code": T.IntegerType(), "merchant_tier_code": T.IntegerType(),
    "onboarding_status_code": T.IntegerType(),
    "region": T.StringType(), "city": T.StringType(), "state": T.StringType(),
    "country": T.StringType(), "postal_code": T.StringType(), "timezone": T.StringType(),
    "commission_rate": T.DecimalType(5, 2), "monthly_fee": T.DecimalType(10, 2),
    "onboarding_date": T.IntegerType(), "contract_start_date": T.IntegerType(),
    "contract_end_date": T.IntegerType(),
    "valid_from": T.DateType(), "valid_to": T.DateType(), "is_active": T.BooleanType(),
    "created_at": T.TimestampNTZType(), "updated_at": T.TimestampNTZType(),
}

FACT_TYPES = {
    "transaction_id": T.StringType(), "merchant_key": T.LongType(), "customer_id": T.LongType(),
    "payment_junk_key": T.IntegerType(), "card_device_junk_key": T.IntegerType(),
    "transaction_timestamp": T.TimestampNTZType(), "transaction_date_key": T.IntegerType(),
    "processed_timestamp": T.TimestampNTZType(), "processed_date_key": T.IntegerType(),
    "gateway_timestamp": T.TimestampNTZType(), "gateway_date_key": T.IntegerType(),
    "gross_amount": T.DecimalType(12, 2), "discount_amount": T.DecimalType(12, 2),
    "tax_amount": T.DecimalType(12, 2), "net_amount": T.DecimalType(12, 2),
    "refund_amount": T.DecimalType(12, 2),
    "emi_enabled": T.BooleanType(), "emi_tenure_months": T.IntegerType(),
    "emi_interest_rate": T.DecimalType(5, 2),
    "ip_address": T.StringType(), "payment_latitude": T.DecimalType(10, 8),
    "payment_longitude": T.DecimalType(11, 8), "processing_time_ms": T.IntegerType(),
    "gateway_fee": T.DecimalType(10, 2), "gateway_status": T.StringType(),
    "gateway_retry_count": T.IntegerType(), "discount_applied": T.BooleanType(),
    "created_at": T.TimestampNTZType(), "year": T.IntegerType(), "month": T.IntegerType(),
}

# NOT NULL columns and VARCHAR widths of the gold tables (contract checks).
NOT_NULL = {
    "dim_date": DIM_DATE_COLUMNS[:13],
    "dim_merchant": ["merchant_key", "merchant_id", "valid_from", "valid_to", "is_active",
                     "created_at", "updated_at"],
    "fact_transactions": ["transaction_id", "merchant_key", "payment_junk_key",
                          "card_device_junk_key", "transaction_timestamp",
                          "transaction_date_key", "created_at", "year", "month"],
}
VARCHAR_WIDTHS = {
    "dim_date": {"day_of_week_name": 10, "month_name": 10},
    "dim_merchant": {"merchant_name": 200, "legal_entity_name": 200, "tax_id": 50,
                     "region": 50, "city": 100, "state": 50, "country": 50,
                     "postal_code": 20, "timezone": 50},
    "fact_transactions": {"transaction_id": 100, "ip_address": 45, "gateway_status": 50},
}
PRIMARY_KEYS = {"dim_date": "date_key", "dim_merchant": "merchant_key",
                "fact_transactions": "transaction_key"}
