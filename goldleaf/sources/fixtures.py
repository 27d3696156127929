"""Raw (bronze) payment extracts derived from the TPC-H-like test tables.

The column expressions below are the adapters documented in FIXTURES.md
(part B).  One list of SQL expressions serves both engines: Spark evaluates it
with ``selectExpr`` and the DuckDB oracle inlines it as a CTE, so both read the
very same raw rows.  ``STR`` is the engine's string type name.

Every raw column is a string, exactly as a CSV extract would deliver it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Batch marker of the merchant extract: v = 0 is the initial load, v = 1 an
# update batch for every tenth customer (told apart later by cdc_timestamp).
MERCHANT_BATCH_TIMESTAMPS = {0: "2023-01-01 00:00:00", 1: "2024-06-01 00:00:00"}

RAW_MERCHANT_EXPRS = [
    ("op", "case when c_custkey % 10 = 0 and v = 1 then 'U' when c_custkey % 97 = 0 then 'D' else 'I' end"),
    ("cdc_timestamp", "case when v = 1 then '2024-06-01 00:00:00' else '2023-01-01 00:00:00' end"),
    ("merchant_id", "cast(c_custkey as STR)"),
    ("merchant_name", "case when c_custkey % 19 = 0 then 'N/A' when c_custkey % 23 = 0 then '  ' "
                      "when c_custkey % 53 = 0 then '   ' else concat(' ', c_name, ' ') end"),
    ("legal_entity_name", "concat(c_name, ' LLC')"),
    ("tax_id", "case when c_custkey % 29 = 0 then 'NULL' else concat('TX', cast(c_custkey as STR)) end"),
    ("business_category", "cast(c_nationkey % 7 as STR)"),
    ("merchant_tier", "cast(c_custkey % 3 + v as STR)"),
    ("onboarding_status", "cast(c_custkey % 4 as STR)"),
    ("region", "r_name"),
    ("city", "c_mktsegment"),
    ("state", "n_name"),
    ("country", "case when c_custkey % 31 = 0 then 'None' else concat(' Country', cast(c_nationkey as STR)) end"),
    ("postal_code", "cast(10000 + c_custkey as STR)"),
    ("timezone", "'Asia/Kolkata'"),
    ("onboarding_date", "case when c_custkey % 37 = 0 then 'not-a-date' "
                        "else concat('2020-0', cast(1 + c_custkey % 9 as STR), '-15') end"),
    ("contract_start_date", "'2020-01-01'"),
    ("contract_end_date", "case when c_custkey % 5 = 0 then 'NA' else '2029-12-31' end"),
    ("commission_rate", "concat(cast(c_custkey % 9 as STR), '.', cast(10 + c_custkey % 90 as STR))"),
    ("monthly_fee", "cast(cast(c_acctbal as decimal(12,2)) as STR)"),
    ("created_at", "'2023-01-01 00:00:00'"),
    ("updated_at", "case when v = 1 then '2024-06-01 00:00:00' else '2023-01-01 00:00:00' end"),
]

_SHIFTED_ORDER_DATE = "cast(cast(o_orderdate + interval '25' year as date) as STR)"

RAW_TRANSACTION_EXPRS = [
    ("transaction_id", "concat(cast(l_orderkey as STR), '-', cast(l_linenumber as STR))"),
    ("merchant_id", "case when l_partkey % 101 = 0 then 'null' else cast(case when l_partkey % 47 = 0 "
                    "then 900000000 + o_custkey else o_custkey end as STR) end"),
    ("customer_id", "cast(l_suppkey as STR)"),
    ("transaction_timestamp", f"case when l_partkey % 59 = 0 then 'bad-ts' else concat({_SHIFTED_ORDER_DATE}, "
                              "case when l_partkey % 13 = 0 then 'T' else ' ' end, '10:00:00') end"),
    ("processed_timestamp", "case when l_partkey % 7 = 0 then null else concat(cast(cast(l_shipdate + "
                            "interval '25' year as date) as STR), ' 12:30:00') end"),
    ("payment_method", "cast(l_linenumber as STR)"),
    ("transaction_status", "case when o_orderstatus = 'P' then null when o_orderstatus = 'F' then '1' else '2' end"),
    ("currency", "cast(l_suppkey % 3 as STR)"),
    ("gross_amount", "case when l_suppkey % 41 = 0 then 'N/A' else cast(cast(l_extendedprice as decimal(12,2)) as STR) end"),
    ("discount_amount", "cast(cast(l_discount * 100 as decimal(12,2)) as STR)"),
    ("tax_amount", "cast(cast(l_tax * 100 as decimal(12,2)) as STR)"),
    ("net_amount", "cast(cast(case when l_partkey % 67 = 0 then -l_quantity else l_extendedprice end "
                   "as decimal(12,2)) as STR)"),
    ("refund_amount", "case when l_returnflag = 'R' then cast(cast(l_quantity as decimal(12,2)) as STR) else '0' end"),
    ("emi_enabled", "case when l_linestatus = 'O' then '1' else '0' end"),
    ("emi_tenure_months", "cast(l_linenumber * 3 as STR)"),
    ("emi_interest_rate", "'12.50'"),
    ("gateway_response",
     "case when l_partkey % 43 = 0 then null else concat('{\"gateway_fee\": ', "
     "cast(cast(l_tax * 100 as decimal(10,2)) as STR), ', \"gateway_name\": \"', "
     "case when l_returnflag = 'A' then 'Auropay' when l_returnflag = 'N' then 'Stripe' else 'Razorpay' end, "
     "'\", \"gateway_status\": \" Success\", \"gateway_timestamp\": ', "
     f"case when l_partkey % 11 = 0 then 'null' else concat('\"', {_SHIFTED_ORDER_DATE}, 'T10:00:05\"') end, "
     "', \"gateway_retry_count\": ', cast(l_linenumber % 3 as STR), "
     "', \"gateway_transaction_id\": \"GW', cast(l_orderkey as STR), '\"}') end"),
    ("transaction_metadata",
     "concat('{\"card_type\": ', case when l_suppkey % 4 = 0 then 'null' else '\"Credit \"' end, "
     "', \"card_brand\": ', case when l_suppkey % 4 = 0 then 'null' when l_suppkey % 4 = 1 then '\"Visa\"' "
     "else '\"MasterCard\"' end, ', \"is_online\": ', case when l_suppkey % 5 = 0 then 'null' "
     "when l_suppkey % 2 = 0 then 'true' else 'false' end, ', \"ip_address\": \"10.0.0.', "
     "cast(l_suppkey % 250 as STR), '\", \"risk_score\": ', cast(l_partkey % 100 as STR), "
     "', \"user_agent\": ', case when l_partkey % 3 = 0 then 'null' when l_partkey % 3 = 1 "
     "then '\"Mozilla (Macintosh)\"' else '\"Mozilla (machine)\"' end, ', \"device_type\": ', "
     "case when l_partkey % 3 = 0 then 'null' else '\"Mobile\"' end, ', \"payment_channel\": \"in_store\", "
     "\"payment_latitude\": 19.08727703, \"payment_longitude\": 72.84226186, \"processing_time_ms\": ', "
     "cast(l_partkey as STR), '}')"),
    ("created_at", f"concat({_SHIFTED_ORDER_DATE}, ' 10:00:00')"),
    ("updated_at", f"concat({_SHIFTED_ORDER_DATE}, ' 10:00:00')"),
]


def _exprs(pairs, string_type: str) -> list[str]:
    return [f"{expr.replace('STR', string_type)} AS {name}" for name, expr in pairs]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchant extract, both CDC batches (one pass over customer, no join fan-out)."""
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation (25 rows) and region (5 rows) have a fixed size by the TPC-H specification
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    base = customer.join(F.broadcast(geo), customer.c_nationkey == geo.n_nationkey)
    # every customer is in batch 0; every tenth one has a second version in batch 1
    batches = F.when(F.col("c_custkey") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return base.withColumn("v", F.explode(batches)).selectExpr(*_exprs(RAW_MERCHANT_EXPRS, "string"))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction extract: one row per lineitem, joined to its order."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    joined = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    return joined.selectExpr(*_exprs(RAW_TRANSACTION_EXPRS, "string"))


def merchant_batch(raw: DataFrame, v: int) -> DataFrame:
    """One CDC batch of the merchant extract."""
    return raw.filter(F.col("cdc_timestamp") == MERCHANT_BATCH_TIMESTAMPS[v])


# ---------------------------------------------------------------------------
# DuckDB forms of the same adapters (for the oracle).
# ---------------------------------------------------------------------------

RAW_MERCHANTS_SQL = (
    "SELECT " + ",\n  ".join(_exprs(RAW_MERCHANT_EXPRS, "varchar")) + "\nFROM (\n"
    "  SELECT c.*, n.n_name, r.r_name, "
    "unnest(CASE WHEN c.c_custkey % 10 = 0 THEN [0, 1] ELSE [0] END) AS v\n"
    "  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey\n"
    "  JOIN region r ON n.n_regionkey = r.r_regionkey) base"
)

RAW_TRANSACTIONS_SQL = (
    "SELECT " + ",\n  ".join(_exprs(RAW_TRANSACTION_EXPRS, "varchar")) +
    "\nFROM lineitem JOIN orders ON l_orderkey = o_orderkey"
)
