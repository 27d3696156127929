"""Unit tests on hand-made rows: cleaning quirks, casts, JSON, lookups, keys, calendar."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from goldleaf import contracts as C
from goldleaf.operators import clean as CL
from goldleaf.operators.calendar import build_dim_date
from goldleaf.operators.dedup import dedup_by, late_dedup, order_desc, row_hash_anti, with_row_hash
from goldleaf.operators.fact import extract_gold_json
from goldleaf.operators.joins import bounded_broadcast, fits_broadcast, null_safe_lookup, plain_lookup
from goldleaf.operators.keys import assign_surrogate_keys, build_junk_dimension
from goldleaf.operators.load import incremental_load, insert_absent
from goldleaf.operators.quality import contract_report
from goldleaf.plans import silver as S
from goldleaf.sources import files as IO


def rows(df, order=None):
    df = df.orderBy(*order) if order else df
    return [tuple(r) for r in df.collect()]


# --- F1 / X1: null tokens are exact and case-listed; trimming comes after ---------------

def test_null_tokens_exact_before_trim(spark):
    vals = ["NULL", "null", "Null", "N/A", "NA", "", "  ", "None", "none", " NA ", "nA", " ", "   ", "x"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    out = [r[0] for r in CL.clean_nulls(df).collect()]
    assert out[:9] == [None] * 9
    assert out[9:] == [" NA ", "nA", " ", "   ", "x"]
    norm = [r[0] for r in CL.trim_lower(CL.clean_nulls(df), ["v"]).collect()]
    assert norm[9:] == ["na", "na", "", "", "x"]  # blank-only becomes '', not NULL
    first = [r[0] for r in CL.clean_nulls(df, trim_first=True).collect()]
    assert first == [None] * 10 + ["nA", None, None, "x"]


def test_trim_keeps_tabs(spark):
    df = spark.createDataFrame([("\t A \t",)], "v string")
    assert CL.trim_lower(df, ["v"]).first()[0] == "\t a \t"


# --- F2 / F3: required and non-negative, NULL drops the row ------------------------------

def test_drop_negative_drops_nulls(spark):
    df = spark.createDataFrame([(1, Decimal("1.00")), (2, None), (3, Decimal("-0.01")), (4, Decimal("0"))],
                               "id int, amt decimal(12,2)")
    assert [r[0] for r in rows(CL.drop_negative(df, ["amt", "absent"]), ["id"])] == [1, 4]
    assert [r[0] for r in rows(CL.drop_negative(df, ["amt"], keep_nulls=True), ["id"])] == [1, 2, 4]


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([("a",)], "merchant_name string")
    assert CL.to_dates(df, ["onboarding_date"]).columns == ["merchant_name"]
    assert CL.add_date_keys(df, ["last_transaction_date"]).columns == ["merchant_name"]
    assert CL.drop_required(df, ["nope"]).count() == 1


# --- X4 X5 X7: lenient casts (ANSI stays on) --------------------------------------------

def test_decimal_rounding_and_overflow(spark):
    df = spark.createDataFrame([("1.005",), ("1.004",), ("-2.345",), ("123456789012",), ("abc",), (" 7 ",)], "v string")
    out = [r[0] for r in CL.cast_decimals(df, ["v"], 10, 2).collect()]
    assert out == [Decimal("1.01"), Decimal("1.00"), Decimal("-2.35"), None, None, Decimal("7.00")]


def test_timestamps_both_spellings(spark):
    df = spark.createDataFrame([("2024-01-02T10:00:00",), ("2024-01-02 10:00:00",), ("bad-ts",)], "t string")
    out = CL.add_date_keys(CL.to_timestamps(df, ["t"]), ["t"]).collect()
    assert out[0][0] == out[1][0] == dt.datetime(2024, 1, 2, 10, 0)
    assert out[0][1] == "20240102" and out[2][0] is None and out[2][1] is None


def test_dates(spark):
    df = spark.createDataFrame([("2020-03-15",), ("not-a-date",), (None,)], "d string")
    out = [tuple(r) for r in CL.add_date_keys(CL.to_dates(df, ["d"]), ["d"]).collect()]
    assert out == [(dt.date(2020, 3, 15), "20200315"), (None, None), (None, None)]


# --- X2: JSON fields (golden case from the source samples) ------------------------------

GATEWAY = ('{"gateway_fee": 28.91, "gateway_name": "Auropay", "gateway_status": "success", '
           '"gateway_message": "Payment processed successfully", "gateway_timestamp": "2025-09-25T09:38:45", '
           '"gateway_retry_count": 0, "gateway_transaction_id": "auropay_ec22cae37dde44ea"}')
METADATA = ('{"card_type": null, "is_online": false, "card_brand": null, "ip_address": null, "risk_score": 9, '
            '"user_agent": null, "device_type": null, "card_last_four": null, "payment_channel": "in_store", '
            '"discount_applied": 154.08, "payment_latitude": 19.08727703, "payment_longitude": 72.84226186, '
            '"processing_time_ms": 2626}')


def test_json_golden_case(spark):
    df = spark.createDataFrame([("t1", GATEWAY, METADATA), ("t2", "{not json", None)],
                               "transaction_id string, gateway_response string, transaction_metadata string")
    silver = S.extract_silver_json(df)
    silver = CL.trim_lower(silver, C.TRANSACTION_STRING_COLUMNS)
    gold = extract_gold_json(silver).orderBy("transaction_id").collect()
    g = gold[0].asDict()
    assert g["gateway_fee"] == Decimal("28.91") and g["gateway_name"] == "auropay"
    assert g["gateway_timestamp"] == dt.datetime(2025, 9, 25, 9, 38, 45)
    assert g["gateway_retry_count"] == 0 and g["risk_score"] == 9 and g["processing_time_ms"] == 2626
    assert g["payment_channel"] == "in_store" and g["payment_latitude"] == Decimal("19.08727703")
    assert g["payment_longitude"] == Decimal("72.84226186")
    assert g["is_online_flag"] is False and g["is_mac"] is None
    assert g["card_type"] is None and g["card_brand_name"] is None and g["device_type"] is None
    bad = gold[1].asDict()  # malformed / NULL documents -> NULL fields, row kept
    assert bad["gateway_fee"] is None and bad["is_online_flag"] is False and bad["risk_score"] is None


def test_is_mac(spark):
    df = spark.createDataFrame([("1", '{"user_agent": "Mozilla (Macintosh)"}'), ("2", '{"user_agent": "x mac"}'),
                                ("3", '{"user_agent": null}')], "transaction_id string, transaction_metadata string")
    out = [r["is_mac"] for r in extract_gold_json(df).orderBy("transaction_id").collect()]
    assert out == [True, False, None]


# --- A1 / A2: deterministic de-duplication ----------------------------------------------

def test_dedup_keeps_first_by_total_order(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), (None, 1, "n"), (None, 5, "m")],
                               "k string, v int, p string")
    out = rows(dedup_by(df, ["k"], order_desc(["v", "p"])), ["v"])
    assert out == [("a", 3, "y"), (None, 5, "m")]


def test_dedup_plan_has_partial_limit_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    plan = dedup_by(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


# --- J1-J4, D6: lookups ------------------------------------------------------------------

def test_null_safe_vs_plain_lookup(spark):
    facts = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "b", True)], "id int, x string, y boolean")
    dim = spark.createDataFrame([(10, "a", None), (20, None, None)], "k int, x string, y boolean")
    safe = rows(null_safe_lookup(facts, dim, ["x", "y"], "k", default=-1).select("id", "k"), ["id"])
    assert safe == [(1, 10), (2, 20), (3, -1)]
    plain = rows(plain_lookup(facts, dim, ["x", "y"], "k").select("id", "k"), ["id"])
    assert plain == [(1, None), (2, None), (3, None)]
    plan = null_safe_lookup(facts, dim, ["x", "y"], "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_bounded_broadcast_respects_budget(spark):
    small = spark.range(10)
    assert fits_broadcast(small, 10_000)
    assert not fits_broadcast(spark.range(100_000), 10_000)
    big = spark.range(100_000).withColumnRenamed("id", "k")
    joined = spark.range(10).join(bounded_broadcast(big, 10_000), F.col("id") == F.col("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- D4 / D8: keys -------------------------------------------------------------------------

def test_surrogate_keys_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("v"))
    keyed = assign_surrogate_keys(df, "k", order_by=["v"], start=101, num_partitions=5)
    out = rows(keyed, ["k"])
    assert [k for k, _ in out] == list(range(101, 5101))
    assert [v for _, v in out] == sorted(v for _, v in out)


def test_surrogate_keys_without_order(spark):
    keyed = assign_surrogate_keys(spark.range(0, 1000, 1, 6), "k")
    assert sorted(r[0] for r in keyed.select("k").collect()) == list(range(1, 1001))


def test_junk_dimension_with_unknown_member(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", True), (None, False)], "x string, y boolean")
    dim = build_junk_dimension(df, ["x", "y"], "jk", unknown_member=-1)
    assert rows(dim, ["jk"]) == [(-1, None, None), (1, None, False), (2, "a", None), (3, "b", True)]


# --- J5 / J6: idempotent loads -------------------------------------------------------------

def test_insert_absent_keeps_null_keys_and_batch_duplicates(spark):
    target = spark.createDataFrame([("t1",)], "id string")
    staged = spark.createDataFrame([("t1",), ("t2",), ("t2",), (None,)], "id string")
    assert sorted(rows(insert_absent(staged, target, "id")), key=str) == sorted([("t2",), ("t2",), (None,)], key=str)


def test_incremental_load_can_dedup_the_batch(spark):
    staged = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "id string, v int")
    target = spark.createDataFrame([(7, "b", 3)], "k long, id string, v int")
    kept = lambda **o: sorted(((r.k, r.id, r.v) for r in incremental_load(staged, target, "id", "k", ["v"], **o).collect()))
    assert kept() == [(8, "a", 1), (9, "a", 2), (10, None, 4), (11, None, 5)]
    assert kept(dedup_batch=True) == [(8, "a", 2), (9, None, 4), (10, None, 5)]


# --- D1: calendar ------------------------------------------------------------------------------

def test_calendar_defaults(spark):
    cal = build_dim_date(spark)
    assert cal.count() == 4018
    r = cal.filter("date_key = 20240407").first().asDict()  # a Sunday in April
    assert r["day_of_week"] == 1 and r["day_of_week_name"] == "Sunday" and r["is_weekend"] is True
    assert r["fiscal_year"] == 2025 and r["fiscal_quarter"] == 1 and r["month_name"] == "April"
    r = cal.filter("date_key = 20210101").first().asDict()
    assert r["week_of_year"] == 53 and r["fiscal_year"] == 2021 and r["fiscal_quarter"] == 4
    assert cal.filter("is_holiday").count() == 0


def test_calendar_holidays_and_cover(spark):
    cover = spark.createDataFrame([(dt.datetime(2019, 12, 30, 5),)], "ts timestamp_ntz")
    cal = build_dim_date(spark, cover=cover, cover_col="ts", holidays=["2020-01-01"])
    assert cal.count() == 4020
    assert [r[0] for r in cal.filter("is_holiday").select("date_key").collect()] == [20200101]


# --- T2 / T3 ------------------------------------------------------------------------------------

def test_late_dedup_window(spark):
    T = "id string, ts timestamp_ntz, v int"
    existing = spark.createDataFrame([("a", dt.datetime(2024, 1, 10), 1), ("b", dt.datetime(2024, 1, 1), 1)], T)
    incoming = spark.createDataFrame([("a", dt.datetime(2024, 1, 12), 2),   # within 7 days -> dropped
                                      ("b", dt.datetime(2024, 1, 12), 2),   # 11 days later -> kept
                                      ("c", dt.datetime(2024, 1, 12), 3),   # new, twice -> one row
                                      ("c", dt.datetime(2024, 1, 12), 3)], T)
    out = rows(late_dedup(existing, incoming, ["id"], "ts", "7 days"), ["id"])
    assert [r[0] for r in out] == ["b", "c"]


def test_row_hash_anti_null_is_not_empty(spark):
    T = "a string, b string"
    existing = spark.createDataFrame([("x", None)], T)
    incoming = spark.createDataFrame([("x", None), ("x", "")], T)
    assert rows(row_hash_anti(incoming, existing, ["a", "b"])) == [("x", "")]
    stored = with_row_hash(existing, ["a", "b"], "h")
    assert rows(row_hash_anti(incoming, stored, ["a", "b"], stored_hash="h")) == [("x", "")]


# --- C1-C4 ---------------------------------------------------------------------------------------

def test_contract_report(spark):
    df = spark.createDataFrame([(1, "a" * 201, Decimal("1000.00")), (1, None, Decimal("5.00"))],
                               "k int, name string, rate decimal(10,2)")
    rep = {(r["check_name"], r["column_name"]): r["violations"] for r in contract_report(
        df, "t", not_null=["name"], widths={"name": 200}, narrowing={"rate": C.MERCHANT_STAGE_TYPES["commission_rate"]},
        primary_key="k").collect()}
    assert rep == {("not_null", "name"): 1, ("varchar_width", "name"): 1,
                   ("numeric_narrowing", "rate"): 1, ("primary_key", "k"): 2}


# --- S1 / S11 -------------------------------------------------------------------------------------

def test_csv_round_trip_keeps_blanks_and_json(spark, tmp_path):
    df = spark.createDataFrame([("1", "  ", '{"a": "x, \\"y\\""}'), ("2", None, "")], "id string, name string, j string")
    IO.write_raw_csv(df, str(tmp_path / "nested" / "part"))
    back = IO.read_raw_csv(spark, str(tmp_path), spark.createDataFrame([], "id string, name string, j string").schema)
    # an empty field reads back as NULL; both are null tokens, so cleaning is unaffected
    assert rows(back, ["id"]) == [("1", "  ", '{"a": "x, \\"y\\""}'), ("2", None, None)]


def test_empty_source_is_skipped(spark):
    calls = []
    empty = spark.createDataFrame([], C.RAW_MERCHANT_SCHEMA)
    assert IO.run_if_nonempty(empty, lambda d: calls.append(1), "merchants") is None
    assert calls == []
    assert S.silver_merchants(empty).count() == 0


# --- hot keys: a merchant with a third of the facts, dimension over the broadcast budget ----

def test_hot_merchant_is_split_when_dimension_is_not_broadcast(spark):
    from goldleaf.operators.joins import lookup_key
    conf = {"goldleaf.broadcast.maxBytes": "1024", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(300_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("merchant_id"), "id")
        dim = spark.range(5000).select(F.col("id").alias("merchant_id"), (F.col("id") + 100).alias("merchant_key"))
        agg = lookup_key(fact, dim, "merchant_id", "merchant_key").agg(F.count("*").alias("n"))
        assert agg.collect()[0]["n"] == 300_000  # every row kept, none capped or sampled
        plan = agg._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_extend_junk_dimension_keeps_keys(spark):
    from goldleaf.operators.keys import extend_junk_dimension
    dim = spark.createDataFrame([(1, None, False), (2, "a", None)], "jk int, x string, y boolean")
    src = spark.createDataFrame([("a", None), (None, False), ("b", True), (None, None)], "x string, y boolean")
    out = rows(extend_junk_dimension(dim, src, ["x", "y"], "jk"), ["jk"])
    assert out == [(1, None, False), (2, "a", None), (3, None, None), (4, "b", True)]


# --- empty inputs -------------------------------------------------------------------------

def test_empty_inputs(spark):
    from goldleaf.streaming.late import partition_scoped_merge
    from goldleaf.session import scratch_path
    empty = spark.createDataFrame([], "id string, ts timestamp_ntz, v int")
    assert assign_surrogate_keys(empty, "k", order_by=["id"]).count() == 0
    assert assign_surrogate_keys(empty, "k").columns == ["k", "id", "ts", "v"]
    some = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1)], "id string, ts timestamp_ntz, v int")
    assert late_dedup(some, empty, ["id"], "ts").count() == 0
    assert late_dedup(empty, some, ["id"], "ts").count() == 1
    assert insert_absent(empty, some, "id").count() == 0
    path = scratch_path(spark, "t-empty")
    IO.write_partitioned(some.withColumn("year", F.lit("2024")), path, ["year"])
    assert partition_scoped_merge(spark, path, empty.withColumn("year", F.lit("2024")), ["year"], ["id"]) == []
    assert contract_report(empty, "t").count() == 0
    assert contract_report(empty, "t", not_null=["id"], primary_key="id").collect()[0]["violations"] == 0
