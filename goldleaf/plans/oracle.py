"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL is written against the pre-registered test tables; the raw extracts
come from the same adapter expressions as the Spark side
(``goldleaf.sources.fixtures``).  DuckDB differs from Spark in a few places,
handled here explicitly: text -> int accepts only integer text (Spark's
``try_cast('9.7' as int)`` is NULL), ``dayofweek`` counts from 0, date parts
are BIGINT, ``date - interval`` is a TIMESTAMP, text -> date needs a date
prefix.
"""

from __future__ import annotations

from goldleaf import contracts as C
from goldleaf.sources.fixtures import RAW_MERCHANTS_SQL, RAW_TRANSACTIONS_SQL, MERCHANT_BATCH_TIMESTAMPS

TOKENS = ", ".join("'" + t.replace("'", "''") + "'" for t in C.NULL_TOKENS)

SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def with_(ctes: list[tuple[str, str]], final: str) -> str:
    seen, parts = set(), []
    for name, body in ctes:
        if name in seen:
            continue
        seen.add(name)
        parts.append(f"{name} AS (\n{body}\n)")
    return "WITH " + ",\n".join(parts) + "\n" + final


def duck_type(t) -> str:
    s = t.simpleString()
    if s.startswith("decimal"):
        return s.upper()
    return SPARK_TO_DUCK[s]


def try_int(x: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') THEN try_cast(trim({x}) AS INTEGER) END"


def try_bigint(x: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') THEN try_cast(trim({x}) AS BIGINT) END"


def try_date(x: str) -> str:
    # Spark reads a leading yyyy-MM-dd (optionally followed by a time); DuckDB needs the date alone
    return (f"CASE WHEN regexp_matches({x}, '^\\s*[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}([ T].*)?\\s*$') "
            f"THEN try_cast(regexp_extract({x}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') AS DATE) END")


def try_cast(x: str, spark_type) -> str:
    s = spark_type.simpleString()
    if s == "int":
        return try_int(x)
    if s == "bigint":
        return try_bigint(x)
    if s == "date":
        return try_date(x)
    return f"try_cast({x} AS {duck_type(spark_type)})"


def json_get(doc: str, field: str) -> str:
    return f"CASE WHEN json_valid({doc}) THEN json_extract_string({doc}, '$.{field}') END"


def date_key(x: str) -> str:
    return f"strftime({x}, '%Y%m%d')"


def desc_all(cols) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


# ---------------------------------------------------------------------------
# bronze
# ---------------------------------------------------------------------------

RAW_M = ("raw_m", RAW_MERCHANTS_SQL)
RAW_T = ("raw_t", RAW_TRANSACTIONS_SQL)
RAW_M_COLS = C.CDC_COLUMNS + C.MERCHANT_SOURCE_COLUMNS
RAW_T_COLS = C.TRANSACTION_SOURCE_COLUMNS


def nulls_cleaned(src: str, cols) -> str:
    sel = ", ".join(f"CASE WHEN {c} IN ({TOKENS}) THEN NULL ELSE {c} END AS {c}" for c in cols)
    return f"SELECT {sel} FROM {src}"


def merchant_batch_filter(v: int | None) -> str:
    return "" if v is None else f" WHERE cdc_timestamp = '{MERCHANT_BATCH_TIMESTAMPS[v]}'"


# ---------------------------------------------------------------------------
# silver merchants
# ---------------------------------------------------------------------------

def merchant_ctes(v: int | None = None, suffix: str = "") -> list[tuple[str, str]]:
    """CTEs ending in ``silver_m{suffix}`` for batch ``v`` (None = both batches)."""
    s = suffix
    order = desc_all(["cdc_timestamp", "updated_at"] + RAW_M_COLS)
    string_cols = [c for c in C.MERCHANT_STRING_COLUMNS if c in RAW_M_COLS]
    date_cols = [c for c in C.MERCHANT_DATE_COLUMNS if c in RAW_M_COLS]
    sel = []
    for c in RAW_M_COLS:
        if c in string_cols:
            sel.append(f"lower(trim({c})) AS {c}")
        elif c in date_cols:
            sel.append(f"{try_date(c)} AS {c}")
        elif c in C.MERCHANT_DECIMAL_COLUMNS:
            sel.append(f"try_cast({c} AS DECIMAL(10,2)) AS {c}")
        else:
            sel.append(c)
    sel += [f"{date_key(try_date(c))} AS {c}_date_key" for c in date_cols]
    return [
        RAW_M,
        (f"m_src{s}", f"SELECT * FROM raw_m{merchant_batch_filter(v)}"),
        (f"m_f1{s}", nulls_cleaned(f"m_src{s}", RAW_M_COLS)),
        (f"m_a1{s}", f"SELECT * FROM m_f1{s} QUALIFY row_number() OVER "
                     f"(PARTITION BY merchant_id ORDER BY {order}) = 1"),
        (f"m_f2{s}", f"SELECT * FROM m_a1{s} WHERE merchant_id IS NOT NULL AND tax_id IS NOT NULL"),
        (f"m_x{s}", f"SELECT {', '.join(sel)} FROM m_f2{s}"),
        (f"silver_m{s}", f"SELECT * FROM m_x{s} WHERE commission_rate >= 0 AND monthly_fee >= 0"),
    ]


# ---------------------------------------------------------------------------
# silver transactions
# ---------------------------------------------------------------------------

def _json_select(fields) -> list[str]:
    out = []
    for name, src, field, t in fields:
        out.append(f"{try_cast(json_get(src, field), t) if t.simpleString() != 'string' else json_get(src, field)} AS {name}")
    return out


def transaction_ctes(src: str = "raw_t", suffix: str = "", merchants: str | None = "silver_m") -> list[tuple[str, str]]:
    """CTEs ending in ``silver_t{suffix}``; ``clean_t{suffix}`` is the stage before the semi join."""
    s = suffix
    order = desc_all(RAW_T_COLS)
    json_names = [n for n, *_ in C.SILVER_JSON_FIELDS]
    money = C.TRANSACTION_MONEY_COLUMNS
    norm = C.TRANSACTION_STRING_COLUMNS
    base = []
    for c in RAW_T_COLS:
        if c in C.TRANSACTION_TIMESTAMP_COLUMNS:
            base.append(f"try_cast({c} AS TIMESTAMP) AS {c}")
        else:
            base.append(c)
    typed = []
    for c in RAW_T_COLS + json_names:
        if c in norm:
            typed.append(f"lower(trim({c})) AS {c}")
        elif c in money:
            typed.append(f"try_cast({c} AS DECIMAL(12,2)) AS {c}")
        else:
            typed.append(c)
    typed += [f"{date_key(c)} AS {c}_date_key" for c in C.TRANSACTION_TIMESTAMP_COLUMNS]
    nonneg = " AND ".join(f"{c} >= 0" for c in money)
    ctes = [
        RAW_T,
        (f"t_f1{s}", nulls_cleaned(src, RAW_T_COLS)),
        (f"t_a2{s}", f"SELECT * FROM t_f1{s} QUALIFY row_number() OVER "
                     f"(PARTITION BY transaction_id, transaction_timestamp ORDER BY {order}) = 1"),
        (f"t_j{s}", f"SELECT {', '.join(base + _json_select(C.SILVER_JSON_FIELDS))} FROM t_a2{s}"),
        (f"t_req{s}", f"SELECT * FROM t_j{s} WHERE transaction_id IS NOT NULL AND merchant_id IS NOT NULL "
                      f"AND transaction_timestamp IS NOT NULL"),
        (f"t_typed{s}", f"SELECT {', '.join(typed)} FROM t_req{s}"),
        (f"clean_t{s}", f"SELECT * FROM t_typed{s} WHERE {nonneg}"),
    ]
    if merchants is not None:
        ctes.append((f"silver_t{s}",
                     f"SELECT *, strftime(transaction_timestamp, '%Y') AS year, "
                     f"strftime(transaction_timestamp, '%m') AS month FROM clean_t{s} "
                     f"WHERE merchant_id IN (SELECT merchant_id FROM {merchants})"))
    return ctes


def silver_merchants_sql() -> str:
    return with_(merchant_ctes(), "SELECT * FROM silver_m")


def silver_transactions_sql() -> str:
    return with_(merchant_ctes() + transaction_ctes(), "SELECT * FROM silver_t")


# ---------------------------------------------------------------------------
# gold: calendar
# ---------------------------------------------------------------------------

def calendar_sql(days: str) -> str:
    """Calendar attributes for a CTE ``days(full_date)``."""
    d = "full_date"
    return (f"SELECT CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS date_key, {d}, "
            f"CAST(dayofweek({d}) + 1 AS INTEGER) AS day_of_week, dayname({d}) AS day_of_week_name, "
            f"CAST(dayofmonth({d}) AS INTEGER) AS day_of_month, CAST(dayofyear({d}) AS INTEGER) AS day_of_year, "
            f"CAST(weekofyear({d}) AS INTEGER) AS week_of_year, CAST(month({d}) AS INTEGER) AS month_number, "
            f"monthname({d}) AS month_name, CAST(quarter({d}) AS INTEGER) AS quarter, "
            f"CAST(year({d}) AS INTEGER) AS year, dayofweek({d}) IN (0, 6) AS is_weekend, "
            f"false AS is_holiday, "
            f"CAST(CASE WHEN month({d}) >= {C.FISCAL_START_MONTH} THEN year({d}) + 1 ELSE year({d}) END AS INTEGER) AS fiscal_year, "
            f"CAST(CASE WHEN month({d}) BETWEEN 4 AND 6 THEN 1 WHEN month({d}) BETWEEN 7 AND 9 THEN 2 "
            f"WHEN month({d}) BETWEEN 10 AND 12 THEN 3 ELSE 4 END AS INTEGER) AS fiscal_quarter FROM {days}")


def calendar_days_sql(cover: str | None, ts_col: str = "transaction_timestamp",
                      start: str = C.CALENDAR_START, end: str = C.CALENDAR_END) -> str:
    if cover is None:
        bounds = f"SELECT DATE '{start}' AS lo, DATE '{end}' AS hi"
    else:
        bounds = (f"SELECT coalesce(least(min(CAST({ts_col} AS DATE)), DATE '{start}'), DATE '{start}') AS lo, "
                  f"coalesce(greatest(max(CAST({ts_col} AS DATE)), DATE '{end}'), DATE '{end}') AS hi FROM {cover}")
    return (f"SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), "
            f"INTERVAL 1 DAY)) AS DATE) AS full_date FROM ({bounds})")


# ---------------------------------------------------------------------------
# gold: merchant staging (D9) and SCD2
# ---------------------------------------------------------------------------

_STAGE_SOURCE = {"cdc_op": "op", "business_category_code": "business_category",
                 "merchant_tier_code": "merchant_tier", "onboarding_status_code": "onboarding_status",
                 "onboarding_date": "onboarding_date_date_key",
                 "contract_start_date": "contract_start_date_date_key",
                 "contract_end_date": "contract_end_date_date_key"}


def merchant_stage_ctes(v: int | None, suffix: str) -> list[tuple[str, str]]:
    sel = []
    for c in C.MERCHANT_STAGE_COLUMNS:
        t = C.MERCHANT_STAGE_TYPES[c]
        src = _STAGE_SOURCE.get(c, c)
        if c == "valid_from":
            sel.append(f"{try_date('cdc_timestamp')} AS valid_from")
        elif c == "valid_to":
            sel.append(f"DATE '{C.OPEN_END_DATE}' AS valid_to")
        elif c == "is_active":
            sel.append("true AS is_active")
        elif t.simpleString() == "string":
            sel.append(f"{src} AS {c}")
        else:
            sel.append(f"{try_cast(src, t)} AS {c}")
    return merchant_ctes(v, suffix) + [(f"stage_m{suffix}", f"SELECT {', '.join(sel)} FROM silver_m{suffix}")]


DIM_COLS = ["merchant_key"] + [c for c in C.MERCHANT_STAGE_COLUMNS if c not in ("cdc_op", "cdc_timestamp")]
VERSION_ORDER = "merchant_id NULLS FIRST, valid_from NULLS FIRST, cdc_timestamp NULLS FIRST, updated_at NULLS FIRST"


def _dim_select(src: str, key_expr: str) -> str:
    rest = ", ".join(c for c in DIM_COLS if c != "merchant_key")
    return f"SELECT CAST({key_expr} AS BIGINT) AS merchant_key, {rest} FROM {src}"


def _new_versions_sql(stage: str, mode: str) -> str:
    rows = f"SELECT * FROM {stage} WHERE cdc_op IN ('I', 'U')"
    if mode == "compat":
        return rows
    order = desc_all(["cdc_timestamp", "updated_at"] + C.MERCHANT_STAGE_COLUMNS)
    day_last = (f"SELECT * FROM ({rows}) QUALIFY row_number() OVER "
                f"(PARTITION BY merchant_id, valid_from ORDER BY {order}) = 1")
    nxt = "lead(valid_from) OVER (PARTITION BY merchant_id ORDER BY valid_from)"
    return (f"SELECT * REPLACE (coalesce(CAST(nxt - INTERVAL 1 DAY AS DATE), valid_to) AS valid_to, "
            f"nxt IS NULL AS is_active) FROM (SELECT *, {nxt} AS nxt FROM ({day_last}))")


def scd2_ctes(mode: str = "compat") -> list[tuple[str, str]]:
    """dim0 (initial load of batch 0), expired_{mode}, inserted_{mode}, dim1_{mode}."""
    m = mode
    ops = "('U')" if mode == "compat" else "('I', 'U')"
    close = "CAST(c.chg_from - INTERVAL 1 DAY AS DATE)"
    hit = "d.is_active AND c.merchant_id IS NOT NULL"
    expired_cols = []
    for col in DIM_COLS:
        if col == "valid_to":
            expired_cols.append(f"CASE WHEN {hit} THEN {close} ELSE d.valid_to END AS valid_to")
        elif col == "updated_at":
            expired_cols.append(f"CASE WHEN {hit} THEN c.chg_updated ELSE d.updated_at END AS updated_at")
        elif col == "is_active":
            expired_cols.append(f"CASE WHEN {hit} THEN false ELSE d.is_active END AS is_active")
        else:
            expired_cols.append(f"d.{col}")
    init_rows = _new_versions_sql("stage_m_b0", m)
    return (merchant_stage_ctes(0, "_b0") + merchant_stage_ctes(1, "_b1") + [
        (f"dim0_{m}", _dim_select(f"({init_rows})", f"row_number() OVER (ORDER BY {VERSION_ORDER})")),
        (f"chg_{m}", f"SELECT merchant_id, valid_from AS chg_from, updated_at AS chg_updated FROM stage_m_b1 "
                     f"WHERE cdc_op IN {ops} QUALIFY row_number() OVER (PARTITION BY merchant_id "
                     f"ORDER BY valid_from NULLS FIRST, updated_at NULLS FIRST) = 1"),
        (f"expired_{m}", f"SELECT {', '.join(expired_cols)} FROM dim0_{m} d LEFT JOIN chg_{m} c USING (merchant_id)"),
        (f"inserted_{m}", _dim_select(f"({_new_versions_sql('stage_m_b1', m)})",
                                      f"(SELECT coalesce(max(merchant_key), 0) FROM dim0_{m}) + "
                                      f"row_number() OVER (ORDER BY {VERSION_ORDER})")),
        (f"dim1_{m}", f"SELECT * FROM expired_{m} UNION ALL SELECT * FROM inserted_{m}"),
    ])


# ---------------------------------------------------------------------------
# gold: fact derivation (D5), junk dimensions (D8), lookups
# ---------------------------------------------------------------------------

GOLD_JSON_SQL = {
    "gateway_retry_count": try_int(json_get("gateway_response", "gateway_retry_count")),
    "gateway_timestamp": f"try_cast({json_get('gateway_response', 'gateway_timestamp')} AS TIMESTAMP)",
    "ip_address": json_get("transaction_metadata", "ip_address"),
    "card_type": f"lower(trim({json_get('transaction_metadata', 'card_type')}))",
    "card_brand_name": f"lower(trim({json_get('transaction_metadata', 'card_brand')}))",
    "user_agent": json_get("transaction_metadata", "user_agent"),
    "is_online_flag": f"coalesce(try_cast({json_get('transaction_metadata', 'is_online')} AS BOOLEAN), false)",
}
IS_MAC_SQL = "CASE WHEN user_agent IS NULL THEN NULL ELSE regexp_matches(user_agent, 'Mac') END"

_SILVER_T_OUT = RAW_T_COLS + [n for n, *_ in C.SILVER_JSON_FIELDS] + \
    [f"{c}_date_key" for c in C.TRANSACTION_TIMESTAMP_COLUMNS] + ["year", "month"]
_DERIVED_CAST = {
    "merchant_id": try_bigint("merchant_id"), "customer_id": try_bigint("customer_id"),
    "payment_method": try_int("payment_method"), "transaction_status": try_int("transaction_status"),
    "currency": try_int("currency"), "emi_enabled": "try_cast(emi_enabled AS BOOLEAN)",
    "year": try_int("year"), "month": try_int("month"),
}


def derived_ctes(src: str = "silver_t", suffix: str = "") -> list[tuple[str, str]]:
    s = suffix
    first = ", ".join([c for c in _SILVER_T_OUT if c not in _DERIVED_CAST] +
                      [f"{v} AS {k}" for k, v in _DERIVED_CAST.items()] +
                      [f"{v} AS {k}" for k, v in GOLD_JSON_SQL.items()])
    second = ("SELECT *, " + IS_MAC_SQL + " AS is_mac, discount_amount > 0 AS discount_applied, "
              "CASE WHEN gateway_timestamp IS NOT NULL THEN CAST(strftime(gateway_timestamp, '%Y%m%d') AS INTEGER) "
              "END AS gateway_date_key, "
              f"{try_int('transaction_timestamp_date_key')} AS transaction_date_key, "
              f"{try_int('processed_timestamp_date_key')} AS processed_date_key FROM dj{s}")
    renames = ", ".join(f"{k} AS {v}" for k, v in C.FACT_RENAMES.items())
    return [(f"dj{s}", f"SELECT {first} FROM {src}"),
            (f"dd{s}", second),
            (f"derived{s}", f"SELECT * EXCLUDE ({', '.join(C.FACT_RENAMES)}), {renames} FROM dd{s}")]


def junk_sql(attrs, key: str, src: str) -> str:
    order = ", ".join(f"{a} ASC NULLS FIRST" for a in attrs)
    cols = ", ".join(attrs)
    return (f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS {key}, {cols} FROM "
            f"(SELECT DISTINCT {cols} FROM {src})")


def null_safe(attrs, left: str, right: str) -> str:
    return " AND ".join(f"{left}.{a} IS NOT DISTINCT FROM {right}.{a}" for a in attrs)


def fact_ctes(mode: str = "compat") -> list[tuple[str, str]]:
    m = mode
    fact_sel = []
    for c in C.FACT_COLUMNS:
        t = C.FACT_TYPES[c]
        if c in ("emi_tenure_months",):
            fact_sel.append(f"{try_int(c)} AS {c}")
        elif c in ("emi_interest_rate", "gateway_fee"):
            fact_sel.append(f"try_cast({c} AS {duck_type(t)}) AS {c}")
        elif c == "created_at":
            fact_sel.append(f"try_cast({c} AS TIMESTAMP) AS {c}")
        else:
            fact_sel.append(c)
    pj, cj = C.PAYMENT_JUNK_ATTRS, C.CARD_JUNK_ATTRS
    return (merchant_ctes() + transaction_ctes() + derived_ctes() + scd2_ctes(mode) + [
        ("junk_p", junk_sql(pj, C.PAYMENT_JUNK_KEY, "derived")),
        ("junk_c", junk_sql(cj, C.CARD_JUNK_KEY, "derived")),
        (f"fm_{m}", f"SELECT d.*, a.merchant_key FROM derived d JOIN (SELECT merchant_id, merchant_key "
                    f"FROM dim1_{m} WHERE is_active) a USING (merchant_id)"),
        (f"fp_{m}", f"SELECT f.*, coalesce(j.{C.PAYMENT_JUNK_KEY}, -1) AS {C.PAYMENT_JUNK_KEY} FROM fm_{m} f "
                    f"LEFT JOIN junk_p j ON {null_safe(pj, 'f', 'j')}"),
        (f"fc_{m}", f"SELECT f.*, coalesce(j.{C.CARD_JUNK_KEY}, -1) AS {C.CARD_JUNK_KEY} FROM fp_{m} f "
                    f"LEFT JOIN junk_c j ON {null_safe(cj, 'f', 'j')}"),
        (f"fact_{m}", f"SELECT {', '.join(fact_sel)} FROM fc_{m}"),
    ])


_FACT_LAYOUT = ["year", "month", "transaction_date_key", "merchant_key"]
FACT_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in _FACT_LAYOUT + [c for c in C.FACT_COLUMNS
                                                                        if c not in _FACT_LAYOUT])


def keyed(src: str, key: str, order: str, base: str = "0") -> str:
    return f"SELECT CAST(({base}) + row_number() OVER (ORDER BY {order}) AS BIGINT) AS {key}, * FROM {src}"


# ---------------------------------------------------------------------------
# contract checks
# ---------------------------------------------------------------------------

def contract_sql(src: str, table: str, not_null=(), widths=None, narrowing=None, pk=None) -> str:
    def row(check, col, expr):
        return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{col}' AS column_name, "
                f"CAST({expr} AS BIGINT) AS violations FROM {src}")
    parts = [row("not_null", c, f"count_if({c} IS NULL)") for c in not_null]
    parts += [row("varchar_width", c, f"count_if(length({c}) > {n})") for c, n in (widths or {}).items()]
    parts += [row("numeric_narrowing", c, f"count_if({c} IS NOT NULL AND try_cast({c} AS {duck_type(t)}) IS NULL)")
              for c, t in (narrowing or {}).items()]
    if pk:
        parts.append(f"SELECT '{table}' AS table_name, 'primary_key' AS check_name, '{pk}' AS column_name, "
                     f"CAST(coalesce(sum(n), 0) AS BIGINT) AS violations FROM "
                     f"(SELECT count(*) AS n FROM {src} GROUP BY {pk} HAVING count(*) > 1)")
    return "\nUNION ALL\n".join(parts)


def row_hash_sql(cols) -> str:
    parts = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in cols)
    return f"sha256({parts})"
