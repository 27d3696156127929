"""Contract checks implied by the warehouse DDL, as data-quality reports.

All column checks of one table run in a single aggregation pass
(``count_if`` per check); the primary-key check is one ``groupBy`` on the key.
The report has one row per (table, check, column) with the number of
violating rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT_SCHEMA = "table_name string, check_name string, column_name string, violations bigint"


BREACHES = "breaches"


def contract_checks(df: DataFrame, not_null: Sequence[str] = (), widths: dict[str, int] | None = None,
                    narrowing: dict[str, T.DataType] | None = None) -> list[tuple[str, str, Column]]:
    """(check, column, violation predicate) for the columns that ``df`` has."""
    checks = [("not_null", c, F.col(c).isNull()) for c in not_null if c in df.columns]
    checks += [("varchar_width", c, F.length(c) > n) for c, n in (widths or {}).items() if c in df.columns]
    checks += [("numeric_narrowing", c, F.col(c).isNotNull() & F.col(c).try_cast(t).isNull())
               for c, t in (narrowing or {}).items() if c in df.columns]
    return checks


def with_breaches(df: DataFrame, **contract) -> DataFrame:
    """``df`` with ``breaches``: the checks (``check:column``) that each row violates, none: an empty array.

    A column that ``df`` has already is added to, so checks of several stages meet in one.
    """
    named = [F.when(p, F.lit(f"{check}:{col}")) for check, col, p in contract_checks(df, **contract)]
    found = F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
    return df.withColumn(BREACHES, F.concat(BREACHES, found) if BREACHES in df.columns else found)


def split_breaches(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that hold the contract (without ``breaches``), and those set aside with their reasons."""
    sound = F.size(BREACHES) == 0
    return checked.filter(sound).drop(BREACHES), checked.filter(~sound)


def breach_report(checked: DataFrame, table: str, checks: Sequence[str]) -> DataFrame:
    """The rows of a contract_report for the named checks (``check:column``), counted from ``breaches``.

    Reads that one column, so a stored table is not checked a second time.
    """
    counts = checked.agg(*[F.count_if(F.array_contains(BREACHES, c)).alias(f"v{i}") for i, c in enumerate(checks)])
    if not checks:
        return checked.sparkSession.createDataFrame([], REPORT_SCHEMA)
    rows = F.array(*[F.struct(F.lit(table).alias("table_name"), F.lit(c.partition(":")[0]).alias("check_name"),
                              F.lit(c.partition(":")[2]).alias("column_name"), F.col(f"v{i}").cast("bigint").alias("violations"))
                     for i, c in enumerate(checks)])
    return counts.select(F.inline(rows))


def key_report(table: DataFrame, name: str, key: str, low=None, high=None) -> DataFrame:
    """Rows of ``table`` that share ``key``, among keys from ``low`` to ``high`` (those a load has added).

    Older keys were checked by the loads that added them: the bounds reach the scan, whose
    statistics skip the files of other keys.
    """
    if low is not None:
        table = table.filter(F.col(key) >= F.lit(low))
    if high is not None:
        table = table.filter(F.col(key) <= F.lit(high))
    return contract_report(table.select(key), name, primary_key=key)


def contract_report(df: DataFrame, table: str, not_null: Sequence[str] = (),
                    widths: dict[str, int] | None = None,
                    narrowing: dict[str, T.DataType] | None = None,
                    primary_key: str | None = None) -> DataFrame:
    checks = contract_checks(df, not_null, widths, narrowing)
    parts = []
    if checks:
        counts = df.agg(*[F.count_if(p).alias(f"v{i}") for i, (_, _, p) in enumerate(checks)])
        rows = F.array(*[F.struct(F.lit(table).alias("table_name"), F.lit(chk).alias("check_name"),
                                  F.lit(col).alias("column_name"), F.col(f"v{i}").cast("bigint").alias("violations"))
                         for i, (chk, col, _) in enumerate(checks)])
        parts.append(counts.select(F.inline(rows)))
    if primary_key is not None:
        dup = (df.groupBy(primary_key).count().filter(F.col("count") > 1)
               .agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("violations")))
        parts.append(dup.select(F.lit(table).alias("table_name"), F.lit("primary_key").alias("check_name"),
                                F.lit(primary_key).alias("column_name"), "violations"))
    if not parts:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def scd2_violations(dim: DataFrame, key: str = "merchant_id") -> DataFrame:
    """Per natural key: more than one active row, or overlapping validity intervals."""
    from pyspark.sql import Window
    w = Window.partitionBy(key).orderBy("valid_from", "valid_to")
    prev_to = F.lag("valid_to").over(w)
    flagged = dim.withColumn("__overlap", (prev_to.isNotNull() & (prev_to >= F.col("valid_from"))).cast("int"))
    return (flagged.groupBy(key)
            .agg(F.count_if(F.col("is_active")).alias("active_rows"), F.sum("__overlap").alias("overlaps"))
            .filter((F.col("active_rows") > 1) | (F.col("overlaps") > 0)))
