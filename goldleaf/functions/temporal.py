"""Dates, timestamps, date keys and the fiscal calendar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_date(col) -> Column:
    """``to_date`` of text; unparseable text gives NULL."""
    return _c(col).try_cast(T.DateType())


_ZONED = r"[0-9]:[0-9]{2}.*(Z|UTC|GMT|[+-][0-9]{1,2}(:?[0-9]{2})?)\s*$"


def parse_timestamp(col) -> Column:
    """Text to a zone-less timestamp (``T`` or blank separator); bad text gives NULL.

    A text with a zone or an offset gives its instant in UTC, the session zone.
    """
    c = _c(col)
    zoned = c.try_cast(T.TimestampType()).cast(T.TimestampNTZType())
    return F.when(c.rlike(_ZONED), zoned).otherwise(c.try_cast(T.TimestampNTZType()))


def date_key(col) -> Column:
    """``yyyyMMdd`` text key of a date or timestamp; NULL stays NULL."""
    return F.date_format(_c(col), "yyyyMMdd")


def date_key_int(col) -> Column:
    return date_key(col).cast(T.IntegerType())


def fiscal_year(col, start_month: int = 4) -> Column:
    """Fiscal year labelled by the calendar year in which it ends."""
    d = _c(col)
    if start_month == 1:
        return F.year(d)
    return F.when(F.month(d) >= start_month, F.year(d) + 1).otherwise(F.year(d))


def fiscal_quarter(col, start_month: int = 4) -> Column:
    """Quarter 1..4 counted from ``start_month``."""
    return F.quarter(F.add_months(_c(col), 1 - start_month))
