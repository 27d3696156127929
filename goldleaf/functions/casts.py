"""Lenient casts: bad text becomes NULL instead of failing the job (ANSI mode stays on)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def try_to(col, data_type) -> Column:
    return _c(col).try_cast(data_type)


def try_decimal(col, precision: int, scale: int) -> Column:
    """Decimal with HALF_UP rounding to ``scale``; overflow and bad text give NULL."""
    return _c(col).try_cast(T.DecimalType(precision, scale))


def try_int(col) -> Column:
    return _c(col).try_cast(T.IntegerType())


def try_long(col) -> Column:
    return _c(col).try_cast(T.LongType())


def try_bool(col) -> Column:
    return _c(col).try_cast(T.BooleanType())
