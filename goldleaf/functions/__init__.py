"""Column-level building blocks (pure ``Column -> Column`` functions).

All of them are built-in Spark SQL expressions, none a Python UDF.  Column functions stay
inside whole-stage code generation; ``json_tuple`` runs as a generator between two stages.
"""

from goldleaf.functions.text import null_if_token, normalise, row_hash
from goldleaf.functions.temporal import (date_key, date_key_int, parse_date, parse_timestamp,
                                         fiscal_year, fiscal_quarter)
from goldleaf.functions.casts import try_decimal, try_int, try_bool, try_long, try_to
from goldleaf.functions.json import with_json_fields

__all__ = [
    "null_if_token", "normalise", "row_hash",
    "date_key", "date_key_int", "parse_date", "parse_timestamp", "fiscal_year", "fiscal_quarter",
    "try_decimal", "try_int", "try_bool", "try_long", "try_to",
    "with_json_fields",
]
