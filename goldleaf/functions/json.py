"""Pull flat ``$.field`` values out of JSON text, parsing each document once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.functions.temporal import parse_timestamp


def with_json_fields(df: DataFrame, json_col: str,
                     fields: Sequence[tuple[str, str, T.DataType]]) -> DataFrame:
    """Add typed columns ``name`` = value of ``$.field`` in ``json_col``.

    ``json_tuple`` parses the document once for all fields (a generator, so
    the optimizer cannot split it into one parse per field or copy the parse
    into pushed-down filters).  A scalar keeps its JSON text (numbers and
    booleans included, like ``get_json_object``); JSON ``null``, a missing
    field, a NULL document and malformed text all give NULL; the text is then
    cast leniently to the wanted type.  Existing columns of the same name are
    replaced in place.
    """
    wanted = list(dict.fromkeys(field for _, field, _ in fields))
    tmp = {f: f"__json_{json_col}_{i}" for i, f in enumerate(wanted)}
    exploded = df.select("*", F.json_tuple(F.col(json_col), *wanted).alias(*tmp.values()))
    typed = {}
    for name, field, data_type in fields:
        text = F.col(tmp[field])
        if isinstance(data_type, T.TimestampNTZType):
            typed[name] = parse_timestamp(text)  # an offset is applied, not dropped
        else:
            typed[name] = text if isinstance(data_type, T.StringType) else text.try_cast(data_type)
    return exploded.withColumns(typed).drop(*tmp.values())
