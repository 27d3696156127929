"""String helpers: null tokens, normalisation, row hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldleaf.contracts import NULL_TOKENS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def null_if_token(col, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """NULL when the value equals one of ``tokens`` exactly (case as listed, no trimming)."""
    c = _c(col)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def normalise(col) -> Column:
    """``lower(trim(x))``: trims blanks only; a blank-only value becomes ``''``."""
    return F.lower(F.trim(_c(col)))


# Marker of a NULL in the canonical row text that is hashed; values begin with their length.
ROW_HASH_NULL = "-"


def row_hash(cols: Sequence[str]) -> Column:
    """SHA-256 (hex) of ``cols``, each as UTF-8 byte count, ``:`` and text (NULL: ``-``).

    The counts keep neighbouring values apart whatever characters they hold.
    """
    texts = [F.col(c).cast("string") for c in cols]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit(ROW_HASH_NULL)) for t in texts]
    return F.sha2(F.concat(*parts), 256)
