"""Numbered rows and sets of them, so that a choice among wide rows is made on narrow ones.

``numbered`` keeps rows aside with a number each.  What decides over them (which copy stays,
which row was sent before) is worked out on their keys and numbers alone; ``with_marked`` then
takes the chosen rows from where they lie.  Chosen numbers travel as bitmaps, one bit for each
row; beyond the broadcast budget (about 500 M rows) they are joined by number instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.operators.joins import fits_broadcast, semi_join_known
from goldleaf.sources.files import store

#: The row's number: unique, without meaning, fixed because the rows are stored with it.
AT = "__goldleaf_at"
#: Bits of the bitmaps that bitmap_construct_agg makes.
_BLOCK_BITS = 32768
_BLOCK, _BITS = "__goldleaf_block", "__goldleaf_bits"


def numbered(df: DataFrame, name: str = "numbered") -> DataFrame:
    """``df`` stored with a number for each row in its last column; rows that have one are left as they are."""
    return df if AT in df.columns else store(df.withColumn(AT, F.monotonically_increasing_id()), name)


def semi_join_numbered(df: DataFrame, rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """``semi_join_known`` for wide ``df`` worked out from the numbered ``rows``, whose ``key`` it has unchanged.

    Where the known values exceed a broadcast only keys and numbers are shuffled.
    """
    ids = known.select(key)
    if fits_broadcast(ids):
        return semi_join_known(df, ids, key)
    found = rows.select(key, AT).join(ids.distinct(), key, "left_semi")
    return with_marked(df, found).select(key, *[c for c in df.columns if c != key])


def _block() -> Column:
    return F.expr(f"{AT} div {_BLOCK_BITS}")


def with_marked(rows: DataFrame, marked: DataFrame, keep: bool = True) -> DataFrame:
    """The numbered ``rows`` whose number is in ``marked`` (not ``keep``: is not)."""
    marked = marked.select(AT)
    bits = store(marked.select(_block().alias(_BLOCK), (F.col(AT) % _BLOCK_BITS).cast("int").alias("bit"))
                 .repartition(_BLOCK).groupBy(_BLOCK).agg(F.bitmap_construct_agg("bit").alias(_BITS)), "marks")
    if not fits_broadcast(bits):
        return rows.join(marked, AT, "left_semi" if keep else "left_anti").select(*rows.columns)
    at = F.col(AT) % _BLOCK_BITS
    byte = F.conv(F.hex(F.substring(F.col(_BITS), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return (rows.withColumn(_BLOCK, _block()).join(F.broadcast(bits), _BLOCK, "left")
            .filter(hit if keep else ~hit).select(*rows.columns))
