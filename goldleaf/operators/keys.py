"""Surrogate keys and junk dimensions.

``assign_surrogate_keys`` gives dense keys ``start, start+1, ...`` in a total
order without a global (single-partition) window:

1. range-partition and sort by the order columns (one shuffle);
2. store the rows with their partition's number and their position in it
   (the low 33 bits of ``monotonically_increasing_id``) as Parquet in the shared
   folder, which fixes both;
3. count the stored rows of each partition number (one column is read; the driver
   receives one number per partition, never rows);
4. key = start + offset(partition) + position, where the offsets are a
   broadcast table with one row per partition.

Step 4 is a narrow projection, so the keyed table is never funnelled
through one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.sources.files import store


_PID, _START, _POS, _SET = "__goldleaf_pid", "__goldleaf_start", "__goldleaf_pos", "__goldleaf_set"


def _order_cols(order_by: Sequence) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]


def assign_surrogate_keys(df: DataFrame, key_col: str, order_by: Sequence | None = None,
                          start: int = 1, num_partitions: int | None = None,
                          key_type: T.DataType = T.LongType(), lead: int | None = None) -> DataFrame:
    """Add ``key_col`` = dense sequence from ``start`` following ``order_by``.

    The number of partitions is the given one, or what AQE makes of the rows' bytes.
    Without ``order_by`` the existing partitioning is kept (no shuffle) and
    keys are dense but follow storage order.  The ranges go by the first ``lead`` order columns
    (default: all): rows that tie on these share a partition, where the sort goes by all of
    them, so the order is the same and the ranges are found from a few columns.
    """
    spark = df.sparkSession
    if order_by:
        cols = _order_cols(order_by)
        df = df.repartitionByRange(*([num_partitions] if num_partitions else []), *cols[:lead]).sortWithinPartitions(*cols)
    position = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    placed = store(df.withColumns({_PID: F.spark_partition_id(), _POS: position}), "keyed")
    sizes = sorted(tuple(r) for r in placed.groupBy(_PID).count().collect())
    offsets = [0] + list(accumulate(n for _, n in sizes))[:-1]
    # one row per partition that holds rows: the offsets are data, the plan does not grow with them
    starts = spark.createDataFrame([(pid, at) for (pid, _), at in zip(sizes, offsets)], f"{_PID} int, {_START} long")
    key = (F.lit(start).cast("long") + F.col(_START) + F.col(_POS)).cast(key_type)
    return placed.join(F.broadcast(starts), _PID).select(key.alias(key_col), *df.columns)


def next_key(dim: DataFrame, key_col: str, hint: int | None = None) -> int:
    """First free key after the current maximum (1 for an empty table).

    With ``hint`` (a remembered next key) only keys ``>= hint`` are read: the
    filter is pushed into the Parquet scan, whose min/max statistics skip every
    older row group, and a stale hint (rows appended after it was saved) is
    detected and corrected instead of producing duplicate keys.
    """
    table = dim if hint is None else dim.filter(F.col(key_col) >= F.lit(hint))
    top = table.agg(F.max(key_col).alias("m")).first()["m"]
    if top is None:
        return 1 if hint is None else hint
    return int(top) + 1


def combinations(source: DataFrame, attr_sets: Sequence[Sequence[str]]) -> list[DataFrame]:
    """The distinct combinations of each attribute set, from one pass over ``source`` (GROUPING SETS).

    Both sets' combinations are aggregated on the map side before the one shuffle.
    """
    every = list(dict.fromkeys(a for attrs in attr_sets for a in attrs))
    # a set's own number, as NULL is also a value of an attribute
    which = reduce(lambda rest, k: F.when(_grouped_by(every, attr_sets[k]), k).otherwise(rest), range(len(attr_sets)), F.lit(-1))
    sets = [[F.col(a) for a in attrs] for attrs in attr_sets]
    found = source.groupingSets(sets, *[F.col(a) for a in every]).agg(which.alias(_SET)).checkpoint(eager=True)
    return [found.filter(F.col(_SET) == k).select(*attrs) for k, attrs in enumerate(attr_sets)]


def _grouped_by(every: Sequence[str], attrs: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.grouping(a) == F.lit(0 if a in attrs else 1) for a in every])


def build_junk_dimension(source: DataFrame, attrs: Sequence[str], key_col: str,
                         unknown_member: int | None = None) -> DataFrame:
    """One row per distinct attribute combination (NULL counts as a value).

    Keys follow the attributes' sort order (NULLs first), starting at 1.  With
    ``unknown_member`` set, a row with that key and all-NULL attributes is
    added as the target of lookups that miss.
    """
    # materialise the (small) combinations once: the range sampling and the keyed
    # pass then read them instead of recomputing the source twice
    combos = source.select(*attrs).distinct().checkpoint(eager=True)
    dim = assign_surrogate_keys(combos, key_col, order_by=list(attrs), key_type=T.IntegerType())
    if unknown_member is not None:
        unknown = dim.sparkSession.createDataFrame([(unknown_member,)], f"{key_col} int")
        dim = dim.unionByName(unknown, allowMissingColumns=True)
    return dim


def extend_junk_dimension(dim: DataFrame, source: DataFrame, attrs: Sequence[str], key_col: str) -> DataFrame:
    """``dim`` plus the attribute combinations of ``source`` it lacks (NULL-safe match),
    keyed after its maximum in attribute order; existing keys never change."""
    seen = dim.select(*[F.col(a).alias(f"__d_{a}") for a in attrs])
    combos = source.select(*attrs).distinct()
    cond = reduce(lambda x, y: x & y, [combos[a].eqNullSafe(seen[f"__d_{a}"]) for a in attrs])
    new = combos.join(seen, on=cond, how="left_anti").checkpoint(eager=True)
    keyed = assign_surrogate_keys(new, key_col, order_by=list(attrs), start=next_key(dim, key_col),
                                  key_type=dim.schema[key_col].dataType)
    return dim.select(key_col, *attrs).unionByName(keyed)
