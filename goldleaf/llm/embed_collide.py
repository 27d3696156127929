"""Near-duplicate embeddings by collision counting on one-dimensional projections.

Within a label, unit vectors are projected on PROJECTIONS fixed Gaussian directions.  For a
pair at distance r a projection's difference is normal with deviation r, whatever the
dimension.  Each projection is sorted; the window centred on a query's own projection,
WIDTH deviations of the threshold distance to either side, gives its collisions by two
binary searches; collisions are counted for each pair over all projections.  Pairs whose
count reaches the calibrated number, the largest that a pair at the threshold reaches with
probability RECALL at least (an exact binomial tail), are verified by their cosine in double
precision.  So no link is false, and a pair at the threshold itself is found with
probability RECALL or more; more similar pairs still more surely.

Equal vectors of a label are one class of known size, and only class representatives are
compared.  They are dealt by hash into blocks of about BLOCK; a task takes two blocks of a
label, whatever the label's size, and gives back one row for each linked vector: the number
of its links and a root that it is linked to, never the pairs themselves.  Link numbers are
summed, and roots closed to components, across tasks.  The work on a label grows with the
square of its number of different vectors, as the counting itself does, divided evenly.

Rows whose label or vec_id is null, and vectors that are null, empty, zero or hold null or
non-finite components, link with nothing; their component is their own vec_id.  Vectors of
different lengths do not link.  Rows that repeat a vec_id are one vector: a link of any of
them counts for it, and equal rows count once.  Other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import components, prepare, stored

THRESHOLD = 0.93
PROJECTIONS, WIDTH, RECALL = 48, 1.5, 0.99999
BLOCK = 4096
_REACH = sqrt(2 - 2 * THRESHOLD)


def least_count() -> int:
    """The largest count that a pair at the threshold reaches with probability RECALL."""
    p = erf(WIDTH / sqrt(2))
    below, n = 0.0, 0
    while below + (mass := comb(PROJECTIONS, n) * p**n * (1 - p) ** (PROJECTIONS - n)) <= 1 - RECALL:
        below, n = below + mass, n + 1
    return n


@lru_cache(8)
def directions(dim: int) -> np.ndarray:
    return np.random.default_rng(20240 + dim).standard_normal((dim, PROJECTIONS))


def candidates(a: np.ndarray, b: np.ndarray):
    """For each row of a, the rows of b with enough collisions: yields (row, rows of b)."""
    queries, held = a @ directions(a.shape[1]), b @ directions(a.shape[1])
    order = np.argsort(held, axis=0, kind="stable")
    half, need = WIDTH * _REACH, least_count()
    low, high = (np.stack([np.searchsorted(held[order[:, k], k], queries[:, k] + s * half, side) for k in range(PROJECTIONS)], axis=1).tolist()
                 for s, side in ((-1, "left"), (1, "right")))
    columns = [np.ascontiguousarray(order[:, k]) for k in range(PROJECTIONS)]
    for q, (lo, hi) in enumerate(zip(low, high, strict=True)):
        count = np.zeros(len(b), np.uint8)
        for column, x, y in zip(columns, lo, hi, strict=True):
            count[column[x:y]] += 1  # a projection's window holds a row once
        found = np.flatnonzero(count >= need)
        if len(found):
            yield q, found


def links_of(a: np.ndarray, b: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine >= THRESHOLD between rows of a and b, or within a (i < j) if b is None."""
    left, right = [], []
    other = a if b is None else b
    for q, found in candidates(a, other):
        if b is None:
            found = found[found > q]
        found = found[other[found] @ a[q] >= THRESHOLD]
        left.append(np.full(len(found), q))
        right.append(found)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.empty(0, int), np.empty(0, int))


def roots_of(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n by the links (i, j)."""
    root = np.arange(n)
    while True:
        old = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == old).all():
            return root


def _compare(table: pa.Table) -> pa.Table:
    """node, root and links of the linked vectors of one pair of blocks."""
    table = table.sort_by([("side", "ascending"), ("node", "ascending")]).combine_chunks()
    node, size, side = (table[c].to_numpy() for c in ("node", "size", "side"))
    x = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(node), -1).astype(np.float64)
    x /= np.sqrt((x * x).sum(1))[:, None]
    split = int((side == 0).sum())
    alone = table["low"][0].as_py() == table["high"][0].as_py()
    i, j = links_of(x, None) if alone else links_of(x[:split], x[split:])
    j = j if alone else j + split
    links = np.bincount(i, size[j], len(node)) + np.bincount(j, size[i], len(node))
    by_id = np.argsort(node, kind="stable")
    place = np.empty(len(node), int)
    place[by_id] = np.arange(len(node))
    root = roots_of(len(node), place[i], place[j])
    has = links > 0
    return pa.table({"node": node[has], "root": node[by_id][root[place[has]]], "links": links[has].astype(np.int64)})


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of vectors (vec_id, embedding, label)."""
    prepare(vectors.sparkSession)
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    zero = ~F.exists("vector", lambda e: e != 0)
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & ~bad & ~zero, F.lit(False))
    # equal vectors up to length and sign of zero are told apart; they meet as links instead
    v = stored(v.withColumn("usable", usable), "vectors")
    rows = v.where("usable").select("vec_id", "label", "vector").distinct()
    classes = stored(rows.groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("size")), "vector-classes")
    kinds = classes.groupBy("label", F.size("vector").alias("dim")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = (classes.withColumn("dim", F.size("vector")).join(kinds, ["label", "dim"])
             .withColumn("own", F.pmod(F.xxhash64("node", "vector"), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("label", "dim", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                     (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "size", "vector"))
    met = stored(dealt.groupBy("label", "dim", "low", "high").applyInArrow(_compare, "node long, root long, links long"), "vector-links")
    part = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = met.groupBy("node").agg(F.sum("links").alias("links"))
    found = (classes.join(linked, "node", "left").join(part, "node", "left")
             .select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"), F.coalesce("component", "node").alias("component")))
    # back to the rows: by class, with each vec_id's best class where it has several
    by_id = rows.join(found, ["label", "vector"]).groupBy("vec_id").agg(F.sum("links").alias("links"), F.min("component").alias("component"))
    return (v.select("vec_id").join(by_id, "vec_id", "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
