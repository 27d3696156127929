"""Quality scores by Bradley-Terry pairwise ranking.

A document's utility is linear in surface statistics of its whole text (FEATURES).  The
weights are learnt from preference pairs, a document labelled 1 against one labelled 0, by
the logistic loss of the pair's feature differences, with a ridge, by Newton steps; a
difference has no intercept.  The cut is the quantile of the fitted rows' utilities that
separates their labels best, and the utility's distance to it gives the score:
sigmoid(utility - cut + logit(ACCEPT)), so score >= ACCEPT exactly at or above the cut.

Bounds: at most SAMPLE rows of each label are fitted on, chosen by a hash of the id, in PAIRS
random pairs.  Only their features, a few numbers each, reach the driver.

A text without words (null, empty or blanks) scores 0.  With labels of one kind only, or
none, every other text scores 0.5.  Labels that are null or not 0 or 1 are not learnt from;
a doc_id with both labels counts in both.  Of rows that repeat a doc_id the text with the
smallest hash is fitted on.  Rows are independent; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import bounded_sample, map_batches, prepare, stored
from goldleaf.llm.words import words_of

SAMPLE, PAIRS = 3000, 40_000
ACCEPT = 0.3
FEATURES = ("upper", "digit", "symbol", "wide", "caps_words", "marked_words", "bare_symbols", "repeats", "distinct",
            "word_length", "long_words", "line_words", "size", "one_word_lines", "worst_run")

_UPPER, _LOWER, _DIGIT, _SYMBOL = (np.zeros(256, np.int64) for _ in range(4))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = 1
_SYMBOL[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:?'\"()-"]] = 1


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[at[1:]] - total[at[:-1]]


def features(column: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text, plus a last column: its number of words."""
    w = words_of(column)
    n = np.diff(w.first)
    out = np.zeros((len(n), len(FEATURES) + 1))
    if not len(w.starts):
        return out
    low, high = w.first[:-1], w.first[1:]
    has = n > 0
    words = np.maximum(n, 1)
    span = np.concatenate([w.starts, [len(w.data)]])
    cuts = np.stack([w.starts, w.ends])
    size = w.ends - w.starts
    upper, lower, symbol = (np.concatenate([[0], np.cumsum(t[w.data])]) for t in (_UPPER, _LOWER, _SYMBOL))
    per = lambda total: total[cuts[1]] - total[cuts[0]]  # noqa: E731  of each word
    letters = np.maximum(_sums(size, w.first), 1)
    caps = (per(upper) >= 2) & (per(lower) == 0)
    bare = per(symbol) == size
    marked = (_SYMBOL[w.data[w.ends - 1]] == 1) & ~bare
    same = np.zeros(len(size), bool)
    same[1:] = w.hashes[1:] == w.hashes[:-1]
    same[low[has]] = False
    breaks = np.concatenate([[0], np.cumsum(w.data == 10)])
    lines = np.ones(len(n))
    lines[has] += breaks[w.starts[high[has] - 1]] - breaks[w.starts[low[has]]]
    alone = np.ones(len(size), bool)
    gap = breaks[w.starts[1:]] > breaks[w.ends[:-1]]
    alone[1:] &= gap
    alone[:-1] &= gap
    distinct = np.array([len(np.unique(w.hashes[a:b])) for a, b in zip(low.tolist(), high.tolist(), strict=True)])
    run = np.array([np.bincount(np.cumsum(~same[a:b])).max() if b > a else 0 for a, b in zip(low.tolist(), high.tolist(), strict=True)])
    digit, wide = _sums(_DIGIT[w.data], span[w.first]), _sums(w.data > 127, span[w.first])
    columns = (_sums(per(upper), w.first) / letters, digit / letters, _sums(per(symbol), w.first) / letters, wide / letters,
               _sums(caps, w.first) / words, _sums(marked, w.first) / words, _sums(bare, w.first) / words, _sums(same, w.first) / words, distinct / words,
               letters / words, _sums(size > 24, w.first) / words, np.log1p(words / lines), np.log1p(words), _sums(alone, w.first) / lines, np.log1p(run))
    for k, c in enumerate(columns):
        out[:, k] = np.where(has, c, 0)
    out[:, -1] = n
    return out


class Model:
    """Standardisation, weights and the cut."""

    def __init__(self, good: np.ndarray, bad: np.ndarray, seed: int = 7, ridge: float = 1e-3):
        both = np.concatenate([good, bad])
        self.mean, self.scale = both.mean(0), both.std(0) + 1e-9
        good, bad = self._scaled(good), self._scaled(bad)
        rng = np.random.default_rng(seed)
        d = good[rng.integers(len(good), size=PAIRS)] - bad[rng.integers(len(bad), size=PAIRS)]
        w = np.zeros(d.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
            grad = d.T @ (p - 1) / len(d) + ridge * w
            step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge * np.eye(len(w)), grad)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w
        u, y = np.concatenate([good, bad]) @ w, np.repeat([1, 0], [len(good), len(bad)])
        cuts = np.quantile(u, np.linspace(0.005, 0.995, 199))
        right = np.array([np.mean(u[y == 1] >= c) + np.mean(u[y == 0] < c) for c in cuts])
        self.cut = float(np.median(cuts[right == right.max()]))

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def scores(self, x: np.ndarray) -> np.ndarray:
        u = self._scaled(x) @ self.weights - self.cut + np.log(ACCEPT / (1 - ACCEPT))
        return 1 / (1 + np.exp(-np.clip(u, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model of docs (doc_id, text) and labels (doc_id, quality); None without both labels."""
    prepare(docs.sparkSession)
    chosen = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    chosen = F.broadcast(stored(bounded_sample(chosen, "quality", "doc_id", SAMPLE), "quality-sample"))  # 2 * SAMPLE rows at most

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = features(batch.column(1))
        values = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2), values], names=["doc_id", "quality", "x"])

    texts = docs.select("doc_id", "text").join(chosen, "doc_id")
    texts = texts.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("doc_id", "t.text", "quality")
    rows = map_batches(texts.select("doc_id", "text", "quality"), run, "doc_id long, quality int, x array<double>")
    rows = sorted((r["quality"], r["doc_id"], r["x"]) for r in rows.collect() if r["x"][-1])
    good, bad = (np.array([r[2][:-1] for r in rows if r[0] == y]) for y in (1, 0))
    return Model(good, bad) if len(good) and len(bad) else None


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score and predicted of each row."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = features(batch.column(1))
        s = shared.value.scores(x[:, :-1]) if shared.value is not None else np.full(len(x), 0.5)
        s = np.where(x[:, -1] > 0, s, 0.0)
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(s), pa.array((s >= ACCEPT).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, score double, predicted int")
