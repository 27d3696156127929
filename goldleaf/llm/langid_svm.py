"""Language identification by hierarchical discrimination.

A text's features are its hashed byte n-grams (one to four bytes of the lower-cased text,
non-letters as one space), as shares of the text's n-grams on a root scale and of unit
length.  A linear machine over the families is applied first (one against the rest); within
the family that wins, one-versus-one linear support vector machines vote between its
languages, ties going to the larger sum of margins.  All are trained here, by dual
coordinate descent in numpy, on the labelled rows of a bounded sample.

The family of a language code is a fixed table of related languages; a code that it does
not list is a family of its own, so any label can be learnt.

Bounds: at most SAMPLE rows of each language are fitted on, chosen by a hash of the key;
the broadcast model has DIMS weights for each machine.  Features and predictions cover
whole texts.  `score` is the share of the winning family's and language's softmax; it only
compares the learnt languages, so unlike texts are told by their likeness.

Likeness is the mean log-probability of a text's n-grams in one language's fitted rows, an
absolute measure that other languages don't enter.  A text is known if its likeness to the
language it is judged to be lies under that language's median by no more than chance allows
a text of its length (CHANCE standard deviations) and SLACK times what the fitted rows need
beyond that (each judged without itself; the odd TAIL of them left out; LEAST at least).  A
language of one fitted row has no likeness to measure against: texts judged to be of it are
known.  A text of a few letters can be unlike by chance alone, so such texts mostly pass.

A null or empty text, or one without any letter, is `und` with score 0.  Without labelled
rows everything is `und`.  Null labels are not learnt from, nor rows without an id; of
rows that repeat an id and label the text with the smallest hash is fitted on.  Rows are
independent: ids may be null or repeated, and other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import bounded_sample, map_batches, prepare, stored
from goldleaf.llm.words import mix, stream

#: Fitted rows of each language, and of all languages together.
SAMPLE, SAMPLE_ALL = 400, 4000
DIMS = 1 << 13
#: The cut under which a text is unlike its language; weight of the uniform share of a profile.
CHANCE, SLACK, TAIL, LEAST, SMOOTH = 3.0, 1.25, 0.005, 0.6, 0.1
UNKNOWN = "und"

# Closely related languages, by ISO 639-1 code.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "es fr it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky",
    "indic": "hi ur bn pa mr gu ne",
    "semitic": "ar he mt am",
    "chinese": "zh yue wuu",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_PLACE = stream(31, 4) | np.uint64(1)
_BYTE = stream(32, 256)
#: ASCII other than letters becomes a space; bytes of other scripts stay.
_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def family(lang: str) -> str:
    return _FAMILY.get(lang.split("-")[0].lower(), lang)


def grams(text: str) -> np.ndarray | None:
    """The hashed n-grams of one text; None without a letter."""
    if not any(map(str.isalpha, text)):
        return None
    raw = _LETTERS[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    keep = (raw != 0x20) | np.concatenate([[True], raw[:-1] != 0x20])
    code = _BYTE[raw[keep]]
    out, total = [], np.zeros(len(code), np.uint64)
    for n in range(1, min(4, len(code)) + 1):
        total = total[:len(code) - n + 1] + code[n - 1:] * _PLACE[n - 1]
        out.append((mix(total) >> np.uint64(64 - DIMS.bit_length() + 1)).astype(np.int32))
    return np.concatenate(out)


def sized_features(text: str | None) -> tuple[np.ndarray, int] | None:
    """Features and number of n-grams."""
    found = grams(text) if text else None
    if found is None:
        return None
    x = np.sqrt(np.bincount(found, minlength=DIMS).astype(np.float32))
    return x / np.sqrt((x * x).sum()), len(found)


def features(text: str | None) -> np.ndarray | None:
    found = sized_features(text)
    return None if found is None else found[0]


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 12, seed: int = 1) -> np.ndarray:
    """Weights of an L2-regularised, squared-hinge linear machine; y is +1 or -1, the last feature is the bias."""
    rng = np.random.default_rng(seed)
    w, alpha = np.zeros(x.shape[1], np.float32), np.zeros(len(x), np.float32)
    scale = (x * x).sum(1) + 0.5 / c
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            step = (y[i] * float(x[i] @ w) - 1 + alpha[i] * 0.5 / c) / scale[i]
            new = max(alpha[i] - step, 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


class Model:
    """Families, their one-against-rest machines, and the pair machines within each family."""

    def __init__(self, x: np.ndarray, langs: list[str], sizes: list[int]):
        self.langs = sorted(set(langs))
        own = np.array(langs)
        kin = np.array([family(g) for g in langs])
        self.families = sorted(set(kin))
        self.members = {f: [g for g in self.langs if family(g) == f] for f in self.families}
        self.likeness = {g: Likeness(x[own == g], np.array(sizes)[own == g]) for g in self.langs}
        x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
        rows, self.pairs = [], []
        if len(self.families) == 2:
            w = linear_svm(x, np.where(kin == self.families[0], 1, -1))
            rows += [w, -w]
        elif len(self.families) > 2:
            rows += [linear_svm(x, np.where(kin == f, 1, -1)) for f in self.families]
        else:
            rows += [np.zeros(DIMS + 1, np.float32)]
        for f in self.families:
            for a, b in combinations(self.members[f], 2):
                which = (own == a) | (own == b)
                rows.append(linear_svm(x[which], np.where(own[which] == a, 1, -1)))
                self.pairs.append((a, b))
        self.weights = np.stack(rows, axis=1)

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        margins = x @ self.weights[:-1] + self.weights[-1]
        n = len(self.families)
        share = softmax(margins[:n])
        at = int(np.argmax(margins[:n]))
        votes = {g: [0, 0.0] for g in self.members[self.families[at]]}
        for (a, b), m in zip(self.pairs, margins[n:], strict=True):
            if a in votes:
                votes[a if m >= 0 else b][0] += 1
                votes[a][1] += float(m)
                votes[b][1] -= float(m)
        best = max(votes, key=lambda g: (votes[g], g))
        inner = softmax(np.array([v[1] for v in votes.values()]))
        return best, float(share[at] * inner[list(votes).index(best)])

    def knows(self, x: np.ndarray, size: int) -> bool:
        """Whether a text of `size` n-grams is like the language it is judged to be."""
        return self.likeness[self.predict(x)[0]].fits(x, size)


class Likeness:
    """Mean log-probability of n-grams in one language, and how far under their median its rows lie."""

    def __init__(self, x: np.ndarray, sizes: np.ndarray):
        share = x.astype(np.float64) ** 2
        total = share.sum(0)
        self.logp = _log(total / len(x))
        self.most = np.inf
        if len(x) < 2:
            return
        own = np.array([s @ _log(np.maximum(total - s, 0) / (len(x) - 1)) for s in share])
        self.middle = float(np.median(own))
        # the n-grams of one to four bytes at a place count as one
        self.spread = 4 * float(np.median(share @ self.logp**2 - (share @ self.logp) ** 2))
        under = np.sort(self.middle - own - self._chance(sizes))
        self.most = max(LEAST, SLACK * float(under[len(under) - 1 - int(TAIL * len(under))]))

    def _chance(self, size):
        return CHANCE * np.sqrt(self.spread / size)

    def fits(self, x: np.ndarray, size: int) -> bool:
        return self.most == np.inf or self.middle - float((x * x) @ self.logp) - self._chance(size) <= self.most


def _log(share: np.ndarray) -> np.ndarray:
    return np.log((share + SMOOTH / DIMS) / (1 + SMOOTH))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(2 * (x - x.max()))
    return e / e.sum()


def fit(labelled: DataFrame) -> Model | None:
    """A model of (doc_id, text, lang) rows; None without any."""
    spark = prepare(labelled.sparkSession)
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    n = labelled.select("lang").distinct().count()
    if not n:
        return None
    chosen = bounded_sample(labelled.select("doc_id", "lang"), "lang", "doc_id", max(1, min(SAMPLE, SAMPLE_ALL // n)))
    chosen = F.broadcast(stored(chosen, "lang-sample"))  # SAMPLE_ALL rows at most, or one of each language

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found = [(i, g, x) for i, g, x in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), map(sized_features, batch.column(1).to_pylist()), strict=True) if x is not None]
        if not found:
            return None
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string()), pa.array([f[2][0].astype(np.float16).tobytes() for f in found], pa.binary()), pa.array([f[2][1] for f in found], pa.int64())], names=["doc_id", "lang", "x", "size"])

    texts = labelled.join(chosen, ["doc_id", "lang"], "left_semi")
    texts = texts.groupBy("doc_id", "lang").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("doc_id", "t.text", "lang")
    rows = map_batches(texts.select("doc_id", "text", "lang"), run, "doc_id long, lang string, x binary, size long")
    rows = sorted((r["doc_id"], r["lang"], bytes(r["x"]), r["size"]) for r in rows.collect())
    if not rows:
        return None
    x = np.stack([np.frombuffer(r[2], np.float16) for r in rows]).astype(np.float32)
    return Model(x, [r[1] for r in rows], [r[3] for r in rows])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score of each row."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = shared.value
        out = []
        for text in batch.column(1).to_pylist():
            x = features(text) if held is not None else None
            out.append((UNKNOWN, 0.0) if x is None else held.predict(x))
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of `docs` that are like the language they are judged to be; all columns, no shuffle."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        held, keep = shared.value, []
        for text in batch.column(at).to_pylist():
            found = sized_features(text) if held is not None else None
            keep.append(found is not None and held.knows(*found))
        return batch.filter(pa.array(keep, pa.bool_()))

    return map_batches(docs, run, docs.schema)
