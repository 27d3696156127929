"""Secret scans: base patterns, and Markov models of random strings and ordinary identifiers.

Spark expressions only, on the main path: no Python functions, Arrow or RDDs.

Base kinds, leftmost and without overlap for each kind; a match that fails its test is
dropped and the search goes on behind it:

* assign: a secret's name, `:` or `=`, and a value of six or more characters;
* access: AKIA and capitals or digits, twenty or more characters;
* hex:    twenty-four or more hexadecimal digits.

The method adds `markov` spans: tokens of sixteen or more of [A-Za-z0-9+/_=-], with a digit
and a letter, that touch no base span and whose log-likelihood ratio between two first-order
character models is at least LEAST_LLR.  The model of random strings is learnt from values
that base spans caught (of an assignment its value alone, without the name), that of ordinary identifiers from the other words and names of the
same texts; both from a bounded sample of labelled tokens (about SAMPLE_DOCS documents of
each kind, by a hash), as smoothed counts of character pairs.  The two models are
one row of ALPHABET ** 2 log ratios, a constant of the query.

Positions are code points, the end exclusive.  Null and empty texts have no spans.  Rows are
independent: ids may be null or repeated, other columns are ignored.  Without base spans to
learn from there are no markov spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import hash_share, prepare, stored

# The base patterns.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a run of hexadecimal digits that is long enough: runs do not overlap
KINDS = ("assign", "access", "hex", "markov")

TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
#: Ordinary words and names to learn from: whole tokens that are not candidates themselves.
IDENTIFIER = r"(?<![A-Za-z0-9+/_=-])(?:[A-Za-z_][A-Za-z0-9_]{5,14}|[A-Za-z_]{16,})(?![A-Za-z0-9+/_=-])"
#: Documents, with and without a base match each, that the models are learnt from.
SAMPLE_DOCS = 2000
#: Characters by code, 0 to 127.
ALPHABET = 128
#: Weight of single characters against a character's pairs, in pairs seen.
BACK_OFF = 8
#: Matches of a text that are walked at a time.
BLOCK = 200
#: Odds of a million to one, in nats.
LEAST_LLR = 13.8


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once also where the body needs it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _spans(text: Column, pattern: str, kind: str, test=None) -> Column:
    """Positions of all matches; test(match, group 2) keeps or drops one.

    split() and regexp_extract_all() walk the same matches, so a match starts where the
    pieces and matches before it end.  Matches are walked in blocks of BLOCK, since each
    step of an aggregate copies the array that it adds to: texts may hold very many.
    """
    empty = F.array().cast("array<struct<start:int,stop:int,kind:string>>")
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    second = F.regexp_extract_all(text, F.lit(pattern), 2) if test else found
    both = F.arrays_zip(F.transform(F.slice(pieces, 1, F.size(found)), F.length).alias("gap"), found.alias("whole"), second.alias("second"))

    def step(state: Column, m: Column) -> Column:
        start = state["at"] + m["gap"]
        stop = start + F.length(m["whole"])
        span = F.array(F.struct(start.alias("start"), stop.alias("stop"), F.lit(kind).alias("kind")))
        spans = F.concat(state["spans"], span)
        return F.struct(stop.alias("at"), (F.when(test(m["whole"], m["second"]), spans).otherwise(state["spans"]) if test else spans).alias("spans"))

    def walk(both: Column) -> Column:
        def block(done: Column, first: Column) -> Column:
            return F.concat(done, F.array(F.aggregate(F.slice(both, first, BLOCK), F.struct(F.element_at(done, -1)["at"].alias("at"), empty.alias("spans")), step)))
        done = F.aggregate(F.sequence(F.lit(1), F.size(both), F.lit(BLOCK)), F.array(F.struct(F.lit(0).alias("at"), empty.alias("spans"))), block)
        return F.flatten(F.transform(done, lambda d: d["spans"]))

    return F.when(F.regexp_like(text, F.lit(pattern)), _let(both, walk)).otherwise(empty)


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty) and base: the array of base spans, by start, then kind."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    long_ = lambda n: lambda whole, second: F.length(second) >= n
    found = docs.select("doc_id", "text", _spans(F.col("text"), ASSIGN, "assign", long_(6)).alias("assign"),
                        F.filter(_spans(F.col("text"), ACCESS, "access"), lambda s: s["stop"] - s["start"] >= 20).alias("access"),
                        _spans(F.col("text"), HEX, "hex").alias("hex"))
    return found.select("doc_id", "text", _sorted(F.concat("assign", "access", "hex")).alias("base"))


def _sorted(spans: Column) -> Column:
    """By start, then kind in the order of KINDS."""
    rank = lambda s: F.array_position(F.lit(list(KINDS)), s["kind"])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    return F.transform(keyed, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))


def _text_of(text: Column, span: Column) -> Column:
    return F.substring(text, span["start"] + 1, span["stop"] - span["start"])


def _named(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def labelled_tokens(docs: DataFrame) -> DataFrame:
    """(token, random): values of base spans, and words of texts without any, of the sampled documents.

    A narrow table of hashes is kept from the first pass; only the chosen texts are scanned.
    """
    key = F.xxhash64("doc_id", "text").alias("key")
    held = F.coalesce(F.regexp_like("text", F.lit(f"{ASSIGN}|{ACCESS}|{HEX}")), F.lit(False)).alias("held")
    marks = stored(docs.select(key, held), "secret-marks")
    kinds = [hash_share(marks.where(F.col("held") == k).distinct(), "key", SAMPLE_DOCS) for k in (True, False)]
    chosen = F.broadcast(stored(kinds[0].unionByName(kinds[1]), "secret-sample"))  # about 2 * SAMPLE_DOCS rows
    few = docs.select("doc_id", "text", key).join(chosen, "key").dropDuplicates(["key"])
    base = base_spans(few)
    said = lambda s: _text_of(F.col("text"), s)
    value = lambda s: F.when(s["kind"] == "assign", F.regexp_extract(said(s), ASSIGN, 2)).otherwise(said(s))
    values = base.select(F.explode(F.transform("base", value)).alias("token"))
    words = base.where(F.size("base") == 0).select(F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), 0)).alias("token"))
    return values.withColumn("random", F.lit(True)).unionByName(words.withColumn("random", F.lit(False))).where("length(token) >= 6")


def fit(tokens: DataFrame) -> list[float] | None:
    """Log ratios of the pair probabilities, at code of the first * ALPHABET + code of the second; None without both kinds."""
    code = lambda at: F.least(F.ascii(F.substring("token", at, F.lit(1))), F.lit(ALPHABET - 1))
    pairs = (tokens.select("random", "token", F.explode(F.sequence(F.lit(1), F.length("token") - 1)).alias("i"))
             .select("random", code(F.col("i")).alias("a"), code(F.col("i") + 1).alias("b")))
    counts = pairs.groupBy("a", "b").agg(F.count(F.when(F.col("random"), 1)).alias("r"), F.count(F.when(~F.col("random"), 1)).alias("w"))
    rows = counts.collect()  # ALPHABET ** 2 rows at most
    if not any(x.r for x in rows) or not any(x.w for x in rows):
        return None
    return log_ratios({(x.a, x.b): (x.r, x.w) for x in rows})


def log_ratios(counts: dict[tuple[int, int], tuple[int, int]]) -> list[float]:
    """Pairs backed off to single characters, and these to add-one over the 66 characters of tokens."""
    from math import log

    first, second = ([[0, 0] for _ in range(ALPHABET)] for _ in range(2))
    for (a, b), c in counts.items():
        for k in (0, 1):
            first[a][k] += c[k]
            second[b][k] += c[k]
    total = [sum(x[k] for x in second) for k in (0, 1)]

    def chance(a: int, b: int, k: int) -> float:
        alone = (second[b][k] + 1) / (total[k] + 66)
        return (counts.get((a, b), (0, 0))[k] + BACK_OFF * alone) / (first[a][k] + BACK_OFF)

    return [round(log(chance(a, b, 0)) - log(chance(a, b, 1)), 4) for a in range(ALPHABET) for b in range(ALPHABET)]


def add_markov(base: DataFrame, ratios: list[float] | None) -> DataFrame:
    """doc_id, base and spans (base and markov ones) of base_spans()."""
    if ratios is None:
        return base.select("doc_id", "base", F.col("base").alias("spans"))
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")  # folded to a constant
    code = lambda token, at: F.ascii(F.substring(token, at, F.lit(1)))
    pair = lambda token, i: F.element_at(table, code(token, i) * ALPHABET + code(token, i + 1) + 1)
    ratio = lambda token: F.aggregate(F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0), lambda acc, i: acc + pair(token, i))
    tokens = F.filter(_spans(F.col("text"), TOKEN, "markov"), lambda s: _text_of(F.col("text"), s).rlike("[0-9]") & _text_of(F.col("text"), s).rlike("[A-Za-z]"))
    apart = lambda s: ~F.exists("base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
    found = base.select("doc_id", "text", "base", tokens.alias("tokens"))
    found = found.withColumn("tokens", F.filter("tokens", lambda s: apart(s) & (ratio(_text_of(F.col("text"), s)) >= LEAST_LLR)))
    return found.select("doc_id", "base", F.when(F.size("tokens") > 0, _sorted(F.concat("base", "tokens"))).otherwise(F.col("base")).alias("spans"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans: arrays of start, stop and kind."""
    prepare(docs.sparkSession)
    return add_markov(base_spans(docs), fit(labelled_tokens(docs)))


def digests(found: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of the base spans, and all spans by name."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(_named(F.col("base")), 256).alias("base_sha256"), _named(F.col("spans")).alias("spans"))
