"""The operators against brute force, public libraries and the edge cases of their docstrings."""

import hashlib
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from goldleaf.llm import (bpe_bitmap, chat_format, decontam_simhash, embed_collide, langid_svm, line_cuckoo, pii_bilstm,
                          quality_bt, secrets_markov, superminhash)
from goldleaf.llm import queries as Q
from goldleaf.llm.common import components
from goldleaf.llm.words import shingles_of, words_of

from conftest import SMOKE_DIR

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
# clashing names that the operators use inside
EDGE_SCHEMA = "doc_id long, text string, lang string, n_chars long, node long, key string, component string, shard int, label int"
LONG = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod " * 4000
LINE = "this very line is long enough to count as a repeated one"


def rows(*pairs):
    return [(i, t, None if t is None else "en", None, 1, "k", "c", 2, 3) for i, t in pairs]


@pytest.fixture(scope="module")
def edge(spark):
    texts = [(1, None), (2, ""), (3, "   \n\t"), (4, "one two"), (5, "ONE two"), (6, LONG), (7, LONG), (8, LONG), (None, LONG), (9, "123 456"),
             (10, LINE + "\n" + LINE), (11, LINE.upper()), (12, "  " + LINE), (13, LINE + "\nx"), (14, LINE), (14, LINE), (None, LINE), (15, "é" * 50)]
    return spark.createDataFrame(rows(*texts), EDGE_SCHEMA)


def by_id(df, *columns):
    return sorted(((r["doc_id"], *(r[c] for c in columns)) for r in df.collect()), key=str)


def smoke(spark, name):
    return spark.read.parquet(f"{SMOKE_DIR}/{name}.parquet")


# --- words -------------------------------------------------------------------

def test_shingles_follow_the_definition():
    texts = ["", None, "a", "A b", "a b c d e", "a  b\tc\nd e f", "é ü\x0bx\x0cy\rz w", " x ", "a b c d e f a b c d e"]
    hashes, first = shingles_of(words_of(pa.array(texts)))
    seen = {}
    for k, t in enumerate(texts):
        own = hashes[first[k]:first[k + 1]].tolist()
        want = brute.shingles(brute.words(t))
        assert len(own) == len(want)
        for h, s in zip(own, want, strict=True):
            assert seen.setdefault(h, s) == s
    assert len(set(seen.values())) == len(seen)


def test_sliced_arrays_are_read_at_their_offset():
    column = pa.array(["a b", "c d e", None, "f"]).slice(1)
    assert np.diff(words_of(column).first).tolist() == [3, 0, 1]


# --- 1 quality ---------------------------------------------------------------

def test_quality_accuracy_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in Q.op1(spark, sf).collect()}
    want = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [i for i in want if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i in held) and sum(r.held_out for r in got.values()) == sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in got)
    assert np.mean([got[i].predicted == want[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_quality_edges(spark, edge):
    assert {s for _, s in by_id(quality_bt.score(edge.where("doc_id < 4"), None), "score")} == {0.0}
    none = edge.limit(0)
    assert quality_bt.score(none, None).count() == 0
    labels = spark.createDataFrame([(4, None), (6, 1), (7, 5)], "doc_id long, quality int")
    assert quality_bt.fit(edge, labels) is None
    labels = spark.createDataFrame([(4, 0), (6, 1), (9, 0), (8, 1)], "doc_id long, quality int")
    assert quality_bt.score(edge, quality_bt.fit(edge, labels)).count() == edge.count()


def test_quality_weights_by_plain_gradient_descent():
    rng = np.random.default_rng(4)
    good, bad = rng.normal(0.4, 1, (80, 4)), rng.normal(0, 1, (70, 4))
    model = quality_bt.Model(good, bad, ridge=1e-2)
    both = np.concatenate([good, bad])
    scaled = [np.clip((x - both.mean(0)) / (both.std(0) + 1e-9), -8, 8) for x in (good, bad)]
    draw = np.random.default_rng(7)
    first, second = (draw.integers(len(x), size=quality_bt.PAIRS) for x in scaled)
    d = scaled[0][first] - scaled[1][second]
    w = np.zeros(4)
    for _ in range(1500):
        w -= 0.5 * (-(d / (1 + np.exp(d @ w))[:, None]).mean(0) + 1e-2 * w)
    assert np.allclose(model.weights, w, atol=1e-6)


# --- 2 tokens ----------------------------------------------------------------

def test_bpe_equals_tiktoken():
    ranks = bpe_bitmap.load_ranks(RANKS)
    own = bpe_bitmap.Encoder(ranks, public_tokenizers.PATTERN)
    their = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    texts = ["", "<|endoftext|>", "a" * 30000, " " * 5000, "the" * 5000, "日本" * 3000]
    texts += ["".join(rng.choice("abtheéß 日🙂\n1_\x00'sS") for _ in range(rng.randrange(80))) for _ in range(1500)]
    for t in texts:
        ids = own.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == their.encode_ordinary(t)
        assert own.decode(ids) == t.encode()


def test_bpe_shared_queue_equals_tiktoken(monkeypatch):
    ranks = bpe_bitmap.load_ranks(RANKS)
    their = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(4)
    parts = ["a", "b", "aa", "the", "ing", "é", "日", "🙂", " ", "\n", "0", "="]
    texts = [None, "", *("=" * k for k in range(1, 70)), *("a" * k for k in range(60, 140))]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]
    want = [np.array(their.encode_ordinary(t or ""), "<u4").tobytes() for t in texts]
    for chars, queued, kept in ((10**6, 10**6, 10**6), (2000, 100, 500)):  # also many runs, slices and emptied stores
        for name, value in (("RUN_CHARS", chars), ("QUEUED", queued), ("KEPT_PRETOKENS", kept), ("FEW", 20)):
            monkeypatch.setattr(bpe_bitmap, name, value)
        own = bpe_bitmap.Encoder(ranks, public_tokenizers.PATTERN)
        assert list(own.encode_all(texts)) == want
        assert [own.decode(i) for i in want] == [(t or "").encode() for t in texts]


def test_bpe_round_trip_on_edges(spark, edge):
    enc = bpe_bitmap.encode(edge, RANKS, public_tokenizers.PATTERN)
    back = by_id(bpe_bitmap.decode(enc, RANKS, public_tokenizers.PATTERN), "text")
    assert back == sorted(((r.doc_id, r.text or "") for r in edge.collect()), key=str)
    assert bpe_bitmap.encode(edge.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_query_equals_tiktoken(spark):
    their = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_bitmap.load_ranks(RANKS), special_tokens={})
    texts = {r.doc_id: r.text for r in smoke(spark, "documents").collect()}
    for r in Q.op2(spark, SMOKE_DIR).collect():
        ids = np.array(their.encode_ordinary(texts[r.doc_id] or ""), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


# --- 3 chat ------------------------------------------------------------------

def test_chat_reads_back_control_strings_and_edges(spark):
    nasty = ["<|turn|>", "a<|end|>b", "\\", "\\\\<|", "<", "<|text", "</s><s>[INST][/INST]<<SYS>><</SYS>>", "<|>", "|>", "", None, "x\ny", "<|next|>", "é🙂<"]
    data = [(c, t, role, text, 7) for c in (1, None) for t, (role, text) in enumerate((r, x) for x in nasty for r in ("user", "assistant", "assistant"))]
    data += [(2, 0, None, "a", 7), (2, None, "assi<|text|>stant", "b", 7), (2, 1, "user", "tie", 7), (2, 1, "user", "tie", 7)]
    turns = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, t int")
    chats = chat_format.format_conversations(turns)
    out = {r.conv_id: r for r in chats.withColumn("turns", chat_format.read_turns(F.col("formatted"))).withColumn("loss", chat_format.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    for c in (1, 2, None):
        want = sorted(((t is not None, t or 0), role or "", text or "") for i, t, role, text, _ in data if i == c)
        assert [(t.role, t.text) for t in out[c].turns] == [w[1:] for w in want]
        assert out[c].loss == "".join(w[2] for w in want if w[1] == "assistant")
    assert chat_format.format_conversations(turns.limit(0)).count() == 0


# --- 4 embeddings ------------------------------------------------------------

def vectors(spark, sf_dir):
    return [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]


def brute_links(data, threshold=0.93):
    n, pairs = {i: 0 for i, _, _ in data}, []
    for label in {x[2] for x in data if x[2] is not None}:
        part = [(i, np.array(v, float)) for i, v, g in data if g == label and v and all(e is not None and np.isfinite(e) for e in v) and any(v)]
        for k, (a, x) in enumerate(part):
            for b, y in part[k + 1:]:
                if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    pairs.append((a, b))
                    n[a] += 1
                    n[b] += 1
    part = brute.union_find(n, pairs)
    return {i: (n[i], part[i]) for i in n}


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    data = vectors(spark, SMOKE_DIR)
    base = rng.standard_normal((30, 64))
    data += [(1000 + k, (base[k % 30] + rng.standard_normal(64) * rng.uniform(0, 0.3)).tolist(), k % 3 if k % 30 < 20 else 1) for k in range(300)]
    data += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 64, 1), (2003, [float("nan")] + [1.0] * 63, 1), (2004, [None] + [1.0] * 63, 1), (2005, [float("inf")] + [1.0] * 63, 1),
             (2006, base[20].tolist(), None), (2007, base[20][:5].tolist(), 1), (2008, base[20].tolist(), 1), (2009, base[20].tolist(), 1), (2010, (base[20] * 3).tolist(), 1)]
    df = spark.createDataFrame([(*x, 1) for x in data], "vec_id long, embedding array<double>, label int, node long")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_collide.near_duplicates(df).collect()}
    want = brute_links(data)
    assert len(got) == len(want)
    assert sum(got[i] != want[i] for i in want) <= 2  # pairs just at the threshold are found with probability RECALL
    assert embed_collide.near_duplicates(df.limit(0)).count() == 0


def test_embedding_blocks_are_compared_across(spark, monkeypatch):
    monkeypatch.setattr(embed_collide, "BLOCK", 40)
    rng = np.random.default_rng(2)
    base = rng.standard_normal((20, 16))
    data = [(k, (base[k % 20] + rng.standard_normal(16) * 0.02).tolist(), 0) for k in range(200)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    assert {r.vec_id: (r.n_links, r.component_id) for r in embed_collide.near_duplicates(df).collect()} == brute_links(data)


# --- 5 near-duplicates -------------------------------------------------------

def test_near_duplicates_equal_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in smoke(spark, "documents").collect()]
    want = brute.near_duplicates(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in Q.op5(spark, SMOKE_DIR).collect()}
    assert got == want


def test_chains_of_near_copies_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(superminhash, "OUTSIDERS", 3)
    monkeypatch.setattr(superminhash, "STREAM", 10)
    rng = random.Random(4)
    docs, word = [], lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    for family in range(3):
        text = [word() for _ in range(120)]
        for k in range(60):
            own = list(text)
            for _ in range(rng.randrange(7)):
                own[rng.randrange(120)] = word()
            docs.append((family * 100 + k, " ".join(own)))
            if k % 10 == 0:
                text = own
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in superminhash.near_duplicates(df).collect()}
    assert got == brute.near_duplicates(docs)


def test_near_duplicate_edges(spark, edge):
    out = by_id(superminhash.near_duplicates(edge), "n_shingles", "component_id", "kept")
    assert (1, 0, 1, True) in out and (2, 0, 2, True) in out and (3, 0, 3, True) in out
    assert (4, 1, 4, True) in out and (5, 1, 4, False) in out
    assert [r[2:] for r in out if r[0] in (6, 7, 8)] == [(6, True), (6, False), (6, False)]
    assert [r[2:] for r in out if r[0] is None] == [(None, True)] * 2
    assert superminhash.near_duplicates(edge.limit(0)).count() == 0
    kept = superminhash.keep_one(edge)
    assert kept.columns == edge.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 6, 9, 10, 11, 15, None}  # 13 shares 7 of its 8 shingles


def test_signature_estimates_the_similarity():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for n in (10, 60, 300, 1500):
        a, b = np.unique(pool[:n]), np.unique(pool[n // 5:n + n // 5])
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        shares = [np.mean(superminhash.signature(a + s) == superminhash.signature(b + s)) for s in rng.integers(0, 2**62, 20).astype(np.uint64)]
        assert abs(np.mean(shares) - truth) < 0.03


def test_components_of_long_chains_and_stars(spark):
    pairs = [(k, k + 1) for k in range(0, 60)] + [(100, 100 + k) for k in range(1, 40)] + [(205, 203), (203, 204), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{100 + k: 100 for k in range(40)}, 203: 203, 204: 203, 205: 203}


# --- 6 secrets ---------------------------------------------------------------

def test_secret_base_spans_equal_brute_force(spark):
    rng = random.Random(6)
    bits = ["password", "Secret", "token", "API_KEY", "apikey", "=", ":", " ", '"', "'", "abc", "abcdef123", "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789abcdef", "é", "🙂", "\n", "_", "."]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(25))) for _ in range(800)] + ["", None, "a" * 50000, "token=" * 300, "secret=token: abcdefgh"]
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, base int")
    found = secrets_markov.base_spans(df).collect()
    for r in found:
        assert [(s.kind, s.start, s.stop) for s in r.base] == brute.secret_spans(texts[r.doc_id])
    assert len(found) == len(texts)
    assert secrets_markov.scan(df.limit(0)).count() == 0


def test_secret_spans_of_texts_with_very_many_matches(spark):
    size = secrets_markov.BLOCK
    texts = [" é".join(f"token={i:0{5 + i % 3}d} 0123456789abcdef01234567{i}" for i in range(n)) for n in (1, size - 1, size, size + 1, 3 * size, 15_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secrets_markov.base_spans(df).collect():
        assert [(s.kind, s.start, s.stop) for s in r.base] == brute.secret_spans(texts[r.doc_id])


def test_markov_models_tell_random_strings_from_identifiers(spark):
    rng = random.Random(7)
    rand = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    words = "the_user_name get_value compute_total parse_header stream_reader table_index window_size average_speed connection_count".split()
    docs = [(k, f"{rng.choice(words)} token = {rand(40)} {rng.choice(words)}") for k in range(150)]
    docs += [(1000 + k, " ".join(rng.choice(words) for _ in range(30))) for k in range(150)]
    plain = "average_connection_total_count2"
    secret = rand(36) + "7x"
    docs.append((5000, f"see {secret} and {plain} end"))
    out = {r.doc_id: r for r in secrets_markov.digests(secrets_markov.scan(spark.createDataFrame(docs, "doc_id long, text string"))).collect()}
    assert out[5000].spans == f"markov:4:{4 + len(secret)}"
    assert all("markov" not in out[k].spans and out[k].n_assign == 1 for k in range(150))


def test_markov_learns_the_value_of_an_assignment_alone(spark):
    texts = ["password=hunter22x", "api_key=ABC123xyz9", 'my "secret": "s3cr3t.va=lue" end', "Token:abcdef", "AKIA" + "Z" * 18, "x " + "0af" * 9]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets_markov.labelled_tokens(docs)
    assert sorted(r.token for r in found.where("random").collect()) == sorted(
        ["hunter22x", "ABC123xyz9", "s3cr3t.va=lue", "abcdef", "AKIA" + "Z" * 18, "0af" * 9])


# --- 7 personal data ---------------------------------------------------------

def test_pii_base_spans_equal_brute_force():
    rng = random.Random(8)
    bits = ["1", "23", "@", ".", "a", "b.c", " ", "-", "+", "(", ")", "255", "256", "0000255", "4111111111111111", "_", "%", "é", "\n"]
    for _ in range(6000):
        s = "".join(rng.choice(bits) for _ in range(rng.randrange(16)))
        assert pii_bilstm.base_spans(s) == brute.pii_spans(s)
    for s in ("", None, "1" * 20000, "a" * 100000 + "@", "1.2.3.4.5.6.7.8", "a@b.c_d@e.f"):
        assert pii_bilstm.base_spans(s) == brute.pii_spans(s)


def test_pii_net_gradient_and_scan(spark):
    texts = [r.text for r in smoke(spark, "documents").collect()]
    x = np.concatenate([pii_bilstm.windows_of(c := pii_bilstm.classes_of(t), pii_bilstm.window_starts(c)) for t in texts[:60]])[:4].T.astype(int)
    net, y = pii_bilstm.Net(), (x % pii_bilstm.TAGS).astype(int)
    _, grad = net.step(x, y)
    for k, at in (("xf", (x[0, 0], 5)), ("hb", (3, 7)), ("out", (2, 3)), ("trans", (0, 1))):
        e = 1e-5
        net.p[k][at] += e
        up = net.step(x, y)[0]
        net.p[k][at] -= 2 * e
        assert abs((up - net.step(x, y)[0]) / 2 / e - grad[k][at]) < 1e-4
        net.p[k][at] += e
    held = {r.doc_id: r.text for r in smoke(spark, "documents").collect()}
    for r in Q.op7(spark, SMOKE_DIR).collect():
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in brute.pii_spans(held[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


def test_pii_edges(spark, edge):
    out = pii_bilstm.scan(edge)
    assert out.count() == edge.count() and all(not r.spans for r in out.collect())
    assert pii_bilstm.scan(edge.limit(0)).count() == 0


def test_pii_net_is_trained_when_spans_are_rare(spark):
    # 40,000 windows of dates and one phone number, and long numeric texts
    texts = [f"{k:05d} was on {k % 28 + 1:02d}.{k % 12 + 1:02d}.2{k % 1000:03d}, not later" for k in range(40000)]
    texts += ["".join(f" {k * 7919 % 9973:04d}" for k in range(20000)), "call +49 30 1234567 now"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sum(map(bool, map(pii_bilstm.base_spans, texts))) == 1
    assert pii_bilstm.fit(docs) is not None
    assert pii_bilstm.fit(docs.where("text NOT LIKE 'call%'")) is None


class MarksAddresses:
    """In place of a net: marks an `@` and what surrounds it up to blanks, and nothing where it sees no `@`."""

    def decode(self, x):
        tags = np.zeros(x.shape, np.uint8)
        blank = pii_bilstm.classes_of(" ")[0]
        for row, out in zip(x, tags, strict=True):
            for at in np.flatnonzero(row == pii_bilstm._AT).tolist():
                a = b = at
                while a > 0 and row[a - 1] not in (blank, pii_bilstm._PAD):
                    a -= 1
                while b < len(row) and row[b] not in (blank, pii_bilstm._PAD):
                    b += 1
                out[a:b] = 2
                out[a] = 1
        return tags, np.ones(x.shape)


def test_pii_long_spans_are_found_at_every_offset():
    # a non-ASCII letter on both sides of the `@` makes it no base span
    for length in range(30, 101):
        name = "ü" * (length // 2)
        said = f"{name}@{'ö' * (length - len(name) - 4)}.de"
        for tail in (" ", " " + "so it goes " * 20):
            texts = ["x" * (k - 1) + " " * (k > 0) + said + tail for k in range(96, 128)]
            base = [pii_bilstm.base_spans(t) for t in texts]
            assert not any(base) and len(said) == length
            assert pii_bilstm.add_spans(MarksAddresses(), texts, base) == [[("email", k, k + length)] for k in range(96, 128)]


def test_trained_net_adds_forms_that_the_base_patterns_miss(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = pii_bilstm.fit(docs)
    forms = {"call me at %s today": ("phone", "(555) 123-4567"), "write to %s soon": ("email", "jürgen@müller.de"), "host %s is down": ("ip", "192[.]168[.]10[.]7"),
             "card %s was used": ("card", "4111.1111.1111.1111"), "amex %s ok": ("card", "3782-822463-10005")}
    texts = [t % said for t, (_, said) in forms.items()]
    base = [pii_bilstm.base_spans(t) for t in texts]
    assert not any(base)
    out = pii_bilstm.add_spans(net, texts, base)
    hits = [[(k, t[a:b]) for k, a, b in found] == [want] for t, found, want in zip(texts, out, forms.values(), strict=True)]
    assert sum(hits) >= 4 and hits[0] and hits[1]
    clean = ["on 2024-01-15 we met", "from 1998-2004 it was", "total 1,234,567.89 paid", "at 10:30:15 on 12.05.2021", "order 12345678 shipped", "follow @someone there",
             "pages 100-200, 1999 edition, 300 copies", "3 apples @ 5.99 each", "the years 1914 1918 1939 1945 were hard", "no digits at all"]
    assert not any(pii_bilstm.add_spans(net, clean, [[] for _ in clean]))
    rows = [t for (t,) in docs.where("text IS NOT NULL").select("text").collect()]
    base = [pii_bilstm.base_spans(t) for t in rows]
    out = pii_bilstm.add_spans(net, rows, base)
    assert all(set(b) <= set(s) for b, s in zip(base, out, strict=True)) and sum(map(len, out)) - sum(map(len, base)) <= 3


def test_other_forms_and_decoys_are_labelled_as_said():
    text = "so it goes on +49 (30) 5550-1234 and then mail max.25@mail7.example.com or 10.2.33.4 here. " * 3
    rows = list(pii_bilstm.labelled_windows(text))
    assert rows == list(pii_bilstm.labelled_windows(text)) and {r[0] for r in rows} == {0, 1, 3, 5, 6, 8, 9}
    for k, _, x, y in rows:
        kinds = {(t - 1) // 2 for t in y if t}
        assert len(x) == len(y) == pii_bilstm.WINDOW and (k != 4 or not kinds) and (k > 3 or k in kinds)
    rng = random.Random(1)
    assert {pii_bilstm._plausible("ip", pii_bilstm.varied("ip", "10.2.33.4", ["w"], rng)) for _ in range(50)} == {True}
    assert {pii_bilstm._plausible("phone", pii_bilstm.varied("phone", "", ["w"], rng)) for _ in range(200)} == {True}
    assert not any(pii_bilstm._plausible("ip", t) for t in ("1.2.3", "1.2.3.256", "1.2-3.4", "1 and 2 and 3 and 4"))


# --- 8 language --------------------------------------------------------------

def test_language_machines_and_votes_by_plain_loops():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 5)).astype(np.float32)
    y = np.where(x[:, 0] + 0.5 * rng.normal(size=60) > 0, 1, -1)
    w = np.zeros(5)
    for _ in range(20_000):  # the same objective by plain gradient descent
        gap = np.maximum(0, 1 - y * (x @ w))
        w -= 2e-4 * (w - 2 * 1.0 * (y * gap) @ x)
    assert np.allclose(langid_svm.linear_svm(x, y, c=1.0, rounds=300), w, atol=2e-3)
    langs = ["de", "en", "nl", "es", "fr", "it"]
    shares = np.abs(rng.normal(size=(48, langid_svm.DIMS)).astype(np.float32))
    for k in range(48):
        shares[k, k % 6::6] *= 2
    shares /= np.sqrt((shares * shares).sum(1, keepdims=True))
    model = langid_svm.Model(shares, [langs[k % 6] for k in range(48)], [200] * 48)
    for row in shares:
        margin = lambda k, row=row: sum(float(a) * float(b) for a, b in zip(row, model.weights[:-1, k], strict=True)) + float(model.weights[-1, k])
        by_family = {f: margin(k) for k, f in enumerate(model.families)}
        first = max(by_family, key=by_family.get)
        wins, sums = ({g: 0 for g in model.members[first]} for _ in range(2))
        for k, (a, b) in enumerate(model.pairs):
            if a in wins:
                m = margin(len(model.families) + k)
                wins[a if m >= 0 else b] += 1
                sums[a], sums[b] = sums[a] + m, sums[b] - m
        assert model.predict(row)[0] == max(wins, key=lambda g: (wins[g], sums[g], g))


def test_fits_do_not_depend_on_the_order_of_rows_that_repeat_an_id(spark):
    rows = [(k % 20, f"{'Wort und Satz' if k % 2 else 'word and line'} {k} " * (k % 5 + 1), "de" if k % 2 else "en") for k in range(60)]
    rows += [(k, t[::-1], g) for k, t, g in rows]
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, quality int")
    fits = []
    for some in (rows, rows[::-1]):
        docs = spark.createDataFrame(some, "doc_id long, text string, lang string").repartition(3).cache()
        fits.append((quality_bt.fit(docs, labels).weights, langid_svm.fit(docs).weights))
    assert all(np.array_equal(a, b) for a, b in zip(*fits, strict=True))


def test_language_accuracy_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = [r for r in Q.op8(spark, sf).collect() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in langs if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.95


def test_language_edges(spark, edge):
    out = {r.doc_id: r for r in langid_svm.predict(edge, langid_svm.fit(edge)).collect()}
    assert [out[k].lang_pred for k in (1, 2, 3, 9)] == ["und"] * 4 and out[4].lang_pred == "en"
    assert langid_svm.fit(edge.limit(0)) is None and langid_svm.predict(edge.limit(0), None).count() == 0
    assert {r.lang_pred for r in langid_svm.predict(edge, None).collect()} == {"und"}


def test_texts_unlike_the_learnt_languages_are_rejected(spark):
    docs = smoke(spark, "documents").select("doc_id", "text", "lang")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    alien = ["Съешь же ещё этих мягких французских булок да выпей чаю и пойди домой",
             "我能吞下玻璃而不伤身体。今天天气很好我们去公园吧",
             "Suomen kieli on uralilaisten kielten itämerensuomalaiseen ryhmään kuuluva kieli, jonka puhujista suurin osa asuu Suomessa",
             "qxzv jkwpt zzgh vbnmqw xkcd plokij wsxqaz edcrfv tgbyhn ujmikl qpwoei"]
    texts = spark.createDataFrame([(-1 - k, t, None) for k, t in enumerate(alien)], docs.schema)
    learnt = [["en", "de", "es", "fr"], ["en", "de"], ["en"]]
    for langs in learnt:  # the cut doesn't hang on the number of languages
        model = langid_svm.fit(docs.where(~out & F.col("lang").isin(langs)))
        clean = docs.where(out & F.col("lang").isin(langs))
        assert langid_svm.keep_known(texts, model).count() == 0
        assert langid_svm.keep_known(clean, model).count() == clean.count() > 0


# --- 9 lines -----------------------------------------------------------------

def test_line_dedup_edges_and_pipeline_form(spark, edge):
    out = by_id(line_cuckoo.dedup_digests(edge), "n_lines", "n_dropped")
    assert out == sorted([(1, 1, 0), (2, 1, 0), (3, 2, 0), (4, 1, 0), (5, 1, 0), (6, 1, 0), (7, 1, 0), (8, 1, 0), (None, 1, 0), (9, 1, 0),
                          (10, 2, 2), (11, 1, 1), (12, 1, 1), (13, 2, 1), (14, 1, 0), (14, 1, 0), (None, 1, 0), (15, 1, 0)], key=str)
    assert line_cuckoo.dedup_digests(edge.limit(0)).count() == 0
    whole = line_cuckoo.dedup_lines(edge)
    assert whole.schema.names == edge.schema.names
    texts = {r.doc_id: (r.text, r.n_chars, r.label) for r in whole.collect() if r.doc_id}
    assert texts[13] == ("x", 1, 3) and texts[10] == ("", 0, 3) and texts[1] == (None, None, 3)


def test_line_dedup_keeps_columns_named_like_its_own(spark):
    line = "a line of well over forty characters that many texts share"
    docs = spark.createDataFrame([(k, f"{line}\nown {k}", k * 2, "a") for k in range(6)], "doc_id long, text string, __llm_id long, __llm_keys string")
    out = line_cuckoo.dedup_lines(docs).collect()
    assert sorted((r.doc_id, r.text, r["__llm_id"], r["__llm_keys"]) for r in out) == [(k, f"own {k}" if k < 5 else f"{line}\nown 5", 2 * k, "a") for k in range(6)]


def test_line_index_insert_and_delete_are_inverse(spark):
    docs = smoke(spark, "documents").select("doc_id", "text")
    some, rest = docs.where("doc_id % 3 = 0"), docs.where("doc_id % 3 <> 0")
    whole = line_cuckoo.LineIndex.build(docs)
    grown = line_cuckoo.LineIndex.build(some).insert(rest)
    want = by_id(whole.digests(docs), "n_dropped", "kept_sha256")
    assert by_id(grown.digests(docs), "n_dropped", "kept_sha256") == want and any(r[1] for r in want)
    back = grown.delete(rest.select("doc_id"))
    fresh = line_cuckoo.LineIndex.build(some)
    assert by_id(back.digests(some), "n_dropped", "kept_sha256") == by_id(fresh.digests(some), "n_dropped", "kept_sha256")
    assert sorted(map(tuple, back.counts.collect())) == sorted(map(tuple, fresh.counts.collect()))
    assert by_id(line_cuckoo.LineIndex.empty(spark).insert(docs).digests(docs), "n_dropped", "kept_sha256") == want


def test_cuckoo_filter_holds_what_was_put_in():
    rng = np.random.default_rng(9)
    keys = np.unique(rng.integers(0, 2**63, 20000).astype(np.uint64))
    held = line_cuckoo.CuckooFilter.of(keys)
    assert held.contains(keys).all()
    assert held.contains(rng.integers(2**63, 2**64, 20000, dtype=np.uint64)).mean() < 0.005
    assert all(held.delete(k) for k in keys[:10000]) and held.contains(keys[10000:]).all()
    assert held.contains(keys[:10000]).mean() < 0.005
    assert line_cuckoo.CuckooFilter.load(held.dump()).contains(keys[10000:]).all()


# --- 10 decontamination ------------------------------------------------------

def test_decontamination_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in smoke(spark, "documents").collect()]
    items = [(r.item_id, r.text) for r in smoke(spark, "benchmark").collect()]
    rng = random.Random(10)
    for k in range(80):  # passages with some words changed, inside other text
        words = items[k % len(items)][1].split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = "changed"
        docs.append((10_000 + k, docs[k][1] + " " + " ".join(words) + " " + docs[k + 1][1]))
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam_simhash.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), smoke(spark, "benchmark")).collect()}
    assert got == brute.contaminated(docs, items) and len(got) > 20


def test_decontamination_edges(spark, edge, monkeypatch):
    items = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "one two", 0), (4, "two", 0), (5, LINE, 0), (6, LINE, 0), (None, "x y z", 0)], "item_id long, text string, node int")
    want = [(4, 3), (5, 3), (4, 4), (5, 4), *((d, i) for d in (10, 11, 12, 13, 14, None) for i in (5, 6))]
    assert sorted(by_id(decontam_simhash.contaminated(edge, items), "item_id"), key=str) == sorted(want, key=str)
    kept = decontam_simhash.drop_contaminated(edge, items)
    assert kept.columns == edge.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 6, 7, 8, None, 9, 15}
    assert decontam_simhash.contaminated(edge, items.limit(0)).count() == 0 and decontam_simhash.contaminated(edge.limit(0), items).count() == 0
    monkeypatch.setattr(decontam_simhash, "SLICE_BYTES", 40)  # several passes
    assert sorted(by_id(decontam_simhash.contaminated(edge, items), "item_id"), key=str) == sorted(want, key=str)


def test_short_items_are_found_inside_longer_texts(spark):
    items = [(1, "alpha beta gamma delta"), (2, "beta"), (3, "a b"), (4, "x"), (5, "one two three four five"), (6, "Q r s"), (6, "Q r s")]
    docs = [(1, "one two alpha beta gamma delta eps"), (2, "beta"), (3, "a b a b"), (4, "A  B\tc d"), (5, "q R"), (6, "q R\ns"), (7, "xx alphabeta"), (8, "one two three four"),
            (9, "b a"), (10, None), (11, "s q r s q " * 50), (12, "one two three four five")]
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam_simhash.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute.contaminated(docs, items) and got[1, 1] == got[3, 3] == 1.0 and (11, 6) in got


def test_multi_index_finds_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(11)
    index = decontam_simhash.Index([(k, " ".join(f"w{k}x{j}" for j in range(20))) for k in range(50)])
    which, marks, _ = index.sizes[20]
    for k in range(50):
        flip = np.zeros(decontam_simhash.BITS, np.uint8)
        flip[rng.choice(decontam_simhash.BITS, decontam_simhash.RADIUS, replace=False)] = 1
        w, i = index.lookup(20, (marks[k] ^ np.packbits(flip))[None, :])
        assert which[k] in i
