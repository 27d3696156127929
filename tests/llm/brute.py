"""Plain brute-force versions that the tests hold the operators against."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def shingles(ws, n=5):
    if not ws:
        return []
    return [tuple(ws[i:i + n]) for i in range(len(ws) - n + 1)] or [tuple(ws)]


def union_find(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicates(docs):
    """{doc_id: (n_shingles, component_id)} of (doc_id, text) with distinct ids."""
    sets = {i: set(shingles(words(t))) for i, t in docs}
    where = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    common = Counter()
    for ids in where.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1:]:
                common[a, b] += 1
    pairs = [p for p, c in common.items() if 100 * c >= 75 * (len(sets[p[0]]) + len(sets[p[1]]) - c)]
    part = union_find(sets, pairs)
    return {i: (len(s), part[i]) for i, s in sets.items()}


def contaminated(docs, items):
    """{(doc_id, item_id): similarity} over every item-sized window."""
    held = [(i, ws, Counter(shingles(ws))) for i, ws in ((i, words(t)) for i, t in items) if ws]
    out = {}
    for doc_id, text in docs:
        ws = words(text)
        if not ws:
            continue
        own = set(shingles(ws))
        for item_id, iw, ic in held:
            if len(iw) >= 5 and not own & ic.keys():
                continue
            size = min(len(iw), len(ws))
            for s in range(len(ws) - size + 1):
                win = Counter(shingles(ws[s:s + size]))
                low, high = (win & ic).total(), (win | ic).total()
                if high and 100 * low >= 75 * high:
                    out[doc_id, item_id] = max(out.get((doc_id, item_id), 0), low / high)
    return out


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def secret_spans(text):
    """Base spans (kind, start, end) by start, then kind as listed."""
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii_spans(text):
    """Base spans (kind, start, end) by kind as listed, then start."""
    text = text or ""
    digits = lambda s: [c for c in s if c in "0123456789"]
    tests = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    ]
    return [(kind, m.start(), m.end()) for kind, pattern, ok in tests for m in re.finditer(pattern, text) if ok(m[0])]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def hash_tree(digests):
    """The root, and for each leaf the (left, right) digests beside it at every level."""
    paths, at, nodes = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            first = at[i] // 16 * 16
            run, k = nodes[first:first + 16], at[i] % 16
            p.append(("".join(run[:k]), "".join(run[k + 1:])))
            at[i] //= 16
        nodes = [sha(*nodes[b:b + 16]) for b in range(0, len(nodes), 16)]
    return nodes[0], paths


def manifest(docs):
    """Rows of the tamper check over (doc_id, source, lang, n_chars, text)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = defaultdict(list)
    for row in docs:
        groups[row[1]].append((row[0] is not None, row[0] or 0, sha(*map(field, row)), row))
    trees = []
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        rows = sorted(groups[source], key=lambda x: x[:3])
        trees.append((rows, *hash_tree([x[2] for x in rows])))
    if not trees:
        return []
    root, tops = hash_tree([t[1] for t in trees])
    out = []
    for (rows, subroot, paths), top in zip(trees, tops, strict=True):
        for (_, _, leaf, row), path in zip(rows, paths, strict=True):
            node = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                node = sha(*map(field, (*row[:4], row[4].translate(UPPER))))
            for left, right in path + top:
                node = sha(left, node, right)
            out.append((row[0], leaf, subroot, root, sha(*[a + b for a, b in path + top]), node, node == root))
    return out


def trie(turns):
    """Nodes (conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends) of rebuilt (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0, role, sha(f"{len(role.encode())}:", role, text)), (role, text)))
    own = {c: tuple(t for _, t in sorted(v)) for c, v in own.items()}
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - int(math.fmod(c, 100)), ())[:h] + ts[h:]
    members, kids = defaultdict(list), defaultdict(set)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
            if d:
                kids[ts[:d - 1]].add(ts[:d])
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    return [(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
             sha(",".join(str(c) for c in sorted(m) if rebuilt[c] == p))) for p, m in members.items()]
