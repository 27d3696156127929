"""Personal data: base patterns, and a character BiLSTM with a CRF trained from labelled spans.

Base kinds, leftmost and without overlap for each kind; a match that fails its test is
dropped and the search goes on behind it, without a second try:

* email: name, `@`, a domain with a dot;
* ip:    four numbers of 255 at most;
* card:  16 to 19 digits, single spaces or hyphens between them, that pass Luhn's check;
* phone: `+` and 8 to 15 digits with blanks, dots, brackets or hyphens.

The method reads characters (ASCII small letters and marks each as itself, other kinds by
class) through a bidirectional LSTM and labels them with CRF transitions.  It runs over overlapping windows, WINDOW characters every STRIDE; windows
without `@` and with fewer than four digits cannot hold a span of any kind and are passed
over.  Each window is decoded by Viterbi; where a span touches a cut edge, overlaps no base span
and can be plausible if longer, the place is decoded again as one sequence, STRIDE wider on both sides and then twice as
wide each time, until it lies inside or the text ends.  A text's spans are then reconciled together: most windows
first, then most confident, then longest, none overlapping.  A span that overlaps no base
span and passes its kind's test in a wider form (PLAUSIBLE) is added; base spans stay.

The net is trained here in numpy, on at most SAMPLE_WINDOWS distinct windows of all texts, each
stratum's (STRATA) with the smallest hashes.  Windows are labelled by their base spans.  As the
net has to add what the base patterns miss, windows with a base span also come in two more forms,
drawn by their text: FORMS with the span written otherwise and labelled all the same (varied()),
and DECOYED with a number or name that is no personal data in its place, unlabelled (decoy()).  So a net is
trained wherever a window holds a base span.  The broadcast model has some ten thousand weights.

What the net marks is added if it can be of its kind: an e-mail has one `@` and no blanks; an ip is
four numbers of 255 at most with one and the same mark or bracketed dot between them; a card has 13
to 19 digits that pass Luhn's check; a phone has 8 to 15 digits and a mark between two of them.

Positions are code points, the end exclusive.  Null and empty texts have no spans.  Rows are
independent: ids may be null or repeated, other columns are ignored.  Without labelled
spans nothing is added.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import map_batches, prepare, stored

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 64, 32
HIDDEN = 20
STEPS, BATCH, RATE = 360, 64, 0.02
#: Other forms and decoys drawn of each base span.
FORMS, DECOYED = 10, 5
LEAST_CONFIDENCE = 0.8
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind

# The base patterns. A number's first digit follows no digit, which spares
# long runs of digits a second try from each of theirs and finds the same.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Each `@` with the name before it and the domain behind it; a name starts behind the last match."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            end = domain.end()
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """By kind as listed, then start."""
    if not text or not _TRIGGER.search(text):
        return []
    out = [("email", a, b) for a, b in emails(text)]
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    for kind, pattern, low, high in (("card", _CARD, 16, 19), ("phone", _PHONE, 8, 15)):
        for m in pattern.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if low <= len(digits) <= high and (kind != "card" or luhn(digits)):
                out.append((kind, m.start(), m.end()))
    return out


def _plausible(kind: str, said: str) -> bool:
    digits = _NOT_DIGIT.sub("", said)
    if kind == "email":
        name, at, host = said.partition("@")
        return bool(at) and len(name) > 1 and len(host) > 3 and "@" not in host and not re.search(r"\s", said)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and len(set(digits)) > 1
    if kind == "ip":
        parts, marks = _NOT_DIGIT.split(said), set(_NOT_DIGIT.findall(said))
        return len(parts) == 4 and len(marks) == 1 and len(marks.pop()) <= 3 and all(0 < len(p) <= 3 and int(p) <= 255 for p in parts)
    return 8 <= len(digits) <= 15 and bool(re.search(r"[\x20()./-]", said))


def _may_grow(kind: str, said: str) -> bool:
    """Whether a longer span around this piece can be plausible."""
    if kind == "email":
        return said.count("@") <= 1 and not re.search(r"\s", said)
    if kind == "ip":
        return len(_NOT_DIGIT.findall(said)) <= 4 and not re.search(r"[^0-9.()\[\]\x20_,-]", said)
    return len(_NOT_DIGIT.sub("", said)) <= (19 if kind == "card" else 15)


# Character classes: one each for marks that matter and ASCII small letters, then other letters, blanks and the rest.
_MARKS = "@.-+() _%,:;\"'/\n[]#=abcdefghijklmnopqrstuvwxyz"
CLASSES = len(_MARKS) + 5
_DIGIT, _CAPITAL, _WIDE, _OTHER, _PAD = range(len(_MARKS), CLASSES)
_AT = _MARKS.index("@")
_CLASS = np.full(129, _OTHER, np.uint8)
for _c in range(128):
    _s = chr(_c)
    _CLASS[_c] = _MARKS.index(_s) if _s in _MARKS else _DIGIT if _s.isdigit() else _CAPITAL if _s.isupper() else _OTHER
_CLASS[128] = _WIDE


def classes_of(text: str) -> np.ndarray:
    return _CLASS[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 128)]


def window_starts(classes: np.ndarray) -> np.ndarray:
    """Starts of the windows that can hold a span."""
    n = len(classes)
    starts = np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE)
    ends = np.minimum(starts + WINDOW, n)
    digits, ats = (np.concatenate([[0], np.cumsum(classes == c)]) for c in (_DIGIT, _AT))
    return starts[(digits[ends] - digits[starts] >= 4) | (ats[ends] > ats[starts])]


def windows_of(classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    padded = np.concatenate([classes, np.full(WINDOW, _PAD, np.uint8)])
    return padded[starts[:, None] + np.arange(WINDOW)]


def tags_of(n: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    out = np.zeros(n, np.uint8)
    for kind, a, b in reversed(spans):  # earlier kinds win
        k = 1 + 2 * KINDS.index(kind)
        out[a:b] = k + 1
        out[a] = k
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _logsum(x, axis):
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def _chain(e: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log sums over the tag sequences up to and from each step, and over all, of emissions e and transitions a."""
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0]
    for t in range(1, len(e)):
        alpha[t] = e[t] + _logsum(alpha[t - 1][:, :, None] + a, 1)
    for t in range(len(e) - 2, -1, -1):
        beta[t] = _logsum(a + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    return alpha, beta, _logsum(alpha[-1], 1)


class Net:
    """BiLSTM over character classes, linear emissions, CRF."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        h = HIDDEN
        self.p = {}
        for d in "fb":
            self.p["x" + d] = rng.normal(0, 0.3, (CLASSES, 4 * h))
            self.p["h" + d] = rng.normal(0, 0.3 / np.sqrt(h), (h, 4 * h))
            self.p["x" + d][:, h:2 * h] += 1.0  # forget gates start open
        self.p["out"] = rng.normal(0, 0.3, (2 * h, TAGS))
        self.p["bias"] = np.zeros(TAGS)
        self.p["trans"] = np.zeros((TAGS, TAGS))

    def _lstm(self, x: np.ndarray, d: str, keep: bool = True):
        """Hidden states [steps, rows, hidden] of time-major classes, with what the way back needs if `keep`."""
        h, wh, gates = HIDDEN, self.p["h" + d], self.p["x" + d][x]
        state, cell = np.zeros((x.shape[1], h)), np.zeros((x.shape[1], h))
        states, kept = [], []
        for z in gates:
            z = z + state @ wh
            s, g = _sigmoid(z[:, :3 * h]), np.tanh(z[:, 3 * h:])
            before, prior = cell, state
            cell = s[:, h:2 * h] * cell + s[:, :h] * g
            t = np.tanh(cell)
            state = s[:, 2 * h:] * t
            states.append(state)
            if keep:
                kept.append((s, g, t, before, prior))
        return np.stack(states), kept

    def _lstm_back(self, x: np.ndarray, d: str, kept, dstates: np.ndarray, grad: dict) -> None:
        h, wh = HIDDEN, self.p["h" + d]
        dzs, dh = np.empty((*x.shape, 4 * h)), np.zeros_like(wh)
        dstate, dcell = np.zeros(dstates.shape[1:]), np.zeros(dstates.shape[1:])
        for k in range(len(kept) - 1, -1, -1):
            s, g, t, before, prior = kept[k]
            i, f, o = s[:, :h], s[:, h:2 * h], s[:, 2 * h:]
            dstate = dstate + dstates[k]
            dcell = dcell + dstate * o * (1 - t * t)
            dz = np.concatenate([dcell * g * i * (1 - i), dcell * before * f * (1 - f), dstate * t * o * (1 - o), dcell * i * (1 - g * g)], axis=1)
            dzs[k] = dz
            dh += prior.T @ dz
            dstate, dcell = dz @ wh.T, dcell * f
        grad["x" + d], grad["h" + d] = np.eye(CLASSES)[x.ravel()].T @ dzs.reshape(-1, 4 * h), dh

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """[steps, rows, tags] of time-major classes."""
        forward, _ = self._lstm(x, "f", keep=False)
        back, _ = self._lstm(x[::-1], "b", keep=False)
        return np.concatenate([forward, back[::-1]], axis=2) @ self.p["out"] + self.p["bias"]

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of the tags y and its gradient; both time-major."""
        forward, kept_f = self._lstm(x, "f")
        back, kept_b = self._lstm(x[::-1], "b")
        both = np.concatenate([forward, back[::-1]], axis=2)
        e, a = both @ self.p["out"] + self.p["bias"], self.p["trans"]
        n, rows = e.shape[:2]
        alpha, beta, z = _chain(e, a)
        single = np.exp(alpha + beta - z[:, None])
        pair = np.zeros_like(a)
        for t in range(1, n):
            pair += np.exp(alpha[t - 1][:, :, None] + a + (e[t] + beta[t] - z[:, None])[:, None, :]).sum(0)
        r = np.arange(rows)
        gold = sum(e[t, r, y[t]] for t in range(n)) + sum(a[y[t - 1], y[t]] for t in range(1, n))
        de = single
        for t in range(n):
            de[t, r, y[t]] -= 1
        de /= rows
        np.subtract.at(pair, (y[:-1].ravel(), y[1:].ravel()), 1)
        grad = {"trans": pair / rows, "bias": de.sum((0, 1)), "out": np.tensordot(both, de, ((0, 1), (0, 1)))}
        dboth = de @ self.p["out"].T
        self._lstm_back(x, "f", kept_f, dboth[:, :, :HIDDEN], grad)
        self._lstm_back(x[::-1], "b", kept_b, dboth[::-1, :, HIDDEN:], grad)
        return float((z - gold).mean()), grad

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 6) -> Net:
        """Adam over rows of windows x and tags y."""
        rng = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        turn, total = 0, -(-STEPS // -(-len(x) // BATCH)) * -(-len(x) // BATCH)  # whole rounds
        while turn < total:
            order = rng.permutation(len(x))
            for lo in range(0, len(x), BATCH):
                rows = order[lo:lo + BATCH]
                _, grad = self.step(x[rows].T.astype(np.int64), y[rows].T.astype(np.int64))
                turn += 1
                norm = np.sqrt(sum((g * g).sum() for g in grad.values()))
                rate = RATE * (1 - turn / (total + 1)) * np.sqrt(1 - 0.999**turn) / (1 - 0.9**turn)
                for k, g in grad.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] -= rate * first[k] / (np.sqrt(second[k]) + 1e-8)
        return self

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tags and their shares (the chain's marginals; 1 in windows without a span), [rows, steps], of windows x."""
        e, a = self.emissions(x.T.astype(np.int64)), self.p["trans"]
        score, back = e[0], []
        for t in range(1, len(e)):
            reach = score[:, :, None] + a
            back.append(reach.argmax(1))
            score = reach.max(1) + e[t]
        tags = [score.argmax(1)]
        r = np.arange(len(x))
        for b in reversed(back):
            tags.append(b[r, tags[-1]])
        tags = np.stack(tags[::-1], axis=1)
        shares, some = np.ones(tags.shape), np.flatnonzero(tags.any(1))
        if len(some):
            alpha, beta, z = _chain(e[:, some], a)
            marginal = np.exp(alpha + beta - z[:, None])
            shares[some] = np.take_along_axis(marginal, tags[some].T[:, :, None], 2)[:, :, 0].T
        return tags, shares


def spans_in(tags: np.ndarray, shares: np.ndarray) -> list[tuple[str, int, int, float]]:
    out, start, kind = [], None, None
    for t, tag in enumerate([*tags.tolist(), 0]):
        k = (tag - 1) // 2 if tag else None
        if start is not None and (tag == 0 or tag % 2 == 1 or k != kind):
            out.append((KINDS[kind], start, t, float(shares[start:t].mean())))
            start = None
        if tag and start is None:
            start, kind = t, k
    return out


def reconciled(found: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int]]:
    """Spans of all windows of a text, as one set without overlaps."""
    votes: dict[tuple[str, int, int], list[float]] = {}
    for kind, a, b, share in found:
        votes.setdefault((kind, a, b), []).append(share)
    kept: list[tuple[str, int, int]] = []
    for span, shares in sorted(votes.items(), key=lambda v: (-len(v[1]), -max(v[1]), v[0][1] - v[0][2], v[0])):
        if max(shares) >= LEAST_CONFIDENCE and all(span[2] <= a or b <= span[1] for _, a, b in kept):
            kept.append(span)
    return sorted(kept, key=lambda s: s[1])


def joined(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches that overlap as one, by start."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(stretches):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def add_spans(net: Net | None, texts: list[str], base: list[list[tuple[str, int, int]]]) -> list[list[tuple[str, int, int]]]:
    """Base and added spans of each text, by kind as listed, then start."""
    if net is None:
        return base
    coded = {i: classes_of(t) for i, t in enumerate(texts) if t and _TRIGGER.search(t)}
    places = [(i, s) for i, c in coded.items() for s in window_starts(c).tolist()]
    found: dict[int, list] = {}
    cut: dict[int, list[tuple[int, int]]] = {}
    own = [np.array(sorted((a, b) for _, a, b in spans)).reshape(-1, 2) for spans in base]
    # ends of base spans so far, so that an overlap is found by bisection
    ends = [np.maximum.accumulate(o[:, 1]) if len(o) else o[:, 1] for o in own]

    def overlaps(i: int, a: int, b: int) -> bool:
        before = int(np.searchsorted(own[i][:, 0], b))
        return before > 0 and ends[i][before - 1] > a

    def take(part: list[tuple[int, int, int]], x: np.ndarray) -> None:
        """Spans of the stretches (text, start, stop) into `found`, stretches that cut one into `cut`."""
        tags, shares = net.decode(x)
        for row in np.flatnonzero(tags.any(1)).tolist():
            i, s, e = part[row]
            n = len(coded[i])
            for kind, a, b, share in spans_in(tags[row], shares[row]):
                if (a > 0 or s == 0) and (b < e - s or e >= n):
                    if s + b <= n:
                        found.setdefault(i, []).append((kind, s + a, s + b, share))
                elif not overlaps(i, s + a, min(s + b, n)) and _may_grow(kind, texts[i][s + a:s + b]):
                    cut.setdefault(i, []).append((s, min(e, n)))

    for lo in range(0, len(places), 2048):
        part = places[lo:lo + 2048]
        take([(i, s, s + WINDOW) for i, s in part], np.concatenate([windows_of(coded[i], np.array([s])) for i, s in part]))
    more = STRIDE
    while cut:
        wide: dict[int, list[tuple[int, int, int]]] = {}  # by length
        for i, stretches in cut.items():
            for s, e in joined([(max(0, s - more), min(len(coded[i]), e + more)) for s, e in stretches]):
                wide.setdefault(e - s, []).append((i, s, e))
        cut.clear()
        for size, part in wide.items():
            rows = max(1, 2048 * WINDOW // size)
            for lo in range(0, len(part), rows):
                take(part[lo:lo + rows], np.stack([coded[i][s:e] for i, s, e in part[lo:lo + rows]]))
        more *= 2
    out = list(base)
    for i, spans in found.items():
        new = [x for x in reconciled(spans) if all(x[2] <= a or b <= x[1] for _, a, b in base[i]) and _plausible(x[0], texts[i][x[1]:x[2]])]
        if new:
            out[i] = sorted(base[i] + new, key=lambda x: (KINDS.index(x[0]), x[1]))
    return out


# Ways to write a kind that its base pattern does not cover; # is a digit.
PHONES = ("(###) ###-####", "###.###.####", "###-###-####", "0## #######", "0### ######", "### ### ####", "###/#######", "(0##) ### ## ##", "00## ### ######")
CARDS = ("####.####.####.####", "####  ####  ####  ####", "####_####_####_####", "#### ###### #####", "####-######-#####")
IP_MARKS = ("[.]", "(.)", " . ", "-", "_")
TOPS = ("com", "org", "net", "de", "fr", "es", "io", "co.uk")
WIDE_LETTERS = "äöüéèñçøåłžßï"
# Numbers and names that are none of the kinds.
DECOYS = ("20##-##-##", "##.##.20##", "20##-20##", "##:##:##", "20##-##-## ##:##", "#,###,###.##", "####.##", "########", "#.##.#", "###-##", "19##/20##", "# ### ###", "##/##/####")
AT_DECOYS = ("@{0}", "{0} @ #.##", "{0}@", "@ {0}", "# @ ##")


def _digits(form: str, rng: random.Random) -> str:
    return "".join(str(rng.randrange(10)) if c == "#" else c for c in form)


def varied(kind: str, said: str, words: list[str], rng: random.Random) -> str:
    """A base span written otherwise; names and hosts also from `words`."""
    if kind == "phone":
        return _digits(rng.choice(PHONES), rng)
    if kind == "card":
        return _digits(rng.choice(CARDS), rng)
    if kind == "ip":
        return rng.choice(IP_MARKS).join(said.split("."))
    name, _, host = said.partition("@")
    word = lambda: rng.choice(words)
    name = rng.choice((name, word(), f"{word()}.{word()}", f"{word()}_{rng.randrange(100)}"))
    host = rng.choice((host, f"{word()}.{rng.choice(TOPS)}", f"{word()}.{rng.choice(TOPS)}", word()))
    parts = [name, host]
    for k in range(2):
        if rng.random() < 0.5:
            at = rng.randrange(len(parts[k]))
            parts[k] = parts[k][:at] + rng.choice(WIDE_LETTERS) + parts[k][at + 1:]
    return "@".join(parts)


def decoy(kind: str, words: list[str], rng: random.Random) -> str:
    """Something that is no personal data, to stand in a base span's place."""
    if kind == "email" and rng.random() < 0.7:
        return _digits(rng.choice(AT_DECOYS).format(rng.choice(words)), rng)
    return _digits(rng.choice(DECOYS), rng)


#: Windows kept of each stratum: of each kind, without a label, of each kind written otherwise, with a decoy.
STRATA = [120] * len(KINDS) + [500] + [200] * len(KINDS) + [400]
SAMPLE_WINDOWS = sum(STRATA)


def labelled_windows(text: str) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(stratum, hash, classes, tags) of each window, once for each kind that it holds, and of its other forms."""
    classes = classes_of(text)
    starts = window_starts(classes)
    if not len(starts):
        return
    base = base_spans(text)
    own = tags_of(len(text), base)
    tags = np.concatenate([own, np.zeros(WINDOW, np.uint8)])
    for s, x in zip(starts.tolist(), windows_of(classes, starts), strict=True):
        y = tags[s:s + WINDOW]
        h = int.from_bytes(hashlib.blake2b(text[s:s + WINDOW].encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)
        for k in {(t - 1) // 2 for t in set(y.tolist()) if t} or {len(KINDS)}:
            yield k, h, x.tobytes(), y.tobytes()
    for kind, a, b in base:
        around = text[max(0, a - WINDOW):a], text[b:b + WINDOW]
        rng, k = random.Random("\0".join((kind, around[0], text[a:b], around[1]))), KINDS.index(kind)
        words = re.findall(r"\w{3,12}", around[0] + " " + around[1]) or ["name"]
        forms = [(len(KINDS) + 1 + k, varied(kind, text[a:b], words, rng), True) for _ in range(FORMS)]
        forms += [(len(STRATA) - 1, decoy(kind, words, rng), False) for _ in range(DECOYED)]
        for stratum, said, label in forms:
            middle = np.zeros(len(said), np.uint8)
            if label:
                middle[:] = 2 + 2 * k
                middle[0] = 1 + 2 * k
            # cut at random on both sides: spans stand anywhere in a window, and texts may be short
            left, right = rng.randrange(len(around[0]) + 1), rng.randrange(len(around[1]) + 1)
            x = np.concatenate([classes_of(around[0][len(around[0]) - left:] + said + around[1][:right]), np.full(WINDOW, _PAD, np.uint8)])[:WINDOW]
            y = np.concatenate([own[a - left:a], middle, own[b:b + right], np.zeros(WINDOW, np.uint8)])[:WINDOW]
            yield stratum, rng.getrandbits(63), x.tobytes(), y.tobytes()


def fit(docs: DataFrame) -> Net | None:
    """A net trained on the base spans of a bounded sample of windows; None without any span."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The windows of a partition with the smallest hashes of each stratum."""
        held, most = [set() for _ in STRATA], [2**63] * len(STRATA)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for k, *row in labelled_windows(text):
                    if row[0] <= most[k]:
                        held[k].add(tuple(row))
                        if len(held[k]) >= 4 * STRATA[k]:
                            held[k] = set(sorted(held[k])[:STRATA[k]])
                            most[k] = max(held[k])[0]
        rows = [(k, *r) for k, own in enumerate(held) for r in sorted(own)[:STRATA[k]]]
        if rows:
            k, h, x, y = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(h, pa.int64()), pa.array(x, pa.binary()), pa.array(y, pa.binary())], names=["k", "h", "x", "y"])

    texts = docs.select("text").where(F.col("text").rlike("[0-9@]"))
    few = stored(texts.mapInArrow(run, "k int, h long, x binary, y binary"), "pii-windows").distinct()
    found = [r for k, n in enumerate(STRATA) for r in few.where(F.col("k") == k).orderBy("h", "x", "y").limit(n).collect()]
    found = sorted({(r["h"], bytes(r["x"]), bytes(r["y"])) for r in found})
    if not found:
        return None
    x, y = (np.stack([np.frombuffer(r[k], np.uint8) for r in found]) for k in (1, 2))
    return Net().train(x, y) if y.any() else None


def scan(docs: DataFrame, digests: bool = False) -> DataFrame:
    """doc_id and spans (kind, start, stop) of each row; with `digests`, the counts and names instead."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(fit(docs))
    named = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        base = [base_spans(t) for t in texts]
        spans = add_spans(shared.value, texts, base)
        ids = batch.column(0).cast(pa.int64())
        if not digests:
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
            return pa.RecordBatch.from_arrays([ids, pa.array([[{"kind": k, "start": a, "stop": b} for k, a, b in s] for s in spans], kind)], names=["doc_id", "spans"])
        counts = [pa.array([sum(k == kind for k, _, _ in s) for s in base], pa.int64()) for kind in KINDS]
        texts_ = [pa.array([hashlib.sha256(named(s).encode()).hexdigest() for s in base]), pa.array([named(s) for s in spans])]
        return pa.RecordBatch.from_arrays([ids, *counts, *texts_], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    schema = ("doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string" if digests
              else "doc_id long, spans array<struct<kind:string,start:int,stop:int>>")
    return map_batches(docs.select("doc_id", "text"), run, schema)
