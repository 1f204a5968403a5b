"""Brute-force versions of the contracts, in plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import xxhash

SPACE = re.compile("[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


# --- op3
def decontaminate(docs, items, window=13):
    known = defaultdict(set)
    for i, text in items:
        w = ALNUM.findall(lower(text))
        n = min(window, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            known[tuple(w[a:a + n])].add("" if i is None else str(i))
    sizes = {len(k) for k in known}
    out = []
    for d, text in docs:
        w, hit, found = ALNUM.findall(lower(text)), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in known:
                    hit.update(range(a, a + n))
                    found |= known[tuple(w[a:a + n])]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w)))
    return out


# --- op4
KINDS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def pii(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    valid = {"email": lambda m: True, "ip": lambda m: all(int(x) <= 255 for x in m.split(".")),
             "card": lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m)), "phone": lambda m: 10 <= len(digits(m)) <= 15}
    spans = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(KINDS)
             for m in re.finditer(p, text or "") if valid[kind](m[0])]
    return [(kind, a, b) for a, _, b, kind in sorted(spans)]


# --- op6
def substring(docs, window=20):
    """docs: distinct (doc_id, text)."""
    first, out = {}, {}
    for d, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        w, gone = SPACE.findall(text or ""), set()
        for a in range(len(w) - window + 1):
            if tuple(w[a:a + window]) in first:
                gone.update(range(a, a + window))
            first.setdefault(tuple(w[a:a + window]), (d, a))
        out[d, text] = (d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


# --- op7
def statistics(text):
    text = text or ""
    w = SPACE.findall(text)
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    n = Counter(tuple(w[a:a + 3]) for a in range(len(w) - 2))
    cover = {a + k for a in range(len(w) - 2) if n[tuple(w[a:a + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover),
            len(w) < 50 or 100 * len(cover) > 50 * len(w))


# --- op8
def site(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = lower(host)
    best = None
    for verdict, rule in rules:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (not best or len(rule) > len(best[1])):
            best = verdict, rule
    return host, path, best


# --- op9
def kneser_ney(docs, fit_discounts):
    """docs: (doc_id, text). Rows doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    tokens = [(d, SPACE.findall(lower(t)) + ["\0end"]) for d, t in docs]
    words, pairs = Counter(), Counter()
    for d, w in tokens:
        if fold(d, 10):
            words.update(w)
            pairs.update(zip(["\0start", *w], w))
    total, v = sum(words.values()), len(words)
    context, before = defaultdict(lambda: [0, 0, 0, 0]), Counter()
    for (h, w), n in pairs.items():
        context[h][0] += n
        context[h][min(n, 3)] += 1
        before[w] += 1
    of = lambda c: fit_discounts([sum(x == k for x in c.values()) for k in (1, 2, 3, 4)])
    d2, d1, distinct = of(pairs), of(before), len(pairs)
    back = sum(d1[min(x, 3)] for x in before.values()) / distinct if distinct else 1.0

    def lower_order(w):
        n = before.get(w, 0)
        return (n - d1[min(n, 3)]) / max(distinct, 1) + back / (v + 1)

    def p(h, w):
        if h not in context:
            return lower_order(w)
        c, n = context[h], pairs.get((h, w), 0)
        return (n - d2[min(n, 3)]) / c[0] + sum(d2[k] * c[k] for k in (1, 2, 3)) / c[0] * lower_order(w)

    return [(d, fold(d, 10) == 0, len(w), sum(x in words for x in w), total,
             sum(math.log10((words.get(x, 0) + 0.1) / (total + 0.1 * (v + 1))) for x in w),
             sum(math.log10(p(h, x)) for h, x in zip(["\0start", *w], w))) for d, w in tokens]


# --- op5
def graded_features(text):
    """{word, (word, word) or number of a shape feature: value}."""
    raw = SPACE.findall(text or "")
    words = [lower(x) for x in raw]
    counts = Counter(words) + Counter(zip(words, words[1:]))
    norm = math.sqrt(sum(counts.values()))
    out = {k: math.sqrt(n) / norm for k, n in counts.items()}
    data = "".join(raw).encode()
    symbols = sum(chr(b) in "!\"#$%&'()*+,-./:;<=>?@" for b in data)
    capitals = sum(0x41 <= b <= 0x5A for b in data)
    if words:
        out |= dict(enumerate([math.log1p(len(words)) / 5, 1 - len(set(words)) / len(words), math.sqrt(symbols / len(data)),
                               math.sqrt(capitals / len(data)), len(data) / len(words) / 10]))
    return out


def ordinal_model(rows, grades, rounds, rate, shrink):
    """rows: (grade's number, text) in the order of training, in one part. The weights and thresholds."""
    n = [sum(g <= k for g, _ in rows) / len(rows) for k in range(grades - 1)]
    w, t = defaultdict(float), [math.log(x / (1 - x)) for x in n]
    f = lambda x: 1 / (1 + math.exp(-x))
    for i in range(rounds):
        at = rate / (i + 1)
        sq_w, sq_t = defaultdict(lambda: 1e-2), [1e-2] * len(t)
        for g, text in rows:
            x = {k: float(np.float32(v)) for k, v in graded_features(text).items()}
            s = sum(v * w[k] for k, v in x.items())
            up, lo = f(t[g] - s) if g < len(t) else 1.0, f(t[g - 1] - s) if g else 0.0
            of_s = (up * (1 - up) - lo * (1 - lo)) / (up - lo)  # slope of -log(up - lo) in s
            for k, v in x.items():
                d = of_s * v + shrink * w[k]
                sq_w[k] += d * d
                w[k] -= at * d / math.sqrt(sq_w[k])
            for k, d in ((g, -up * (1 - up) / (up - lo)), (g - 1, lo * (1 - lo) / (up - lo))):
                if 0 <= k < len(t):
                    sq_t[k] += d * d
                    t[k] -= at * d / math.sqrt(sq_t[k])
            t = [max(t[:k + 1]) for k in range(len(t))]
    return w, t


def ordinal_grades(text, w, t, wanted):
    """Expected grade and P(grade >= wanted), of grades 0, 1, ..."""
    s = sum(v * w.get(k, 0.0) for k, v in graded_features(text).items())
    upto = [0.0, *(1 / (1 + math.exp(s - x)) for x in t), 1.0]
    p = [b - a for a, b in zip(upto, upto[1:])]
    return sum(k * x for k, x in enumerate(p)), sum(p[wanted:])


# --- op10
def fingerprint(text, shingle=3):
    w = SPACE.findall(lower(text))
    parts = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(docs, distance=2):
    prints = [fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(docs[i][0])
    least = {g: None if None in ids else min(ids) for g, ids in groups.items()}
    return [(d, f"{f:016x}", least[find(i)]) for i, ((d, _), f) in enumerate(zip(docs, prints))]


# --- op11, op12
def vectors(rows, scale):
    """(vec_id, label) -> whole components, of the rows that take part; of rows that share an id the least."""
    out = {}
    for i, x, label in rows:
        if i is None or x is None or label is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        row = (label, [math.floor(scale * c) for c in x])
        out[i] = min(out.get(i, row), row)
    return out


def _dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def top_k(rows, asked, k, scale):
    v, out = vectors(rows, scale), []
    for q in filter(asked, v):
        best = sorted((-_dot(v[q][1], v[i][1]), i) for i in v if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return out


def hard_negatives(rows, asked, positives=5, negatives=10, low=30, high=90, scale=256):
    v, out = vectors(rows, scale), []
    for a in filter(asked, v):
        label = v[a][0]
        scored = sorted((-_dot(v[a][1], v[i][1]), i) for i in v if i != a)
        for p, i in [x for x in scored if v[x[1]][0] == label][:positives]:
            fits = [(s, j) for s, j in scored if v[j][0] != label and low * -p <= 100 * -s <= high * -p][:negatives]
            out += [(a, i, n, j, -p, -s) for n, (s, j) in enumerate(fits, 1)]
    return out


# --- op13
def runs(words, min_length=24, min_exponent=3):
    """(start, length, period), by start and period: for every period the stretches that can't be longer."""
    found, n = {}, len(words)
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i > s and i + q - s >= max(min_length, min_exponent * q):
                found.setdefault((s, i + q), q)
            i += i == s
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def op13(docs):
    out = []
    for d, text in docs:
        words = SPACE.findall(text or "")
        n, h = len(words), zlib.crc32(("" if d is None else str(d)).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        found = runs(words)
        top = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        out.append((d, len(found), *top, 1000 * top[1] // top[2] if found else None, sha(lines), sha(collapsed(words, found))))
    return out
