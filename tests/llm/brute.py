"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    at = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = set()
    for i in range(len(w) - 2):
        if at[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), failed)


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def digits(s):
    return "".join(c for c in s if c in "0123456789")


PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m.group())) <= 15),
)
SECRETS = (
    ("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
     lambda m: len(m.group(2)) >= 8),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16),
    ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 32),
)


def found(text, kinds):
    return [(k, m.start(), m.end()) for k, p, ok in kinds for m in re.finditer(p, text or "") if ok(m)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def pii(text):
    spans = found(text, PII)
    n = Counter(k for k, _, _ in spans)
    return (*(n[k] for k, _, _ in PII), digest(spans))


def secrets(text):
    order = [k for k, _, _ in SECRETS]
    spans = sorted(found(text, SECRETS), key=lambda s: (s[1], order.index(s[0])))
    n = Counter(k for k, _, _ in spans)
    return (*(n[k] for k in order), digest(spans))


def fingerprint(text, shingle=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash(rows, shingle=4, bits=4):
    """{(doc_id, fingerprint, component)} sorted, by comparing all pairs."""
    fps = [(d, fingerprint(t, shingle)) for d, t in rows]
    distinct = sorted({f for _, f in fps})
    up = {f: f for f in distinct}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                up[top(a)] = top(b)
    low = {}
    for d, f in fps:
        if d is not None:
            low[top(f)] = min(d, low.get(top(f), d))
    return sorted(((d, f"{f:016x}", low.get(top(f))) for d, f in fps), key=repr)


def repeats(texts, length=400):
    """Per text (bytes): (n_bytes, n_removed, n_spans, sha256 of what is left)."""
    at = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        end = 0
        for i in range(len(t) - length + 1):
            if at[t[i:i + length]] > 1:
                for k in range(max(i, end), i + length):
                    gone[k] = 1
                end = i + length
        left = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


def shingles(text, shingle=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set())


def jaccard(rows, shingle=4, percent=85):
    """{(doc_id, n_shingles, component)} sorted, by comparing all pairs."""
    sets = [shingles(t, shingle) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                up[top(a)] = top(b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[top(i)] = min(d, low.get(top(i), d))
    return sorted(((d, len(sets[i]), low.get(top(i))) for i, (d, _) in enumerate(rows)), key=repr)


def crc(text):
    return zlib.crc32((text or "").encode())
