"""Plain-Python versions of the operators' contracts, for small tables."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def simhash(t):
    w = WORD.findall(low(t))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(values, linked):
    """Class number of each value under the closure of ``linked``."""
    label = list(range(len(values)))
    for i, j in itertools.combinations(range(len(values)), 2):
        if linked(values[i], values[j]) and label[i] != label[j]:
            a, b = sorted((label[i], label[j]))
            label = [a if x == b else x for x in label]
    return label


def near_duplicates(rows):
    prints = [simhash(t) for _, t in rows]
    distinct = sorted(set(prints))
    label = dict(zip(distinct, classes(distinct, lambda a, b: (a ^ b).bit_count() <= 2), strict=True))
    least = {}
    for (d, _), p in zip(rows, prints, strict=True):
        if d is not None:
            least[label[p]] = min(d, least.get(label[p], d))
    return [(d, f"{p:016x}", least.get(label[p])) for (d, _), p in zip(rows, prints, strict=True)]


def quality_base(t):
    t = t or ""
    w, seen, dup = WORD.findall(t), set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k + j for k in range(len(w) - 2) if n[w[k], w[k + 1], w[k + 2]] > 1 for j in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), failed


def unigram_scores(rows):
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    text = [[*WORD.findall(low(t)), None] for _, t in rows]
    c = collections.Counter(x for (d, _), w in zip(rows, text, strict=True) if not held(d) for x in w)
    n, v = sum(c.values()), len(c)
    return [(d, held(d), len(w), sum(c[x] > 0 for x in w), n,
             sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)) for (d, _), w in zip(rows, text, strict=True)]


def secret_base(t):
    t = t or ""
    key = "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token")) \
        + "|[aA][pP][iI]_?[kK][eE][yY]"
    found = [("assign", m) for m in re.finditer(rf"({key})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t)
             if len(m[2]) >= 12]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    order = ("assign", "access", "hex")
    spans = sorted(((m.start(), order.index(k), k, m.end()) for k, m in found))
    return [f"{k}:{s}:{e}" for s, _, k, e in spans]


def license_base(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    hits = [(k, label) for p, label in phrases.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
    at = [k for k, _ in hits]
    return len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def without_repeats(rows, span=50):
    least = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - span + 1):
            if d is not None:
                least[b[i:i + span]] = min(d, least.get(b[i:i + span], d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - span + 1):
            f = least.get(b[i:i + span])
            if f is not None and (d is None or f < d):
                gone[i:i + span] = [True] * span
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    return out


def edits_in(pattern, text):
    """Fewest edits between the pattern and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern):
        new = [i + 1]
        for j, c in enumerate(text):
            new.append(min(row[j] + (p != c), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)
