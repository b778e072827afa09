"""Exact removal of repeated byte strings by deep-shallow suffix sorting.

A byte goes when a string of ``SPAN`` bytes that covers it also starts in a
document with a smaller doc_id.  Sorting every suffix of a corpus would move
many times its size, so the suffixes that can have a partner are found first:

1. Anchors.  Of the 16-byte grams inside a window of SPAN bytes, the one with
   the smallest hash (all, if tied) is an anchor.  It depends on the window's
   bytes alone, so equal windows have equal anchors at equal offsets.  Texts are
   dealt into chunks; each chunk sends its distinct anchor grams, packed, to
   hash buckets, which answer with a bit each: also elsewhere?
2. Contexts.  For anchors that occur elsewhere too, a chunk sends the bytes
   around the anchor that its windows cover, once for each distinct context,
   with the smallest doc_id.  A bucket holds all contexts of a gram.  Equal
   contexts share all windows; windows shared by unequal contexts are put in
   order by deep-shallow sorting: multikey quicksort on 8-byte characters to a
   shallow depth, then blind tries for the groups that still agree.  Runs of
   equal strings get their smallest doc_id.
3. Each chunk marks the windows whose string starts in a smaller document.

Anchors that occur very often (``HOT``) would gather too many contexts in one
bucket; for them each window is sent by itself, under its own hash, which
spreads them and gives the same answer.

All hashes only bring strings together; equality is always decided on bytes.

Defined results: null text is the empty text; texts shorter than SPAN lose
nothing.  A null doc_id counts as larger than any other.  Rows with equal
doc_id do not remove each other's bytes.  Repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text

SPAN, GRAM = 50, 16
REACH = SPAN - GRAM  # bytes of a window before, or after, its anchor gram
WIDTH = REACH + SPAN  # of a context
ROW = WIDTH + 4  # a context, its two lengths, and zeros up to whole 8-byte words
HALF = (REACH + 1) // 2
CHUNK_BYTES = 6 << 20
HOT = 50_000
SHALLOW = 16
NO_ID = np.int64(2 ** 63 - 1)

_A, _B, _C, _D, _E = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)
# Odd weights of a context's columns.
_WEIGHTS = np.array([int.from_bytes(hashlib.blake2b(bytes([k]), digest_size=8).digest(), "little") | 1
                     for k in range(WIDTH)], np.uint64)


# -- deep-shallow sorting ---------------------------------------------------

def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> list[list[int]]:
    """Indices of the strings (all of one length) in sorted order, equal
    strings in one list."""
    out: list[list[int]] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) == 1:
            out.append(group)
        elif depth >= shallow:
            out.extend(blind_trie(strings, group, depth))
        elif group:
            keys = [strings[k][depth:depth + 8] for k in group]
            if keys.count(keys[0]) == len(keys):
                stack.append((group, depth + 8))
                continue
            pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
            less = [k for k, c in zip(group, keys, strict=True) if c < pivot]
            same = [k for k, c in zip(group, keys, strict=True) if c == pivot]
            more = [k for k, c in zip(group, keys, strict=True) if c > pivot]
            stack += [(more, depth), (same, depth + 8), (less, depth)]
    return out


def blind_trie(strings: list[bytes], group: list[int], depth: int) -> list[list[int]]:
    """Order of strings that agree up to ``depth``: a binary trie that stores
    only the bit at which its branches part.  A string goes down by those bits
    alone, is compared once with the leaf it reaches, and is put in where the
    first differing bit says."""
    number = int.from_bytes
    root = (number(strings[group[0]][depth:], "big"), [group[0]])
    for k in group[1:]:
        x = number(strings[k][depth:], "big")
        node = root
        while len(node) == 3:
            node = node[1 + (x >> node[0] & 1)]
        differ = x ^ node[0]
        if not differ:
            node[1].append(k)
            continue
        bit = differ.bit_length() - 1
        above, node = None, root
        while len(node) == 3 and node[0] > bit:
            above, side = node, 1 + (x >> node[0] & 1)
            node = node[side]
        leaf = (x, [k])
        new = [bit, node, leaf] if x >> bit & 1 else [bit, leaf, node]
        if above is None:
            root = new
        else:
            above[side] = new
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if len(node) == 3:
            stack += [node[2], node[1]]
        else:
            out.append(node[1])
    return out


# -- anchors and contexts of a chunk ----------------------------------------

def sliding(a: np.ndarray, width: int, pick) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        a = pick(a[:-size], a[size:])
        size *= 2
    return pick(a[:len(a) - (width - size)], a[width - size:]) if size < width else a


def anchors(data: np.ndarray) -> np.ndarray:
    """Positions of the anchors of one text of SPAN bytes or more."""
    b = data.astype(np.uint32)
    x = b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24)
    n = len(data) - GRAM + 1
    h = x[:n] * _A + x[4:n + 4] * _B + x[8:n + 8] * _C + x[12:n + 12] * _D
    h ^= h >> np.uint32(15)
    h *= _E
    h ^= h >> np.uint32(13)
    low = sliding(h, REACH + 1, np.minimum)
    # A gram is an anchor if it has the smallest hash of some window over it.
    edge = np.zeros(REACH, np.uint32)
    most = sliding(np.concatenate([edge, low, edge]), REACH + 1, np.maximum)
    return np.flatnonzero(h == most)


class Chunk:
    """The anchors of some documents."""

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id")
        self.docs = np.array([NO_ID if v is None else v for v in ids.to_pylist()], np.int64)
        self.ids = ids
        self.texts = [t or b"" for t in table.column("data").to_pylist()]
        at, doc, base = [], [], REACH
        starts = []
        for k, t in enumerate(self.texts):
            starts.append(base)
            if len(t) >= SPAN:
                p = anchors(np.frombuffer(t, np.uint8))
                at.append(p + base)
                doc.append(np.full(len(p), k, np.int32))
            base += len(t) + WIDTH
        gap = bytes(WIDTH)
        self.data = np.frombuffer(bytes(REACH) + gap.join(self.texts) + gap, np.uint8)
        self.at = np.concatenate(at) if at else np.empty(0, np.int64)
        self.doc = np.concatenate(doc) if doc else np.empty(0, np.int32)
        self.start = np.array(starts, np.int64)
        self.length = np.array([len(t) for t in self.texts], np.int64)
        h = np.zeros(len(self.at), np.uint64)
        for word in range(0, GRAM, 8):
            w = np.zeros(len(self.at), np.uint64)
            for k in range(8):
                w |= self.data[self.at + word + k].astype(np.uint64) << np.uint64(8 * k)
            h = (h ^ w) * _MIX
            h ^= h >> np.uint64(29)
        self.gram = h * _MIX2

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct grams in order, how often each occurs, and whether in more
        than one document."""
        order = np.argsort(self.gram, kind="stable")
        g, d = self.gram[order], self.docs[self.doc[order]] if len(order) else np.empty(0, np.int64)
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.empty(0, np.int64)
        if not len(g):
            return g, np.empty(0, np.int64), np.empty(0, bool)
        times = np.diff(np.concatenate([first, [len(g)]]))
        several = np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first)
        return g[first], times, several

    def records(self, shared: np.ndarray, hot: np.ndarray) -> dict[str, np.ndarray]:
        """What is sent for the anchors with these grams (both sorted): the key,
        the context with its two lengths, the document, and the first and last
        window start that the record speaks for."""
        pick = member(self.gram, shared)
        at, doc, gram = self.at[pick], self.doc[pick], self.gram[pick]
        begin, end = self.start[doc], self.start[doc] + self.length[doc]
        left = np.minimum(REACH, at - begin)
        right = np.minimum(SPAN, end - at)
        is_hot = member(gram, hot)
        c = np.flatnonzero(~is_hot)
        columns = np.arange(-REACH, SPAN)
        rows = [context_rows(self.data, at[c], left[c], right[c], columns)]
        keys, docs = [gram[c]], [doc[c]]
        first, last = [at[c] - left[c] - begin[c]], [np.minimum(at[c], end[c] - SPAN) - begin[c]]
        for offset in range(REACH + 1) if is_hot.any() else ():
            w = np.flatnonzero(is_hot & (offset <= left) & (SPAN - offset <= right))
            start = at[w] - offset
            zero = np.zeros(len(w), np.int64)
            r = context_rows(self.data, start, zero, zero + SPAN, columns)
            rows.append(r)
            keys.append(hash_rows(r))
            docs.append(doc[w])
            first.append(start - begin[w])
            last.append(start - begin[w])
        return {"key": np.concatenate(keys), "row": np.concatenate(rows), "doc": np.concatenate(docs),
                "first": np.concatenate(first), "last": np.concatenate(last)}


def member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def context_rows(data, at, left, right, columns) -> np.ndarray:
    rows = np.zeros((len(at), ROW), np.uint8)
    for a in range(0, len(at), 1 << 16):
        part = slice(a, a + (1 << 16))
        place = at[part, None] + columns
        inside = (columns >= -left[part, None]) & (columns < right[part, None])
        rows[part, :WIDTH] = np.where(inside, data[np.where(inside, place, 0)], 0)
    rows[:, WIDTH], rows[:, WIDTH + 1] = left, right
    return rows


def hash_rows(rows: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(rows).view("<u8")
    h = np.zeros(len(rows), np.uint64)
    for k in range(ROW // 8):
        h = (h ^ words[:, k]) * _MIX
        h ^= h >> np.uint64(29)
    return h * _MIX2


def grouped(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group of each record, first record of each group): equal key and bytes.
    Groups are numbered by (key, bytes), so that equal input gives equal
    numbers in any order of records."""
    if not len(key):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    whole = hash_rows(row)
    order = np.lexsort((whole, key))
    k, w, r = key[order], whole[order], row[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (w[1:] != w[:-1])])
    if not (new[1:] | (r[1:] == r[:-1]).all(1)).all():
        # Unequal bytes under one hash: order by the bytes themselves.
        order = np.lexsort((*row.T[::-1], whole, key))
        k, w, r = key[order], whole[order], row[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (r[1:] != r[:-1]).any(1)])
    group = np.empty(len(key), np.int64)
    group[order] = np.cumsum(new) - 1
    return group, order[np.flatnonzero(new)]


# -- the steps --------------------------------------------------------------

def ask(buckets: int):
    """Step 1 in a chunk: distinct grams by bucket."""
    def run(table: pa.Table) -> pa.Table:
        grams, times, several = Chunk(table).distinct()
        bucket = (grams % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.flatnonzero(np.diff(bucket[order])) + 1
        out = [(int(bucket[p[0]]), pack40(grams[p]),
                (np.minimum(times[p], 127) | several[p] * 128).astype(np.uint8).tobytes())
               for p in np.split(order, cut) if len(p)]
        chunk = table.column("chunk")[0].as_py()
        return pa.table({"chunk": pa.array([chunk] * len(out), pa.int32()),
                         "bucket": pa.array([o[0] for o in out], pa.int32()),
                         "grams": pa.array([o[1] for o in out], pa.binary()),
                         "times": pa.array([o[2] for o in out], pa.binary())})
    return run


def pack40(grams: np.ndarray) -> bytes:
    """The upper 40 bits: enough to tell most grams of a bucket apart; two that
    fall together are only looked at once more than needed."""
    return grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()


def unpack40(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 5, 8), np.uint8)
    wide[:, 3:] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def answer(hot: int):
    """Step 1 in a bucket: bit 0 of each gram: also elsewhere; bit 1: hot."""
    def run(table: pa.Table) -> pa.Table:
        grams = [unpack40(g) for g in table.column("grams").to_pylist()]
        times = [np.frombuffer(t, np.uint8) for t in table.column("times").to_pylist()]
        every, count = np.concatenate(grams), np.concatenate(times)
        distinct, which, rows = np.unique(every, return_inverse=True, return_counts=True)
        total = np.bincount(which, count & 127)
        several = np.bincount(which, count >> 7)
        state = (((rows > 1) | (several > 0)) + 2 * (total > hot)).astype(np.uint8)[which]
        parts = np.split(state, np.cumsum([len(g) for g in grams])[:-1])
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                         "state": pa.array([p.tobytes() for p in parts], pa.binary())})
    return run


def tell(buckets: int):
    """Step 2 in a chunk: contexts of the grams that occur elsewhere."""
    def run(table: pa.Table, states: pa.Table) -> pa.Table:
        chunk = Chunk(table) if table.num_rows else None
        schema = {"chunk": pa.int32(), "bucket": pa.int32(), "keys": pa.binary(), "docs": pa.binary(),
                  "rows": pa.binary(), "hot": pa.binary()}
        out = []
        if chunk is not None and states.num_rows:
            grams, _, _ = chunk.distinct()
            bucket = (grams % np.uint64(buckets)).astype(np.int64)
            state = np.zeros(len(grams), np.uint8)
            for b, s in zip(states.column("bucket").to_pylist(), states.column("state").to_pylist(), strict=True):
                state[bucket == b] = np.frombuffer(s, np.uint8)
            hot = grams[state == 3]
            rec = chunk.records(grams[state & 1 > 0], hot)
            group, first = grouped(rec["key"], rec["row"])
            if len(first):
                low = np.full(len(first), NO_ID)
                np.minimum.at(low, group, chunk.docs[rec["doc"]])
                key, row = rec["key"][first], rec["row"][first]
                to = (key % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                number = table.column("chunk")[0].as_py()
                press = zstandard.ZstdCompressor(level=3)
                for p in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
                    out.append((number, int(to[p[0]]), key[p].tobytes(), low[p].tobytes(),
                                press.compress(row[p].tobytes()), b"" if out else hot.tobytes()))
        return pa.table({n: pa.array([o[k] for o in out], t) for k, (n, t) in enumerate(schema.items())})
    return run


def settle(table: pa.Table) -> pa.Table:
    """Step 2 in a bucket: smallest doc_id of every context, and of single
    windows that it shares with other contexts."""
    open_ = zstandard.ZstdDecompressor()
    keys = [np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist()]
    rows = np.concatenate([np.frombuffer(open_.decompress(r), np.uint8).reshape(-1, ROW)
                           for r in table.column("rows").to_pylist()])
    docs = np.concatenate([np.frombuffer(d, np.int64) for d in table.column("docs").to_pylist()])
    key = np.concatenate(keys)
    group, first = grouped(key, rows)
    low = np.full(len(first), NO_ID)
    np.minimum.at(low, group, docs)
    which, offset, doc = shared_windows(key[first], rows[first], low)
    # Answers go back in the order in which each chunk asked.
    sizes = np.cumsum([len(k) for k in keys])[:-1]
    answers = np.split(low[group], sizes)
    order = np.argsort(which, kind="stable")
    which, offset, doc = which[order], offset[order], doc[order]
    extras = []
    for g in np.split(group, sizes):
        a, b = np.searchsorted(which, g, "left"), np.searchsorted(which, g, "right")
        n = b - a
        entry = np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        extras.append((np.repeat(np.arange(len(g), dtype=np.int32), n).tobytes(),
                       offset[entry].astype(np.uint8).tobytes(), doc[entry].tobytes()))
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                     "keys": table.column("keys"), "hot": table.column("hot"), "low": pa.array([a.tobytes() for a in answers], pa.binary()),
                     "which": pa.array([e[0] for e in extras], pa.binary()),
                     "offset": pa.array([e[1] for e in extras], pa.binary()),
                     "doc": pa.array([e[2] for e in extras], pa.binary())})


def shared_windows(key: np.ndarray, rows: np.ndarray, low: np.ndarray):
    """(context, offset, smallest doc_id) of windows that distinct contexts of
    one key share and whose smallest doc_id is below the context's own."""
    several = np.flatnonzero(np.concatenate([[False], key[1:] == key[:-1]]) |
                             np.concatenate([key[1:] == key[:-1], [False]])) if len(key) else np.empty(0, np.int64)
    # A window reaches HALF or more bytes beyond its anchor gram to the left, or
    # else to the right: contexts without a partner there share no window.
    near = [several[:0]]
    sides = [weighed(rows[several], a, b) for a, b in ((REACH - HALF, REACH + GRAM), (REACH, REACH + GRAM + HALF))]
    reach = [rows[several, WIDTH] >= HALF, rows[several, WIDTH + 1] >= GRAM + HALF]
    for side, ok in zip(sides, reach, strict=True):
        at = np.flatnonzero(ok)
        order = at[np.argsort(side[at], kind="stable")]
        same = side[order][1:] == side[order][:-1]
        near.append(several[order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]]
                    if len(order) else several[:0])
    several = np.unique(np.concatenate(near))
    # Windows with a partner: equal hash of their bytes.
    where, at, digest = [several[:0]], [several[:0]], [np.empty(0, np.uint64)]
    for a in range(0, len(several), 1 << 15):
        c = several[a:a + (1 << 15)]
        total = np.concatenate([np.zeros((len(c), 1), np.uint64), np.cumsum(spread(rows[c]), 1, dtype=np.uint64)], 1)
        left, right = rows[c, WIDTH].astype(np.int64), rows[c, WIDTH + 1].astype(np.int64)
        for o in range(REACH + 1):
            ok = np.flatnonzero((o <= left) & (SPAN - o <= right))
            where.append(c[ok])
            at.append(np.full(len(ok), o, np.int64))
            digest.append((total[ok, WIDTH - o] - total[ok, REACH - o]) * _MIX + np.uint64(o))
    where, at, digest = np.concatenate(where), np.concatenate(at), np.concatenate(digest)
    none = np.empty(0, np.int64)
    if not len(where):
        return none, none, none
    order = np.argsort(digest, kind="stable")
    d = digest[order]
    run = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
    times = np.diff(np.concatenate([run, [len(d)]]))
    lowest = np.minimum.reduceat(low[where[order]], run)
    highest = np.maximum.reduceat(low[where[order]], run)
    # Only runs with something to learn: several contexts, unequal doc_ids.
    keep = np.repeat((times > 1) & (lowest != highest), times)
    where, at = where[order][keep], at[order][keep]
    # Suffixes of one gram that start at one distance from it are sorted together.
    gram = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) if len(key) else none
    bucket = gram[where] * (REACH + 1) + at
    order = np.argsort(bucket, kind="stable")
    where, at, bucket = where[order], at[order], bucket[order]
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])).tolist() if len(bucket) else [0]
    data, ids = rows.tobytes(), low[where].tolist()
    begin = (where * ROW + REACH - at).tolist()
    found: list[int] = []
    least: list[int] = []
    for a, b in zip(cut, cut[1:], strict=False):
        for same in deep_shallow([data[k:k + SPAN] for k in begin[a:b]]):
            if len(same) > 1:
                lowest = min(ids[a + k] for k in same)
                for k in same:
                    if lowest < ids[a + k]:
                        found.append(a + k)
                        least.append(lowest)
    return where[found], at[found], np.array(least, np.int64)


def spread(rows: np.ndarray) -> np.ndarray:
    return (rows[:, :WIDTH].astype(np.uint64) + np.uint64(1)) * _WEIGHTS[:WIDTH]


def weighed(rows: np.ndarray, begin: int, end: int) -> np.ndarray:
    """A hash of the columns from begin to end."""
    h = np.zeros(len(rows), np.uint64)
    for a in range(0, len(rows), 1 << 15):
        part = rows[a:a + (1 << 15), begin:end].astype(np.uint64)
        h[a:a + (1 << 15)] = ((part + np.uint64(1)) * _WEIGHTS[:end - begin]).sum(1, dtype=np.uint64)
    return h * _MIX


def remove(buckets: int):
    """Step 3 in a chunk: mark, cut, digest."""
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({n: pa.array([], t) for n, t in RESULT.items()})
        chunk = Chunk(table)
        depth = np.zeros(len(chunk.data) + 1, np.int32)
        if answers.num_rows:
            parts = sorted(zip(*(answers.column(n).to_pylist() for n in
                                 ("bucket", "keys", "low", "which", "offset", "doc", "hot")), strict=True))
            key = np.concatenate([np.frombuffer(p[1], np.uint64) for p in parts])
            low = np.concatenate([np.frombuffer(p[2], np.int64) for p in parts])
            base = np.cumsum([0] + [len(p[1]) // 8 for p in parts])
            which = np.concatenate([np.frombuffer(p[3], np.int32) + b for p, b in zip(parts, base, strict=False)])
            offset = np.concatenate([np.frombuffer(p[4], np.uint8) for p in parts]).astype(np.int64)
            least = np.concatenate([np.frombuffer(p[5], np.int64) for p in parts])
            # Records come back as they went out: by bucket, then key and bytes.
            hot = np.sort(np.concatenate([np.frombuffer(p[6], np.uint64) for p in parts]))
            rec = chunk.records(np.union1d(chunk.gram[member(chunk.gram, np.unique(key))], hot), hot)
            group, first = grouped(rec["key"], rec["row"])
            place = np.empty(len(first), np.int64)
            place[np.argsort((rec["key"][first] % np.uint64(buckets)).astype(np.int64), kind="stable")] = np.arange(len(first))
            ask_id = place[group]
            own = chunk.docs[rec["doc"]]
            begin = chunk.start[rec["doc"]]
            gone = low[ask_id] < own
            np.add.at(depth, (begin + rec["first"])[gone], 1)
            np.add.at(depth, (begin + rec["last"])[gone] + SPAN, -1)
            # Single windows: offsets count back from the anchor.
            order = np.argsort(which, kind="stable")
            which, offset, least = which[order], offset[order], least[order]
            a, b = np.searchsorted(which, ask_id, "left"), np.searchsorted(which, ask_id, "right")
            n = np.where(gone, 0, b - a)
            entry = np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            r = np.repeat(np.arange(len(n)), n)
            anchor = begin[r] + rec["first"][r] + rec["row"][r, WIDTH]
            hit = least[entry] < own[r]
            np.add.at(depth, (anchor - offset[entry])[hit], 1)
            np.add.at(depth, (anchor - offset[entry])[hit] + SPAN, -1)
        covered = np.cumsum(depth) > 0
        rows = []
        for t, s in zip(chunk.texts, chunk.start, strict=True):
            c = covered[s:s + len(t)]
            kept = np.frombuffer(t, np.uint8)[~c].tobytes()
            spans = int(c[0]) + int((c[1:] & ~c[:-1]).sum()) if len(c) else 0
            rows.append((len(t), int(c.sum()), spans, hashlib.sha256(kept).hexdigest()))
        cols = list(zip(*rows, strict=True))
        return pa.table({"doc_id": chunk.ids.combine_chunks().cast(pa.int64()),
                         **{n: pa.array(c, t) for (n, t), c in zip(list(RESULT.items())[1:], cols, strict=True)}})
    return run


RESULT = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(),
          "kept_sha256": pa.string()}


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES,
                   hot: int = HOT) -> DataFrame:
    """Per document: bytes, bytes removed, removed runs, digest of what is kept."""
    texts = id_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("data"))
    size = texts.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    buckets = chunks
    # Every step reads this one shuffle of the texts (a reused exchange).
    dealt = texts.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "data"), F.lit(chunks)).cast("int")).repartition(
        chunks, "chunk")
    by_chunk = dealt.groupBy("chunk")
    asked = by_chunk.applyInArrow(ask(buckets), "chunk int, bucket int, grams binary, times binary")
    states = asked.groupBy("bucket").applyInArrow(answer(hot), "chunk int, bucket int, state binary")
    told = by_chunk.cogroup(states.groupBy("chunk")).applyInArrow(
        tell(buckets), "chunk int, bucket int, keys binary, docs binary, rows binary, hot binary")
    settled = told.groupBy("bucket").applyInArrow(
        settle, "chunk int, bucket int, keys binary, hot binary, low binary, which binary, offset binary, doc binary")
    return by_chunk.cogroup(settled.groupBy("chunk")).applyInArrow(
        remove(buckets), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
