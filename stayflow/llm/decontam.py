"""Benchmark decontamination by q-gram counts in diagonal bands.

An occurrence of an item of m bytes with e edits keeps at least
m + 1 - q * (e + 1) of the item's q-grams, all on diagonals (text position
minus item position) at most e from that of its start (the q-gram lemma).  Shared
q-grams are counted in overlapping bands of 2 * (2e + 1) diagonals, one band
starting every 2e + 1, so that any occurrence lies whole in some band; bands
that meet the bound are verified by a banded alignment, exact in the number of
edits.  Texts and items are compared as UTF-8 bytes with A-Z lower-cased and
each white-space byte read as a space.

The edit budget of an item is a share of its length, and never so large that
the q-gram bound falls below ``MIN_SHARED``.  Items too short to keep that many
q-grams without any edit are looked up as they stand.

Items go to the tasks in blocks of bounded size, each against all documents.

Defined results: null or empty items never match; null or empty texts hold
nothing.  Repeated rows, on either side, each give their matches.  Of equally
good places the first is returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text

Q = 10
MAX_EDITS = 0.08
MIN_SHARED = 8
# Bytes of benchmark text that a task holds at once.
BLOCK_BYTES = 4 << 20
_CHUNK = 1 << 17  # bytes of text that one array step handles

_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = tuple(np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F))


def budget(m: int, q: int, max_edits: float) -> int:
    """Edits allowed for an item of m bytes (-1: too short for the filter)."""
    if m + 1 - q < MIN_SHARED:
        return -1
    return min(int(m * max_edits), (m + 1 - MIN_SHARED) // q - 1)


def quick(data: np.ndarray, q: int) -> np.ndarray:
    """A 32-bit hash of each q-gram, from the 4-byte words that cover it."""
    n = len(data) - q + 1
    if n <= 0:
        return np.empty(0, np.uint32)
    b = data.astype(np.uint32)
    x = b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24)
    h = x[:n] * _FACTORS[0]
    for at, factor in zip((*range(4, q - 4, 4), q - 4), _FACTORS[1:] * q, strict=False):
        h += x[at:at + n] * factor
    h ^= h >> np.uint32(15)
    h *= _FACTORS[0]
    return h


def exact(data: np.ndarray, at: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q-grams at some positions."""
    h = np.zeros(len(at), np.uint64)
    for k in range(q):
        h = (h + data[at + k].astype(np.uint64) + np.uint64(1)) * _MIX
        h ^= h >> np.uint64(29)
    return h


@dataclass
class Items:
    """A block of benchmark items and its q-gram index."""

    ids: list[int | None]
    texts: list[bytes]
    q: int
    max_edits: float

    def __post_init__(self):
        self.edits = np.array([budget(len(t), self.q, self.max_edits) for t in self.texts], np.int64)
        self.short = [k for k, t in enumerate(self.texts) if self.edits[k] < 0 and t]
        data = [np.frombuffer(t if self.edits[k] >= 0 else b"", np.uint8) for k, t in enumerate(self.texts)]
        every = [exact(d, np.arange(max(0, len(d) - self.q + 1)), self.q) for d in data]
        g = np.concatenate([*every, np.empty(0, np.uint64)])
        item = np.repeat(np.arange(len(every)), [len(x) for x in every])
        place = np.concatenate([*(np.arange(len(x)) for x in every), np.empty(0, np.int64)])
        order = np.argsort(g, kind="stable")
        self.item, self.place = item[order], place[order]
        self.gram, self.first, self.times = np.unique(g[order], return_index=True, return_counts=True)
        # A first, cheap test: one flag for each value of some hash bits.
        bits = max(16, min(26, int(len(self.gram)).bit_length() + 6))
        self.drop = np.uint32(32 - bits)
        self.flag = np.zeros(1 << bits, bool)
        for d in data:
            self.flag[quick(d, self.q) >> self.drop] = True

    def shared(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text position, item, item position) of every shared q-gram."""
        at = np.flatnonzero(self.flag[quick(data, self.q) >> self.drop])
        if not len(at) or not len(self.gram):
            return (np.empty(0, np.int64),) * 3
        g = exact(data, at, self.q)
        k = np.minimum(np.searchsorted(self.gram, g), len(self.gram) - 1)
        ok = self.gram[k] == g
        at, k = at[ok], k[ok]
        times = self.times[k]
        entry = np.repeat(self.first[k] - np.concatenate([[0], np.cumsum(times)[:-1]]).astype(np.int64), times) \
            + np.arange(times.sum())
        return np.repeat(at, times), self.item[entry], self.place[entry]


def banded(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """Fewest edits (at most ``most``) between the item and any part of the
    text, over paths on diagonals low to high: (edits, start, end), the first
    such end; None if there is none."""
    m, n, width = len(item), len(text), high - low + 1
    far = 1 << 20
    steps = np.arange(width)
    column = steps + low  # text position before row 0
    # The text from diagonal ``low`` on, with nothing where there is no text.
    padded, real = np.zeros(m + width, np.int16), np.zeros(m + width, bool)
    begin, end = max(0, -low), max(0, min(m + width, n - low))
    padded[begin:end], real[begin:end] = text[begin + low:end + low], True
    padded[~real] = -1
    cost = np.where((column >= 0) & (column <= n), 0, far)
    start = column.copy()
    for i in range(m):
        column = i + low + steps  # text byte consumed by a substitution
        differs = np.where(padded[i:i + width] == item[i], 0, np.where(real[i:i + width], 1, far))
        down = np.concatenate([cost[1:] + 1, [far]])
        across = cost + differs
        new = np.where(across <= down, across, down)
        new_start = np.where(across <= down, start, np.concatenate([start[1:], [0]]))
        # Extra text bytes: from the diagonal before, in the same row.
        reach = np.minimum.accumulate(new - steps) + steps
        origin = np.maximum.accumulate(np.where(new - steps == reach - steps, steps, -1))
        cost = np.where((column + 1 >= 0) & (column + 1 <= n), reach, far)
        start = new_start[np.maximum(origin, 0)]
    if cost.min() > most:
        return None
    k = int(cost.argmin())
    return int(cost[k]), int(start[k]), int(m + low + k)


def matches(items: Items, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, edits, start, end) of each item found in each text; start
    and end are byte offsets."""
    run, size = [], 0
    for k, t in enumerate(texts):
        run.append(k)
        size += len(t)
        if size >= _CHUNK or k + 1 == len(texts):
            yield from _matches(items, texts, run)
            run, size = [], 0


def _matches(items: Items, texts: list[bytes], run: list[int]):
    folded = [texts[k].translate(_FOLD) for k in run]
    for item in items.short:
        for k, t in zip(run, folded, strict=True):
            if (at := t.find(items.texts[item])) >= 0:
                yield k, item, 0, at, at + len(items.texts[item])
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in folded])])
    data = np.frombuffer(b"\0".join(folded), np.uint8)
    at, item, place = items.shared(data)
    if not len(at):
        return
    text = np.searchsorted(begin, at, "right") - 1
    edits = items.edits[item]
    step = 2 * edits + 1
    length = np.array([len(t) for t in items.texts])
    # Diagonals can be as low as minus the item's length.
    diagonal = at - begin[text] - place + length[item]
    band = diagonal // step
    # Each q-gram of the item counts once in a band.
    keys = np.stack([np.concatenate([text, text]), np.concatenate([item, item]),
                     np.concatenate([band, band - 1]), np.concatenate([place, place])])
    keys = keys[:, np.lexsort(keys[::-1])]
    keys = keys[:, np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(0)])]
    edge = np.flatnonzero(np.concatenate([[True], (keys[:3, 1:] != keys[:3, :-1]).any(0)]))
    count = np.diff(np.concatenate([edge, [keys.shape[1]]]))
    text, item, band = keys[:3, edge]
    enough = count >= length[item] + 1 - items.q * (items.edits[item] + 1)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for t, i, b in zip(text[enough].tolist(), item[enough].tolist(), band[enough].tolist(), strict=True):
        if (t, i) in best and not best[t, i][0]:
            continue
        # The exact passage needs no alignment.
        if (t, i) not in best and (where := folded[t].find(items.texts[i])) >= 0:
            best[t, i] = 0, where, where + len(items.texts[i])
            continue
        e = int(items.edits[i])
        low = int(b) * (2 * e + 1) - int(length[i])
        high = low + 2 * (2 * e + 1) - 1
        window = max(0, low - e)
        part = folded[t][window:high + int(length[i]) + e + 1]
        found = banded(np.frombuffer(items.texts[i], np.uint8), np.frombuffer(part, np.uint8),
                       low - e - window, high + e - window, e)
        if found:
            found = found[0], found[1] + window, found[2] + window
            if (t, i) not in best or found < best[t, i]:
                best[t, i] = found
    for (t, i), found in best.items():
        yield run[t], int(i), *found


def blocks(benchmark: DataFrame, q: int, max_edits: float, id_col: str, text_col: str) -> Iterator[Items]:
    """The benchmark in blocks of about BLOCK_BYTES of text."""
    items = id_text(benchmark, id_col, text_col).where(F.length("text") > 0)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n))
    for k in range(n if total else 0):
        rows = items.where(block == k).orderBy("doc_id", "text").collect()
        yield Items([r["doc_id"] for r in rows], [r["text"].encode().translate(_FOLD) for r in rows], q, max_edits)


def find_leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, max_edits: float = MAX_EDITS,
               id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text") -> DataFrame:
    """doc_id, item_id, edits, start, end (code points): one row for each item
    found in each document, at its best place."""
    schema = "doc_id long, item_id long, edits int, start long, `end` long"
    texts = id_text(docs, id_col, text_col)
    found = None
    for items in blocks(benchmark, q, max_edits, item_id, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(items)
        part = texts.mapInArrow(_search(sent), schema)
        found = part if found is None else found.union(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, max_edits: float = MAX_EDITS,
                  text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    for items in blocks(benchmark, q, max_edits, item_id, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def clean(texts, sent=sent):
            data = [(t or "").encode() for t in texts]
            bad = {k for k, *_ in matches(sent.value, data)}
            return texts.__class__([k not in bad for k in range(len(data))], index=texts.index, dtype=bool)
        docs = docs.where(F.pandas_udf(clean, "boolean")(F.col(text_col).cast("string")))
    return docs


def _search(sent):
    def run(batches):
        items = sent.value
        for rb in batches:
            ids = rb.column("doc_id").to_pylist()
            texts = [(t or "").encode() for t in rb.column("text").to_pylist()]
            rows = [(ids[k], items.ids[i], e, len(texts[k][:s].decode(errors="ignore")),
                     len(texts[k][:t].decode(errors="ignore"))) for k, i, e, s, t in matches(items, texts)]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(LEAK.names, r, strict=True)) for r in rows], schema=LEAK)
    return run


LEAK = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()),
                  ("start", pa.int64()), ("end", pa.int64())])
