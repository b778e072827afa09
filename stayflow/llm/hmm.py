"""Hidden Markov language model, trained by Baum-Welch across partitions.

A text is the sequence of its lower-cased words and one end.  Hidden states
emit words, each state by a mixture of two ways:

    P(w | state) = (1 - VIA) D(w, state) / D(state)
                   + VIA P(class of w | state) (c(w) + 1) / (N_class + V_class + 1)

D are the expected counts of the word itself, for every word of the training
texts.  The second way serves rare and unseen words: a word's class comes from
its form alone (its last three bytes and its length, hashed into ``CLASSES``),
the end has a class of its own, and the last unit in each class is kept for all
words that training has not seen.

Counting: texts are dealt into chunks; a chunk sends its distinct words with
their training counts, packed, to hash buckets, which add up each word's counts
over the corpus, number the words and answer every chunk.  Nothing is held for
the whole vocabulary in one place.  Training: states start from the seeded
``Hmm.first``, then ``ROUNDS`` rounds of Baum-Welch run over all training texts,
each from its first word to its end.  In a round a chunk sends the expected
(word, state) counts of its words to the same buckets, which add them up and
answer each chunk with the rows of its words; what does not depend on the
vocabulary's size (start, moves, classes) is summed over the partitions.  A
word's counts travel as shares of its largest one, in 16 bits each.  The tokens
lie in a table bucketed by chunk, so a round does not shuffle them again, and
what a round has shuffled is deleted when its result is written.
Scoring: the scaled forward recursion over every whole text.

Defined results: null text is the empty text (one end).  A null doc_id is not
held out.  Repeated rows are counted and scored each.  Without training texts
every count is zero and the states are uniform.
"""

from __future__ import annotations

import io
import zlib
from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, id_text, shuffles_dropped, store, store_bucketed

CLASSES = 1024  # class 0: the end
STATES = 8
ROUNDS = 5
VIA = 0.5  # share of words that a state emits by their class
HELD_OUT_OF, HELD_OUT = 7, 2
CHUNK_BYTES = 12 << 20
# Sequences stepped over together, and steps between kept forward vectors: a
# multiple of ``BLOCK`` with at least ``HOLD`` symbols, or all that are left.
GROUP, BLOCK, HOLD = 4096, 128, 1 << 21
END = b"\n"  # no word is one
META, TRAIN, HELD = -1, -2, -3
_SMOOTH = 0.1


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % HELD_OUT_OF == HELD_OUT


def class_of(word: bytes) -> int:
    if word == END:
        return 0
    return 1 + zlib.crc32(word[-3:] + bytes([min(len(word), 6)])) % (CLASSES - 1)


def classes_of(words: list[bytes]) -> np.ndarray:
    """``class_of`` of each word."""
    packed_ = pa.array(words, pa.large_binary())
    ends = np.frombuffer(packed_.buffers()[1], np.int64, len(words) + 1)
    length, ends = np.diff(ends), ends[1:]
    out = np.zeros(len(words), np.uint16)
    for j in np.flatnonzero(length < 3).tolist():
        out[j] = class_of(words[j])
    long = np.flatnonzero(length >= 3)
    data, crc = np.frombuffer(packed_.buffers()[2], np.uint8), np.full(len(long), 0xFFFFFFFF, np.uint32)
    for byte in (*(data[ends[long] - j] for j in (3, 2, 1)), np.minimum(length[long], 6)):
        crc ^= byte.astype(np.uint32)
        for _ in range(8):
            crc = crc >> np.uint32(1) ^ np.uint32(0xEDB88320) * (crc & np.uint32(1))
    out[long] = 1 + ~crc % (CLASSES - 1)
    return out


def tokens(text: bytes | None) -> list[bytes]:
    return [*(text or b"").lower().split(), END]


# -- counting ---------------------------------------------------------------

class Words:
    """Tokens of a chunk's texts as numbers of its words, which are in order of
    bucket and bytes, and each word's training count (zero for words of held-out
    texts only)."""

    def __init__(self, ids: list, texts: list, buckets: int):
        lengths: list[int] = []

        def split():
            for t in texts:
                words = tokens(t)
                lengths.append(len(words))
                yield words
        number: dict[bytes, int] = defaultdict(count().__next__)
        at = np.fromiter(map(number.__getitem__, chain.from_iterable(split())), np.uint32)
        self.held = np.array([held_out(d) for d in ids], bool)
        self.lengths = np.array(lengths, np.int64)
        names = list(number)
        hash_ = np.fromiter(map(zlib.crc32, names), np.uint32, len(names))
        by = pc.array_sort_indices(pa.array(names, pa.large_binary())).to_numpy()
        by = by[np.argsort(hash_[by] % buckets, kind="stable")]
        self.names, self.hash = [names[j] for j in by.tolist()], hash_[by]
        self.bucket = (self.hash % buckets).astype(np.int64)
        rank = np.empty(len(by), np.uint32)
        rank[by] = np.arange(len(by), dtype=np.uint32)
        self.at = rank[at]
        self.counts = np.bincount(self.at[~np.repeat(self.held, self.lengths)], minlength=len(by))

    def runs(self) -> list[tuple[int, int, int]]:
        """Bucket, first word and end of each run of words."""
        used, first = np.unique(self.bucket, return_index=True)
        return list(zip(used.tolist(), first.tolist(), [*first[1:].tolist(), len(self.names)], strict=True))


def ask(buckets: int):
    """A chunk's words and counts for each bucket, and rows for the chunk itself
    (buckets below zero): texts and words (``META``), tokens of its training
    texts (``TRAIN``) and of its held-out texts (``HELD``)."""
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_pylist()
        words = Words(ids, table.column("data").to_pylist(), buckets)
        press = zstandard.ZstdCompressor(level=3)
        out = [(k, press.compress(b"\x20".join(words.names[i:j])), press.compress(words.counts[i:j].tobytes()))
               for k, i, j in words.runs()]
        order = np.argsort(words.held, kind="stable")  # training texts first
        file = io.BytesIO()
        np.savez(file, ids=np.array([ids[j] or 0 for j in order], np.int64), null=[ids[j] is None for j in order],
                 held=words.held[order], lengths=words.lengths[order], runs=np.array(words.runs(), np.int64),
                 hash=words.hash, kind=classes_of(words.names), counts=words.counts)
        out.append((META, press.compress(file.getvalue()), None))
        for held, name in ((False, TRAIN), (True, HELD)):
            mine = np.repeat(words.held, words.lengths) == held
            out.append((name, packed_sequences(words.lengths[words.held == held], words.at[mine]), None))
        chunk = table.column("chunk")[0].as_py()
        return pa.table({"chunk": pa.array([chunk] * len(out), pa.int32()),
                         "bucket": pa.array([o[0] for o in out], pa.int32()),
                         "words": pa.array([o[1] for o in out], pa.binary()),
                         "counts": pa.array([o[2] for o in out], pa.binary())})
    return run


def add_up(table: pa.Table) -> pa.Table:
    """Corpus counts of a bucket's words, answered to each chunk as twice the
    count, plus one in the first chunk that has the word (so that each word is
    counted once as a member of its class)."""
    open_, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)
    rows = sorted(zip(table.column("chunk").to_pylist(), table.column("bucket").to_pylist(),
                      table.column("words").to_pylist(), table.column("counts").to_pylist(), strict=True))
    number: dict[bytes, int] = {}
    places = []
    for _, _, w, _ in rows:
        places.append(np.array([number.setdefault(x, len(number)) for x in open_.decompress(w).split(b"\x20")]))
    total = np.zeros(len(number), np.int64)
    for p, r in zip(places, rows, strict=True):
        total[p] += np.frombuffer(open_.decompress(r[3]), np.int64)
    known = total == 0  # unseen words belong to no class's vocabulary
    answers, numbers = [], []
    for p in places:
        answers.append(press.compress((2 * total[p] + ~known[p]).astype(np.int64).tobytes()))
        numbers.append(press.compress(p.astype(np.int32).tobytes()))
        known[p] = True
    return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int32()),
                     "bucket": pa.array([r[1] for r in rows], pa.int32()), "counts": pa.array(answers, pa.binary()),
                     "numbers": pa.array(numbers, pa.binary())})


TOLD = pa.schema([("chunk", pa.int32()), ("kind", pa.int32()), ("place", pa.int32()), ("doc_id", pa.int64()),
                  ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                  ("log_counts", pa.float64()), ("data", pa.binary())])
TOLD_SQL = ("chunk int, kind int, place int, doc_id long, held_out boolean, n_tokens long, n_known long, "
            "log_counts double, data binary")


def read(mine: pa.Table, answers: pa.Table) -> pa.Table:
    """A row for each text (kind 0, training texts first) and rows of the chunk:
    new members and training tokens of every class (kind 1), its words bucket
    by bucket (kind 2, see ``Vocabulary``), and the tokens of its training texts
    (kind 3) and held-out texts (kind 4), see ``sequences``."""
    if not mine.num_rows:
        return TOLD.empty_table()
    chunk, open_ = mine.column("chunk")[0].as_py(), zstandard.ZstdDecompressor()
    data = dict(zip(mine.column("bucket").to_pylist(), mine.column("words").to_pylist(), strict=True))
    texts = np.load(io.BytesIO(open_.decompress(data[META])))
    told, place = {}, {}
    for k, c, p in zip(*(answers.column(c).to_pylist() for c in ("bucket", "counts", "numbers")), strict=True):
        told[k], place[k] = open_.decompress(c), open_.decompress(p)
    runs, kind = texts["runs"], texts["kind"]
    used = runs[:, 0].tolist()
    told = np.frombuffer(b"".join(told[k] for k in used), np.int64)
    total = told >> 1
    at, logs = sequences(data[TRAIN]) + sequences(data[HELD]), np.log10(total + 1.0)
    # Logarithms are summed in the order of the text.
    rows = [(chunk, 0, j, None if null else d, held, n, int((total[w] > 0).sum()), float(logs[w].sum()), None)
            for j, (d, null, held, n, w) in enumerate(zip(
                *(texts[c].tolist() for c in ("ids", "null", "held", "lengths")), at, strict=True))]
    members = np.bincount(kind[(told & 1) > 0], minlength=CLASSES)
    here = np.bincount(kind, texts["counts"], CLASSES)
    rows.append((chunk, 1, *[None] * 6, np.concatenate([members, here]).astype(np.int64).tobytes()))
    sizes = np.stack([runs[:, 0], runs[:, 2] - runs[:, 1]], 1)
    words = b"".join([np.int64(len(used)).tobytes(), sizes.tobytes(), total.tobytes(),
                      b"".join(place[k] for k in used), texts["hash"].tobytes(), kind.tobytes()])
    rows.append((chunk, 2, *[None] * 6, zstandard.ZstdCompressor(level=1).compress(words)))
    rows += [(chunk, 3, *[None] * 6, data[TRAIN]), (chunk, 4, *[None] * 6, data[HELD])]
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), TOLD, strict=True)], TOLD)


def packed_sequences(lengths: np.ndarray, flat: np.ndarray) -> bytes:
    """Texts as numbers of words, the bytes of equal weight side by side."""
    planes = flat.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=3).compress(
        np.int64(len(lengths)).tobytes() + lengths.astype(np.int64).tobytes() + planes)


def sequences(data: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    lengths = np.frombuffer(data, np.int64, n, 8)
    planes = np.frombuffer(data, np.uint8, offset=8 + 8 * n).reshape(4, -1)
    flat = np.ascontiguousarray(planes.T).view("<u4").ravel()
    return np.split(flat, np.cumsum(lengths)[:-1]) if n else []


class Vocabulary:
    """A chunk's words in order of their buckets: bucket and size of each run of
    words, and each word's training count, number in its bucket, hash and class."""

    def __init__(self, packed: bytes):
        data = zstandard.ZstdDecompressor().decompress(packed)
        runs = int(np.frombuffer(data, np.int64, 1)[0])
        self.runs = np.frombuffer(data, np.int64, 2 * runs, 8).reshape(-1, 2).tolist()
        n, at = sum(r[1] for r in self.runs), 8 + 16 * runs
        self.count = np.frombuffer(data, np.int64, n, at)
        self.number = np.frombuffer(data, np.int32, n, at + 8 * n)
        self.hash = np.frombuffer(data, np.uint32, n, at + 12 * n)
        self.kind = np.frombuffer(data, np.uint16, n, at + 16 * n)

    def seeded(self, states: int) -> np.ndarray:
        """Fixed factors from 0.3 to 1.7 that set words of one class apart."""
        x = self.hash[:, None].astype(np.uint64) * np.uint64(64) + np.arange(states, dtype=np.uint64)
        for by in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            x = (x ^ x >> np.uint64(30)) * np.uint64(by)
        return 0.3 + 1.4 * (x >> np.uint64(40)).astype(float) / (1 << 24)


def counted(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """The rows of ``read``, and the number of chunks and of buckets."""
    texts = id_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("data"))
    size = texts.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    chunks = max(1, -(-size // CHUNK_BYTES))
    buckets = chunks
    by_chunk = texts.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "data"), F.lit(chunks)).cast("int")).repartition(
        chunks, "chunk").groupBy("chunk")
    asked, path = store_bucketed(by_chunk.applyInArrow(ask(buckets), "chunk int, bucket int, words binary, counts binary"),
                                 "words", chunks, "chunk")
    totals = asked.where("bucket >= 0").groupBy("bucket").applyInArrow(
        add_up, "chunk int, bucket int, counts binary, numbers binary").repartition(chunks, "chunk")
    told = asked.where("bucket < 0").groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(read, TOLD_SQL)
    told, _ = store_bucketed(told, "tokens", chunks, "chunk")
    drop_stored(docs.sparkSession, path)
    return told, chunks


# -- the model --------------------------------------------------------------

class Hmm:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit  # (K,), (K, K), (CLASSES, K)

    @classmethod
    def first(cls, states: int, frequency: np.ndarray) -> Hmm:
        """Sticky states over slightly different emissions (fixed seed)."""
        rng = np.random.default_rng(42)
        emit = (frequency + 1.0 / len(frequency))[:, None] * rng.uniform(0.3, 1.7, (len(frequency), states))
        move = np.full((states, states), 0.1 / max(1, states - 1)) + np.eye(states) * 0.9
        return cls(np.full(states, 1.0 / states), move / move.sum(1, keepdims=True), emit / emit.sum(0))

    def forward(self, group: Steps, a: np.ndarray | None, lo: int, hi: int):
        """Symbols, state shares, scaled emissions and scales of the steps from
        ``lo`` to ``hi``, and the last step's shares; ``a``: those before ``lo``."""
        begin, base = group.begin, group.begin[lo]
        at = group.flat[base:begin[hi]]
        out = np.take(self.emit, at, axis=0).T.copy()
        alpha, scale = np.empty_like(out), np.empty(len(at), out.dtype)
        back, first = np.ascontiguousarray(self.move.T, out.dtype), self.start[:, None].astype(out.dtype)
        i = 0
        for t in range(lo, hi):
            j = begin[t + 1] - base
            got, c = alpha[:, i:j], scale[i:j]
            np.multiply(back @ a[:, :j - i] if t else first, out[:, i:j], got)
            np.add.reduce(got, 0, None, c)
            got /= c
            a, i = got, j
        out /= scale
        return at, alpha, out, scale, a.copy()

    def expected(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Expected counts (flat: start, move, emit) over whole sequences of
        symbols, by scaled forward and backward recursions in the emissions'
        precision.

        The forward pass keeps one vector at each block of steps; on the way
        back a block's vectors are made again from the one before it.
        """
        k = len(self.start)
        start, pairs, emit = np.zeros(k), np.zeros((k, k)), np.zeros((k, len(self.emit)))
        move = self.move.astype(self.emit.dtype)
        for group in groups(sequences):
            kept, part, begin = [None], None, group.begin
            for lo, hi in group.blocks:
                part = self.forward(group, kept[-1], lo, hi)
                kept.append(part[4])
            kept.pop()
            beta = np.ones((k, begin[1]), self.emit.dtype)
            for lo, hi in reversed(group.blocks):
                before = kept.pop()
                at, alpha, out, _, _ = part or self.forward(group, before, lo, hi)
                part, base = None, begin[lo]
                for t in range(hi - 1, lo - 1, -1):
                    i, j = begin[t] - base, begin[t + 1] - base
                    m = j - i
                    ahead = beta[:, :m]
                    alpha[:, i:j] *= ahead
                    if t:
                        ahead *= out[:, i:j]
                        last = before if t == lo else alpha[:, begin[t - 1] - base:]
                        pairs += last[:, :m] @ ahead.T
                        ahead[:] = move @ ahead
                if not lo:
                    start += alpha[:, :begin[1]].sum(1)
                for s in range(k):
                    emit[s] += np.bincount(at, alpha[s], len(self.emit))
        return np.concatenate([start, (self.move * pairs).ravel(), emit.T.ravel()])

    def updated(self, counts: np.ndarray) -> Hmm:
        k = len(self.start)
        start, move, emit = counts[:k] + _SMOOTH, counts[k:k + k * k].reshape(k, k) + _SMOOTH, \
            counts[k + k * k:].reshape(-1, k) + _SMOOTH
        return Hmm(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))

    def log10(self, sequences: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each whole sequence."""
        out = np.zeros(len(sequences))
        for group in groups(sequences):
            total, a = np.zeros(group.begin[1]), None
            for lo, hi in group.blocks:
                _, _, _, scale, a = self.forward(group, a, lo, hi)
                total += np.bincount(group.who(lo, hi), np.log10(scale), len(total))
            out[group.order] = total
        return out


class Steps:
    """Sequences side by side, longest first: symbols by step, within a step by
    sequence."""

    def __init__(self, sequences: list[np.ndarray], order: list[int]):
        self.order = order
        live = np.array([len(sequences[j]) for j in order])
        steps = int(live[0])
        width = np.searchsorted(-live, -np.arange(steps), "left")
        begin = np.concatenate([[0], np.cumsum(width)])
        place = np.arange(live.sum()) - np.repeat(np.cumsum(live) - live, live)
        self.flat = np.empty(len(place), np.int64)
        self.flat[begin[place] + np.repeat(np.arange(len(live)), live)] = np.concatenate([sequences[j] for j in order])
        self.begin, self.blocks, lo = begin.tolist(), [], 0
        while lo < steps:
            hi = min(lo + BLOCK, steps)
            while hi < steps and self.begin[hi] - self.begin[lo] < HOLD:
                hi = min(hi + BLOCK, steps)
            self.blocks.append((lo, hi))
            lo = hi

    def who(self, lo: int, hi: int) -> np.ndarray:
        """Sequence of each symbol of the steps from ``lo`` to ``hi``."""
        begin = np.array(self.begin[lo:hi + 1])
        return np.arange(begin[0], begin[-1]) - np.repeat(begin[:-1], np.diff(begin))


def groups(sequences: list[np.ndarray]):
    """The sequences, longest first, a bounded number at a time."""
    order = sorted(range(len(sequences)), key=lambda j: -len(sequences[j]))
    for a in range(0, len(order), GROUP):
        yield Steps(sequences, order[a:a + GROUP])


# -- rounds over all chunks ----------------------------------------------------

class Model:
    """What every chunk knows: start, moves and class emissions, the summed
    direct counts of each state, training tokens and members of each class."""

    def __init__(self, hmm: Hmm, total: np.ndarray, frequency: np.ndarray, members: np.ndarray):
        self.hmm, self.total, self.frequency, self.members = hmm, total, frequency, members

    @classmethod
    def first(cls, states: int, frequency: np.ndarray, members: np.ndarray) -> Model:
        hmm = Hmm.first(states, frequency / max(1.0, frequency.sum()))
        return cls(hmm, hmm.emit[frequency > 0].sum(0), frequency, members)

    def ways(self, words: Vocabulary, direct: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Emission of each word, and its part that is direct; without direct
        counts (first round) a class's counts are dealt by its words' shares."""
        emit = self.hmm.emit[words.kind]
        if direct is None:
            direct = emit * (words.count / np.maximum(self.frequency, 1)[words.kind])[:, None]
        own = np.where(self.total > 0, 1 - VIA, 0.0)
        part = direct * (own / np.where(self.total > 0, self.total, 1.0))
        emit *= (1 - own) * ((words.count + 1) / (self.frequency + self.members + 1)[words.kind])[:, None]
        emit += part
        return emit, part

    def updated(self, sums: np.ndarray) -> Model:
        """Next model from summed counts: start, move, classes, direct totals."""
        k = len(self.total)
        return Model(self.hmm.updated(sums[:-k]), sums[-k:], self.frequency, self.members)


def packed(rows: np.ndarray) -> bytes:
    """(word, state) counts: each word's largest, and the others as shares of it
    in 16 bits; the bytes of equal weight side by side."""
    rows = rows.astype(np.float32)
    most = np.maximum.reduce(np.ascontiguousarray(rows.T))
    rows *= (65535 / np.where(most > 0, most, 1))[:, None]
    share = np.rint(rows, rows).astype("<u2")
    return zstandard.ZstdCompressor(level=1).compress(
        b"".join(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes() for x in (most, share.ravel())))


def unpacked(data: bytes, states: int) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n = len(flat) // (4 + 2 * states)
    most = np.ascontiguousarray(flat[:4 * n].reshape(4, -1).T).view(np.float32)
    share = np.ascontiguousarray(flat[4 * n:].reshape(2, -1).T).view("<u2").reshape(-1, states)
    return share * (most / np.float32(65535))


def of_chunk(told: pa.Table, answers: pa.Table | None, model: Model):
    """Data of the chunk's rows by kind, its words, and what ``Model.ways`` says
    of them."""
    data = dict(zip(told.column("kind").to_pylist(), told.column("data").to_pylist(), strict=True))
    words = Vocabulary(data[2])
    direct = None
    if answers is not None:
        got = dict(zip(answers.column("bucket").to_pylist(), answers.column("counts").to_pylist(), strict=True))
        direct = np.concatenate([unpacked(got[b], len(model.total)) for b, _ in words.runs])
    return data, words, *model.ways(words, direct)


SENT_SQL = "bucket int, chunk int, numbers binary, counts binary"
SENT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("numbers", pa.binary()), ("counts", pa.binary())])


def expect(sent, buckets: int):
    """Expected direct counts of the chunk's words, to their buckets; its other
    sums (without numbers) to one bucket."""
    def run(told: pa.Table, answers: pa.Table | None = None) -> pa.Table:
        if not told.num_rows:
            return SENT.empty_table()
        model, chunk = sent.value, told.column("chunk")[0].as_py()
        data, words, emit, part = of_chunk(told, answers, model)
        k = len(model.total)
        if answers is None:
            seeded = words.seeded(k)
            emit += part * (seeded - 1)
            part *= seeded
        counts = Hmm(model.hmm.start, model.hmm.move, emit.astype(np.float32)).expected(sequences(data[3]))
        rest, both = counts[:k + k * k], counts[k + k * k:].reshape(-1, k)
        part /= emit
        part *= both
        both = both - part
        via = np.stack([np.bincount(words.kind, both[:, s], CLASSES) for s in range(k)], 1)
        rows, at = [(chunk % buckets, chunk, None, np.concatenate([rest, via.ravel()]).tobytes())], 0
        for b, size in words.runs:
            rows.append((b, chunk, words.number[at:at + size].tobytes(), packed(part[at:at + size])))
            at += size
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SENT, strict=True)], SENT)
    return run


def add_up_states(states: int):
    """Summed counts of a bucket's words, answered to each chunk, and one row
    (no chunk) of the other sums with the bucket's direct totals."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        rows = list(zip(*(table.column(c).to_pylist() for c in ("bucket", "chunk", "numbers", "counts")), strict=True))
        sums = np.zeros(states + states * states + CLASSES * states)
        places = [(r, np.frombuffer(r[2], np.int32)) for r in rows if r[2] is not None]
        total = np.zeros((max((int(p.max()) + 1 for _, p in places), default=0), states))
        for r in rows:
            if r[2] is None:
                sums += np.frombuffer(r[3])
        for r, p in places:
            total[p] += unpacked(r[3], states)
        out = [(r[1], r[0], packed(total[p])) for r, p in places]
        out.append((None, rows[0][0], np.concatenate([sums, total.sum(0)]).tobytes()))
        return pa.table({"chunk": pa.array([o[0] for o in out], pa.int32()),
                         "bucket": pa.array([o[1] for o in out], pa.int32()),
                         "counts": pa.array([o[2] for o in out], pa.binary())})
    return run


def forward(sent):
    """Score of every text of the chunk."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "log_counts"]

    def run(told: pa.Table, answers: pa.Table | None = None) -> pa.Table:
        if not told.num_rows:
            return SCORED.empty_table()
        model = sent.value
        data, _, emit, _ = of_chunk(told, answers, model)
        got = Hmm(model.hmm.start, model.hmm.move, emit).log10(sequences(data[3]) + sequences(data[4]))
        texts = told.filter(pc.equal(told.column("kind"), 0)).sort_by("place")
        return texts.select(names).append_column("score", pa.array(got)).cast(SCORED)
    return run


SCORED = pa.schema([*[TOLD.field(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "log_counts")],
                    pa.field("score", pa.float64())])
SCORED_SQL = "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double"


def summed(told: DataFrame, per_batch) -> np.ndarray:
    """Arrays that ``per_batch(rows)`` makes, added up over all partitions."""
    def run(batches):
        total = None
        for rb in batches:
            if rb.num_rows:
                got = per_batch(rb)
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["k", "v"])
    got = told.mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(len(got))
    out[got["k"].to_numpy()] = got["v"].to_numpy()
    return out


def score(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per document: held_out, token counts, unigram score and model score."""
    spark = docs.sparkSession
    told, chunks = counted(docs, id_col, text_col)

    def class_counts(rb):
        return np.sum([np.frombuffer(d, np.int64) for d in rb.column(0).to_pylist()], 0).astype(float)
    classes = summed(told.where("kind = 1").select("data"), class_counts)
    members, frequency = classes.reshape(2, -1) if len(classes) else np.zeros((2, CLASSES))
    n, v = int(frequency.sum()), int(members.sum())
    model = Model.first(states, frequency, members)
    answers = path = None

    def with_answers(rows, make, schema):
        by_chunk = told.where(rows).groupBy("chunk")
        if answers is None:
            return by_chunk.applyInArrow(lambda t: make(t), schema)
        mine = answers.where("chunk IS NOT NULL").repartition(chunks, "chunk")
        return by_chunk.cogroup(mine.groupBy("chunk")).applyInArrow(make, schema)
    for _ in range(rounds if n else 0):
        sent = spark.sparkContext.broadcast(model)
        step = with_answers("kind IN (2, 3)", expect(sent, chunks), SENT_SQL)
        step = step.groupBy("bucket").applyInArrow(add_up_states(states), "chunk int, bucket int, counts binary")
        with shuffles_dropped(spark):
            before, (answers, path) = path, store(step, "states")
        if before:
            drop_stored(spark, before)
        model = model.updated(summed(answers.where("chunk IS NULL").select("counts"), lambda rb: np.sum(
            [np.frombuffer(d) for d in rb.column(0).to_pylist()], 0)))
    scored = with_answers("kind <> 1", forward(spark.sparkContext.broadcast(model)), SCORED_SQL)
    unit = float(np.log10(n + v + 1))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                         (F.col("log_counts") - F.col("n_tokens") * F.lit(unit)).alias("base_score"), "score")
