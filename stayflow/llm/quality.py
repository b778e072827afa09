"""Quality rules: hashed word and character n-gram logistic regression.

Every whole text is measured by fixed counting rules (``base_failed``) and
scored by a logistic regression over hashed n-grams: word unigrams and bigrams
and two orders of character n-grams, as frequencies.  The model is trained on
labelled rows, its output calibrated by Platt scaling on rows held back from
training, and compared with a fixed threshold.

Training reads at most ``SAMPLE`` labelled rows, chosen by a hash of doc_id so
that every run picks the same ones.  Their hashed features (at most
``4 * BUCKETS`` numbers a row) are gathered; nothing else reaches the driver.
Weights are kept as integers, so a text's score does not depend on how the
table is cut into batches.

Defined results: null text is the empty text (no words, base failed).  Repeated
rows give repeated results.  Labels that are null or contradict each other are
not used for training; without labels of both kinds every text that passes the
base rules is kept, with probability 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, id_text, sampled

# Bound on the labelled rows that training reads.
SAMPLE = 1000
# Every fifth row of them calibrates instead.
CALIBRATION = 5
BUCKETS = 8192
CHAR_ORDERS = (3, 5)
ORDERS = 2 + len(CHAR_ORDERS)
THRESHOLD = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

_FIT_ROWS = 100  # rows that one training step holds at once
_GAP = 8  # zero bytes between texts, more than any character order spans
_CHUNK = 1 << 17  # bytes of text that one array step handles
_FIX = 1 << 24  # integer weights: multiples of 1 / _FIX
_SYMBOLS = b"#*$%&|<>"
_NOT_WORD_POINTS = SPACES + bytes(range(0x80, 0xC0))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_IS_SPACE[0] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def base_row(data: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    n = len(words)
    repeat = 0
    if n > 3:
        ids: dict[bytes, int] = {}
        codes = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
        if len(ids) < 2_000_000:
            windows = (codes[:-2] * len(ids) + codes[1:-1]) * len(ids) + codes[2:]
        else:  # too many words for one number
            _, pairs = np.unique(codes[:-2] * len(ids) + codes[1:-1], return_inverse=True)
            windows = pairs * len(ids) + codes[2:]
        _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
        again = times[which] > 1
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k:n - 2 + k] |= again
        repeat = int(covered.sum())
    return (n, len(data.translate(None, _NOT_WORD_POINTS)), len(data) - len(data.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeat)


def chunks(texts: list[bytes]) -> Iterator[list[int]]:
    """Runs of texts of about _CHUNK bytes."""
    run, size = [], 0
    for k, t in enumerate(texts):
        run.append(k)
        size += len(t)
        if size >= _CHUNK:
            yield run
            run, size = [], 0
    if run:
        yield run


def hashed(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram order, the text and the bucket of every n-gram."""
    gap = bytes(_GAP)
    buf = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    first = np.cumsum([_GAP] + [len(t) + _GAP for t in texts])[:-1]
    owner = np.zeros(len(buf), np.int32)
    owner[first[1:]] = 1
    owner = np.cumsum(owner, dtype=np.int32)
    edge = np.zeros(len(buf), np.int8)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + [len(t) for t in texts], -1)
    inside = np.cumsum(edge, dtype=np.int8) > 0
    out = []
    wide = buf.astype(np.uint64)
    for order in CHAR_ORDERS:
        h = wide[:len(buf) - order + 1].copy()
        for k in range(1, order):
            h = h * _ODD + wide[k:len(buf) - order + 1 + k]
        # Both ends in a text: in the same one, as the gap is longer.
        whole = inside[:len(h)] & inside[order - 1:]
        out.append((owner[:len(h)][whole], bucket(h[whole])))
    space = _IS_SPACE[buf]
    begin = np.flatnonzero(~space[1:] & space[:-1]) + 1
    end = np.flatnonzero(~space[:-1] & space[1:]) + 1
    # Sum of byte * odd ** position over a word, shifted to position 0.
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(buf), _ODD)]))
    back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(buf), _ODD_INVERSE)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((wide + np.uint64(1)) * powers[:-1])])
    words = (sums[end] - sums[begin]) * back[begin]
    of = owner[begin]
    out.append((of, bucket(words)))
    same = of[1:] == of[:-1]
    out.append((of[1:][same], bucket(words[1:][same] * _ODD + words[:-1][same])))
    return out


def bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return (h >> np.uint64(51)).astype(np.int32)


def features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Columns and frequencies of one text's n-grams."""
    cols, vals = [], []
    for k, (_, b) in enumerate(hashed([data])):
        n = np.bincount(b, minlength=BUCKETS)
        hit = np.flatnonzero(n)
        cols.append(hit + k * BUCKETS)
        vals.append(n[hit] / max(1, len(b)))
    return np.concatenate(cols), np.concatenate(vals)


class Model:
    """Integer weights by n-gram order, an offset, and the Platt line."""

    def __init__(self, weights: np.ndarray, offset: float, slope: float, shift: float):
        self.weights = np.round(weights * _FIX).astype(np.int64).reshape(ORDERS, BUCKETS)
        self.offset, self.slope, self.shift = offset, slope, shift

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        logit = np.empty(len(texts))
        for run in chunks(texts):
            logit[run] = self.offset
            for w, (of, b) in zip(self.weights, hashed([texts[k] for k in run]), strict=True):
                total = np.zeros(len(run), np.int64)
                count = np.bincount(of, minlength=len(run))
                if len(of):
                    starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
                    total[of[starts]] = np.add.reduceat(w[b], starts)
                logit[run] += total / _FIX / np.maximum(count, 1)
        return sigmoid(self.slope * logit + self.shift)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], rounds: int = 200, ridge: float = 1e-3) -> Model | None:
    """Logistic regression by adaptive gradient steps on most of the rows, then
    a Platt line on the others.  rows: (label, columns, values)."""
    train = [r for k, r in enumerate(rows) if k % CALIBRATION]
    check = [r for k, r in enumerate(rows) if not k % CALIBRATION] or train
    if len({y for y, _, _ in train}) < 2:
        return None

    y = np.array([label for label, _, _ in train], float)
    # Both kinds weigh the same in training; calibration restores the odds.
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    n = ORDERS * BUCKETS
    w, offset = np.zeros(n), 0.0
    seen, seen_offset = np.full(n, 1e-12), 1e-12
    for _ in range(rounds):
        gw, g0 = ridge * 1e-4 * w, 0.0
        for k in range(0, len(train), _FIT_ROWS):
            part = train[k:k + _FIT_ROWS]
            g = weight[k:k + _FIT_ROWS] * (sigmoid(logits(part, w, offset)) - y[k:k + _FIT_ROWS])
            col = np.concatenate([c for _, c, _ in part])
            val = np.concatenate([v for _, _, v in part]) * np.repeat(g, [len(c) for _, c, _ in part])
            gw += np.bincount(col, val, n)
            g0 += g.sum()
        seen += gw * gw
        seen_offset += g0 ** 2
        w -= 2.0 * gw / np.sqrt(seen)
        offset -= 0.1 * g0 / np.sqrt(seen_offset)
    return Model(w, offset, *platt(logits(check, w, offset), np.array([label for label, _, _ in check], float)))


def logits(part: list[tuple[int, np.ndarray, np.ndarray]], w: np.ndarray, offset: float) -> np.ndarray:
    return np.array([v @ w[c] for _, c, v in part]) + offset


def platt(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the calibrated log odds (Newton steps, with Platt's
    smoothed targets)."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = max(1e-9, float(np.abs(logit).max()))
    x = np.stack([logit / scale, np.ones(len(y))], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ beta)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - target))
        beta -= step / max(1.0, float(np.abs(step).max()))
    return max(float(beta[0]) / scale, 1e-6), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label_col: str = "quality",
          id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Fit on at most ``sample`` labelled documents."""
    chosen = (labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.min(label_col).cast("int").alias("label"), F.max(label_col).cast("int").alias("top"))
              .where("label = top").select("doc_id", "label"))
    chosen = sampled(chosen, sample, "doc_id")

    def run(batches):
        for rb in batches:
            found = [features((t or "").encode()) for t in rb.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rb.column("doc_id"), rb.column("label"), pa.array([c.astype("<u2").tobytes() for c, _ in found]),
                 pa.array([v.astype("<f4").tobytes() for _, v in found])], ["doc_id", "label", "cols", "vals"])
    found = (id_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
             .mapInArrow(run, "doc_id long, label int, cols binary, vals binary"))
    # A repeated doc_id could bring more rows than were chosen.
    got = found.orderBy("doc_id", F.xxhash64("cols", "vals")).limit(sample).toArrow()
    return fit([(y, np.frombuffer(c, "<u2"), np.frombuffer(v, "<f4")) for y, c, v in
                zip(*(got[name].to_pylist() for name in ("label", "cols", "vals")), strict=True)])


def judge(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Counts, base verdict, probability of good quality and final verdict."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        for rb in batches:
            texts = [(t or "").encode() for t in rb.column("text").to_pylist()]
            if not texts:
                continue
            base = np.array([base_row(t) for t in texts], np.int64)
            failed = (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > MAX_REPEAT_PERCENT * base[:, 0])
            p = m.probabilities(texts) if m else np.ones(len(texts))
            yield pa.RecordBatch.from_arrays(
                [rb.column("doc_id"), *(pa.array(base[:, k]) for k in range(5)), pa.array(failed), pa.array(p),
                 pa.array(~failed & (p >= threshold))], COLUMNS)
    return id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "probability", "kept"]
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, probability double, kept boolean")


def verdict(text_col: str, model: Model | None, threshold: float = THRESHOLD):
    """A Pandas UDF: is this text kept?"""
    def kept(texts):
        data = [(t or "").encode() for t in texts]
        p = model.probabilities(data) if model else np.ones(len(data))
        ok = []
        for t, q in zip(data, p, strict=True):
            n, _, _, _, repeat = base_row(t)
            ok.append(n >= MIN_WORDS and 100 * repeat <= MAX_REPEAT_PERCENT * n and q >= threshold)
        return texts.__class__(ok, index=texts.index, dtype=bool)
    return F.pandas_udf(kept, "boolean")(F.col(text_col))
