"""Exact dedup against a dictionary of the texts."""

import collections
import hashlib
import random

import numpy as np
import pytest
from edge_rows import documents, edge, rows_of  # noqa: F401
from pyspark.sql import functions as F

from stayflow.llm import chunk_dedup as C

SMALL = {"least": 32, "bits": 4, "most": 64}


def sha(t):
    return hashlib.sha256((t or "").encode()).hexdigest()


def check(spark, rows, **how):
    got = C.dedup(documents(spark, rows), **how).collect()
    groups = collections.defaultdict(list)
    for d, t in rows:
        groups[sha(t)].append(d)
    assert collections.Counter((r.doc_id, r.text_sha256) for r in got) == collections.Counter((d, sha(t)) for d, t in rows)
    kept = collections.Counter()
    for r in got:
        best = max((d for d in groups[r.text_sha256] if d is not None), default=None)
        assert (r.keep_id, r.group_size) == (best, len(groups[r.text_sha256]))
        assert not r.kept or r.doc_id == best
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) <= {1} and len(kept) == len(groups)


# Few identifiers: chunks that share one are told apart by their bytes.
@pytest.mark.parametrize("how", [{}, SMALL, SMALL | {"name": lambda b: b[0] % 3}, {"name": lambda b: 0}])
def test_groups_on_edge_rows(spark, edge, how):
    check(spark, edge, **how)


def test_frequent_and_hot_groups(spark, monkeypatch):
    rows = [(k, "same " * 900 if k % 3 else f"own {k}") for k in range(300)] + [(7, "same " * 900)] * 5
    check(spark, rows)
    monkeypatch.setattr(C, "FREQUENT", 1)
    check(spark, rows)


def test_empty_table_and_very_long_text(spark):
    assert C.dedup(documents(spark, [])).count() == 0
    text = "".join(random.Random(1).choices("abcdefgh é\n", k=3_000_000))
    check(spark, [(1, text), (2, text), (3, text[:-1]), (4, text[:1_500_000] + "!" + text[1_500_000:])])


def test_chunks_join_to_the_text_wherever_it_lies(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices("abcd é\t", k=rng.choice([0, 1, 40, 600, 5000]))) for _ in range(200)]
    rows = [(k, t) for k, t in enumerate(texts)]
    for how in ({}, SMALL):
        one = {r.doc_id: r for r in C.cut(documents(spark, rows).coalesce(1), **how).collect()}
        many = {r.doc_id: r for r in C.cut(documents(spark, rows[::-1]).repartition(7), **how).collect()}
        for k, t in rows:
            assert b"".join(map(bytes, one[k].chunks)) == t.encode()
            assert one[k].ids == many[k].ids and one[k].chunks == many[k].chunks
            sizes = [len(c) for c in one[k].chunks]
            assert all(how.get("least", C.LEAST) <= n <= how.get("most", C.MOST) for n in sizes[:-1])


def test_a_change_moves_few_borders():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 400_000).astype(np.uint8)
    other = np.concatenate([data[:200_000], [7], data[200_000:]]).astype(np.uint8)
    a, b = ({bytes(d[s:e]) for s, e in zip([0, *x], x, strict=False)} for d in (data, other)
            for x in [C.ends(C.borders(d).tolist(), 0, len(d))])
    assert len(a) > 100 and len(a - b) <= 3


def test_the_rolling_hash_by_its_definition():
    data = np.random.default_rng(5).integers(0, 256, 5000).astype(np.uint8)
    want = [i for i in range(len(data)) if sum(int(C.VALUES[data[i - k]]) << k for k in range(min(C.WINDOW, i + 1)))
            % 2 ** 32 >> (32 - 6) == 0]
    assert C.borders(data, 6).tolist() == want


def test_distinct_chunks(spark):
    rows = [(1, "ab" * 3000), (2, "ab" * 3000), (3, None), (4, "")]
    chunks = C.chunk_table(C.cut(documents(spark, rows)))
    assert chunks.count() == len(set(rows_of(chunks.select(F.hex("data")))))
