"""The trie against a brute-force version over all prefixes."""

import hashlib
import random
import zlib

import pytest
from edge_rows import rows_of
from pyspark.sql import functions as F

from stayflow.llm import prefix_trie as P


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        digest = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}:{text or ''}".encode()).digest()[:16]
        own.setdefault(conv, []).append((turn is not None, turn or 0, digest, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        if c is None:
            out[c] = turns
            continue
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(c - 5 * int(c / 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def nodes(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)

    def least(node):
        return min((c for c in members[node] if c is not None), default=None)
    children, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, [])
        leaves[node] = sum(leaves[k] for k in kids) or 1
        saved[node] = sum(saved[k] for k in kids) + (len(node) and (len(members[node]) - 1) * len(node[-1][1].encode()))
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = []
    for node, ms in members.items():
        ends = sorted((c for c in ms if len(convs[c]) == len(node)), key=lambda c: (c is not None, c or 0))
        text = ",".join("" if c is None else str(c) for c in ends)
        out.append((least(node), len(node), least(node[:-1]) if node else None, len(ms), len(children.get(node, [])),
                    leaves[node], saved[node], hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def random_rows(seed, convs=70):
    rng = random.Random(seed)
    rows = []
    for c in [None, -3, -10, *range(convs), 2 ** 40]:
        for t in range(rng.choice([1, 2, 3, 5, 8, 12])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None, ""]),
                         rng.choice(["a", "é", None, "", "long text"])))
    # Copies of one conversation, and one that goes on.
    rows += [(1000 + c, t, "user", f"turn {t}") for c in range(40) for t in range(9 + 6 * (c == 39))]
    return rows + rows[:30]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("key", "band", "depth", "n", "said")})


HOW = [{}, {"limit": 12}, {"band": 4, "limit": 20}, {"band": 3, "limit": 0}]


@pytest.mark.parametrize("how", HOW)
def test_nodes_by_brute_force(spark, how):
    rows = random_rows(len(how))
    turns, ids = P.spliced(P.marked(table(spark, rows)))
    assert rows_of(P.trie(turns, ids, **how)) == nodes(rebuilt(rows))


def test_as_they_are_and_empty(spark):
    rows = [(1, None, "user", "x" * 3_000_000), (1, 1, "user", "b"), (2, 0, "user", "x" * 3_000_000), (3, 5, "user", "b")]
    got = P.trie(P.marked(table(spark, rows)))
    convs = {1: [("user", "x" * 3_000_000), ("user", "b")], 2: [("user", "x" * 3_000_000)], 3: [("user", "b")]}
    assert rows_of(got) == nodes(convs)
    none = P.trie(P.marked(table(spark, rows).limit(0)))
    assert none.count() == 0 and none.columns == got.columns
