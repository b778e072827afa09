"""Conversation repair against a brute-force version: every cheapest text of
edits is kept and compared."""

import hashlib
import random
import zlib

import pytest
from edge_rows import rows_of
from pyspark.sql import functions as F

from stayflow.llm import turn_repair as T

SPACE = " \t\n\x0b\x0c\r"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def cheapest(turns):
    """(cost, edits, repaired turns) of [(role, text, fault)], all ways."""
    ways = {"": (0, "", ())}

    def better(to, state, way):
        if state not in to or way[:2] < to[state][:2]:
            to[state] = way

    def inserted(ways):
        for _ in range(3):
            for s, (c, e, r) in list(ways.items()):
                for i, q in NEXT[s].items():
                    if i != "s":
                        better(ways, q, (c + 5, e + "I", (*r, ({"u": "user", "a": "assistant"}[i], ""))))
    for role, text, fault in turns:
        inserted(ways)
        after = {}
        for s, (c, e, r) in ways.items():
            better(after, s, (c + 2, e + "D", r))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                for i, q in NEXT[s].items():
                    if role[:1] == i:
                        better(after, q, (c + more, e + "K", (*r, (role, text))))
                    if i != "s":
                        better(after, q, (c + more + 1, e + "R", (*r, ({"u": "user", "a": "assistant"}[i], text))))
        ways = after
    inserted(ways)
    return min(w[:2] + (w[2],) for s, w in ways.items() if s in ("", "a"))


def brute(rows):
    """Reports of [(conv, turn, role, text, copies)]."""
    out = []
    for conv in {r[0] for r in rows}:
        turns = []
        for _, turn, role, text, copies in sorted((r for r in rows if r[0] == conv), key=lambda r: (
                r[1] is not None, r[1] or 0, " " if r[2] is None else r[2], " " if r[3] is None else r[3])):
            turns += [(turn, " " if role is None else role, " " if text is None else text)] * copies
        seen, coded = set(), []
        for _, role, text in turns:
            last = text.rstrip(SPACE)[-1:]
            fault = ("blank" if not last else "duplicate" if (role, text) in seen else
                     "truncated" if last not in (".", "!", "?") else None)
            seen.add((role, text))
            coded.append((role, text, fault))
        cost, audit, made = cheapest(coded)
        faults = [f for *_, f in coded]
        known = [t for t, *_ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(coded, coded[1:], strict=False))
        text = "\n".join(f"{r}:{t}" for r, t in made)
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def random_rows(seed, convs=60, most=14):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Well", "", " \n", None, "a.\u0085", "Over\nthere?  ", "ok", "Fine."]
    rows = []
    for conv in [None, -4, *range(convs)]:
        for t in range(rng.randint(1, most)):
            turn = rng.choice([None, t, t, t, t + 3, -2])
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "", None, "summary", "Über"]),
                         rng.choice(texts) if rng.random() < .6 else f"text {rng.randint(0, 9)}.", rng.choice([0, 1, 1, 1, 2, 5])))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, copies long"


@pytest.mark.parametrize("limits", [{}, {"whole": 3, "block": 2}, {"whole": 0, "block": 1}, {"most": 8, "block": 5}])
def test_reports_by_brute_force(spark, limits):
    rows = random_rows(len(limits) + 5)
    # Clashing names and repeated rows.
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(7) for c in ("place", "key", "state", "large", "fault")})
    assert rows_of(T.report(df, **limits)) == brute(rows)


def test_any_cut_of_a_long_conversation(spark):
    rows = [(1, t, random.Random(t).choice(["user", "assistant", "system"]), f"{t % 700}" + "." * (t % 3), 1)
            for t in range(3000)] + [(1, 3000 + t, "user", "again.", 1) for t in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(T.report(df, whole=10, block=64)) == rows_of(T.report(df, whole=10 ** 6)) == brute(rows)


def test_the_repaired_turns_are_legal(spark):
    rows = random_rows(3)
    for limits in ({}, {"whole": 2, "block": 2}):
        edited = T.repair(spark.createDataFrame(rows, SCHEMA), **limits)
        got = {}
        for r in T.repaired(edited).orderBy("conv_id", "place", "part").collect():
            got.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        for conv, *_, digest in brute(rows):
            assert hashlib.sha256("\n".join(got.get(conv, [])).encode()).hexdigest() == digest


def test_ties_take_the_least_text():
    for fault in (0, 1):
        for turns in ("uau", "uua", "ssua", "aua", "uaau", "sasu", "uuaa", "auuaas", "s", "u", "a", ""):
            rows = [(i, f"{k}." if not fault else f"{k}", "truncated" if fault else None) for k, i in enumerate(turns)]
            want = cheapest([({"u": "user", "a": "assistant", "s": "system"}[r], t, f) for r, t, f in rows])[1]
            done = T.edits_of([(i, fault, 1) for i in turns], T.START, None) if turns else []
            assert "".join(e for e, _ in done) == want


def test_very_long_and_empty(spark):
    text = "w " * 2_000_000 + "."
    df = spark.createDataFrame([(1, 0, "user", text, 1), (1, 1, "assistant", text, 1)], SCHEMA)
    want = hashlib.sha256(f"user:{text}\nassistant:{text}".encode()).hexdigest()
    for limits in ({}, {"most": 1000}):
        assert rows_of(T.report(df, **limits)) == [(1, 0, 0, 0, 0, 0, 0, "KK", want)]
    assert T.report(df.limit(0)).count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!\nThree") for c in (None, 0, 5, 77) for t in (None, *range(40))] + [(5, 3, None, None)]
    got = rows_of(T.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else text.translate({ord(x): None for x in ".!?"}) if kind == 2 else text
        want.append((c, t, "user" if kind == 4 else role, text, {0: 0, 3: 2}.get(kind, 1)))
    assert got == sorted(want, key=repr)
