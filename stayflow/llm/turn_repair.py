"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation is legal if its turns' role initials read ``(s?(ua)+)?``.  Turns
are kept, given the other of the roles user and assistant, deleted, or inserted
with empty text; the cheapest edits are found, of equally cheap ones those whose
initials (D, I, K, R) are least as text.

Four states are enough: at the start, after s, after u, after a.  A turn is a
4 x 4 step table: the cost of coming from one state to another over it, insertions
before it included.  Hirschberg's method: a forward cost vector over the first half
of the turns and a backward one over the second meet mid-conversation; the state
that their least sum crosses is fixed, and both halves are solved alike, in linear
space.  Beside each cost the forward vector holds the rank of its edits among
the four states.  That settles ties: edits that reach the middle end with that
of the last turn before it, so none is the beginning of another, and which full
text is least shows before the middle.

Steps compose: a block of turns is again a 4 x 4 table of costs and ranks.
A conversation of at most WHOLE turns and BYTES bytes is solved within the task that
streams its sorted turns.  A larger one is sorted by range over many tasks and cut
into blocks; block tables are composed to parts (of one sorted partition) and to the
conversation, states at the borders are chosen downwards, and each block is then
solved by itself.

Order of turns: by turn, null first; ties by role and text (their first 64
characters, then whole).  Repeated rows stand beside each other.

Defined results: a null role or text is one space.  A null conv_id is one
conversation.  A turn is blank if its text has no character but white space;
duplicate if an earlier turn of the conversation has its role and text; truncated if
its last character before white space is none of ``.!?``.  Very long texts move with
their turn, one at a time.  A conversation without rows and an empty table give no
rows; columns beside the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_batches, map_rows, runs, store

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
LEGAL_ENDS = (START, ASSISTANT)
FULL_ROLE = {"u": "user", "a": "assistant"}
# What an edit costs, and what a truncated turn adds if it stays.
KEEP, REROLE, DELETE, INSERT, STAYS_TRUNCATED = 0, 1, 2, 5, 5
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
FAULTS = (None, "truncated", "blank", "duplicate")
INF = 10 ** 12

# Turns and bytes of a conversation that one task solves at once; turns of a
# block of a larger one.
WHOLE, BYTES, BLOCK = 4096, 1 << 25, 4096


# -- steps ----------------------------------------------------------------------
# A step is a tuple of four rows (from each state) of four entries (to each
# state): None, or (cost, rank among the entries of its row).

def ranked(row: list[tuple | None]) -> tuple:
    """Entries (cost, comparable) as (cost, rank)."""
    order = {x: k for k, x in enumerate(sorted(e[1] for e in row if e))}
    return tuple(e and (e[0], order[e[1]]) for e in row)


def insertions(state: int) -> Iterator[tuple[int, int, str]]:
    """(state, cost, edits) after no, one or two insertions; more never pay."""
    cost, edits = 0, ""
    for _ in range(3):
        yield state, cost, edits
        state = NEXT["a" if state == USER else "u", state]
        cost, edits = cost + INSERT, edits + "I"


@lru_cache(maxsize=64)
def turn_edits(initial: str, fault: int) -> tuple:
    """From each state to each state: the cheapest, then least edits of one
    turn, as (cost, edits)."""
    out = []
    for p in STATES:
        best: dict[int, tuple[int, str]] = {}
        for at, paid, edits in insertions(p):
            ways = [(at, DELETE, "D")]
            if fault in (FINE, TRUNCATED):
                more = STAYS_TRUNCATED if fault == TRUNCATED else 0
                ways += [(NEXT[initial, at], KEEP + more, "K")] if (initial, at) in NEXT else []
                ways += [(NEXT["a" if at == USER else "u", at], REROLE + more, "R")]
            for q, cost, edit in ways:
                best[q] = min(best.get(q, (INF, "")), (paid + cost, edits + edit))
        out.append(tuple(best.get(q) for q in STATES))
    return tuple(out)


@lru_cache(maxsize=64)
def turn_step(initial: str, fault: int) -> tuple:
    return tuple(ranked(list(row)) for row in turn_edits(initial, fault))


def alone(state: int) -> tuple:
    return tuple((0, 0) if s == state else None for s in STATES)


@lru_cache(maxsize=1 << 14)
def lowered(vector: tuple) -> tuple[tuple, int]:
    """A vector with its least cost taken off, so that few differ."""
    least = min(e[0] for e in vector if e)
    return tuple(e and (e[0] - least, e[1]) for e in vector), least


@lru_cache(maxsize=1 << 14)
def forward_step(vector: tuple, step: tuple) -> tuple[tuple, int]:
    out = []
    for q in STATES:
        ways = [(vector[p][0] + step[p][q][0], (vector[p][1], step[p][q][1])) for p in STATES if vector[p] and step[p][q]]
        out.append(min(ways) if ways else None)
    return lowered(ranked(out))


@lru_cache(maxsize=1 << 14)
def backward_step(vector: tuple, step: tuple) -> tuple:
    out = [min((step[p][q][0] + vector[q] for q in STATES if step[p][q] and vector[q] < INF), default=INF) for p in STATES]
    least = min(out)
    return tuple(INF if x >= INF else x - least for x in out)


def forward(steps: list, lo: int, hi: int, vector: tuple) -> tuple[tuple, int]:
    """Costs (over the least) and ranks after steps lo to hi, and the least cost."""
    total = 0
    for k in range(lo, hi):
        vector, more = forward_step(vector, steps[k])
        total += more
    return vector, total


def backward(steps: list, lo: int, hi: int, state: int) -> tuple:
    vector = tuple(0 if s == state else INF for s in STATES)
    for k in range(hi - 1, lo - 1, -1):
        vector = backward_step(vector, steps[k])
    return vector


def crossings(steps: list, start: int, end: int) -> list[int]:
    """State after each step on the audit-least cheapest way from ``start`` to
    ``end``."""
    states = [end] * len(steps)

    def solve(lo: int, hi: int, p: int, q: int) -> None:
        if hi - lo < 2:
            return
        mid = (lo + hi) // 2
        ahead, _ = forward(steps, lo, mid, alone(p))
        behind = backward(steps, mid, hi, q)
        _, _, s = min((ahead[s][0] + behind[s], ahead[s][1], s) for s in STATES if ahead[s] and behind[s] < INF)
        states[mid - 1] = s
        solve(lo, mid, p, s)
        solve(mid, hi, s, q)
    solve(0, len(steps), start, end)
    return states


def closing(vector: tuple) -> tuple[int, str]:
    """The state to end in, and the insertions after it that make it legal."""
    ways = [(vector[s][0] + cost, vector[s][1], s, edits) for s in STATES if vector[s]
            for at, cost, edits in insertions(s) if at in LEGAL_ENDS]
    return min(ways)[2:]


def summary(steps: list) -> tuple:
    """The steps composed to one."""
    out = []
    for p in STATES:
        vector, total = forward(steps, 0, len(steps), alone(p))
        out.append(tuple(e and (e[0] + total, e[1]) for e in vector))
    return tuple(out)


def edits_of(turns: list[tuple[str, int, int]], start: int, end: int | None) -> list[tuple[str, str]]:
    """Edits of each turn (initial, fault, copies) and the initials of the
    turns that come of them; with no ``end``, the end is free and the last
    turn's edits hold the insertions after it."""
    steps = [turn_step(i, f) for i, f, _ in turns]
    tail = ""
    if end is None:
        end, tail = closing(forward(steps, 0, len(steps), alone(start))[0])
    out, at = [], start
    for k, q in enumerate(crossings(steps, start, end)):
        initial, fault, copies = turns[k]
        edits = turn_edits(initial, fault)[at][q][1] + "D" * (copies - 1) + tail * (k == len(turns) - 1)
        made = ""
        for e in edits:
            if e != "D":
                role = initial if e == "K" else "a" if at == USER else "u"
                made, at = made + role, NEXT[role, at]
        out.append((edits, made))
    return out


# -- turns ----------------------------------------------------------------------

TURN = "conv_id long, turn long, role string, text string, copies long, state int"
EDITED = ("conv_id long, place long, turn long, role string, text string, copies long, fault string, edits string, "
          "made string")
EDITED_ARROW = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
                          ("text", pa.string()), ("copies", pa.int64()), ("fault", pa.string()), ("edits", pa.string()),
                          ("made", pa.string())])


def with_state(turns: DataFrame) -> DataFrame:
    """Columns of TURN: ``state`` is FINE, TRUNCATED or BLANK.  ``copies`` is
    1 unless the input has it; 0 stands for a turn that is not there."""
    copies = F.col("copies").cast("long") if "copies" in turns.columns else F.lit(1).cast("long")
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    last = F.right(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    state = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
                        copies.alias("copies"), state.alias("state"))


def order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.left("role", F.lit(64)),
            F.left("text", F.lit(64))]


def whole_order() -> list[Column]:
    return [*order(), F.col("role"), F.col("text")]


def first_letter(role: str) -> str:
    """The role's initial, as far as it matters to an edit."""
    return role[:1] if role[:1] in ("s", "u", "a") else ""


def solved(turns: Iterable[tuple]) -> list[tuple]:
    """Rows of EDITED of one whole conversation, from its sorted rows of TURN."""
    rows, seen, coded = [], set(), []
    for conv, turn, role, text, copies, state in turns:
        if not copies:
            continue
        if state != BLANK and (role, text) in seen:
            state = DUPLICATE
        seen.add((role, text))
        rows.append((conv, turn, role, text, copies, state))
        coded.append((first_letter(role), state, copies))
    return [(conv, k, turn, role, text, copies, FAULTS[state], *done)
            for k, ((conv, turn, role, text, copies, state), done)
            in enumerate(zip(rows, edits_of(coded, START, None), strict=True))]


def large_conversations(turns: DataFrame, whole: int = WHOLE, most: int = BYTES) -> DataFrame:
    """conv_id of the conversations that no single task solves (at most rows /
    ``whole`` and bytes / ``most`` of them)."""
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    found, _ = store(sizes.where((F.col("n") > whole) | (F.col("bytes") > most)).select(F.col("conv_id").alias("large")),
                     "large-conversations")
    return found


def edits_of_large(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of EDITED of large conversations, in no order."""
    # Copies combine before the shuffle, so that no heap of them meets; then
    # sorted ranges, which split a conversation wherever it is long.
    single = turns.groupBy("conv_id", "turn", "role", "text", "state").agg(F.sum("copies").alias("copies"))
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.sha2(F.concat_ws(":", F.octet_length("role"), "role", "text"), 256)
    ranged = single.repartitionByRange(n, *order()).sortWithinPartitions(*whole_order())
    placed, _ = store(ranged.withColumn("place", F.monotonically_increasing_id()).withColumn("key", key), "placed")
    # The first turn with a role and text is no duplicate; its place tells it.
    firsts = placed.groupBy(F.col("conv_id").alias("c"), F.col("key").alias("k")).agg(F.min("place").alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k"))
    fault = F.when((F.col("state") != BLANK) & (F.col("place") > F.col("first")), DUPLICATE).otherwise(F.col("state"))
    coded, _ = store(placed.join(firsts, same).select(
        "conv_id", "place", F.regexp_extract("role", "^([sua])", 1).alias("initial"), fault.alias("fault"), "copies"), "coded")

    # Blocks of a part (a sorted partition: the upper bits of ``place``).
    part, number = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    at = ["conv_id", "part", "block"]
    blocks, _ = store(
        coded.select("conv_id", part.alias("part"), F.floor(number / block).cast("long").alias("block"), "place",
                     "initial", "fault", "copies")
        .groupBy(*at).agg(F.sort_array(F.collect_list(F.struct("place", "initial", "fault", "copies"))).alias("t"))
        .select(*at, F.col("t.place").alias("places"), F.col("t.initial").alias("initials"),
                F.col("t.fault").alias("faults"), F.col("t.copies").alias("copies")), "blocks")

    def summed():
        return lambda c, p, b, initials, faults: (c, p, b, packed(summary([
            turn_step(i, f) for i, f in zip(initials, faults, strict=True)])))
    tables, _ = store(map_rows(blocks.select(*at, "initials", "faults"), summed,
                               "conv_id long, part long, block long, step array<long>"), "block-tables")
    in_part = (tables.groupBy("conv_id", "part")
               .agg(F.sort_array(F.collect_list(F.struct("block", "step"))).alias("t"))
               .select("conv_id", "part", F.col("t.block").alias("blocks"), F.flatten("t.step").alias("steps")))

    def composed():
        return lambda c, p, blocks_, steps: (c, p, packed(summary(unpacked(steps))))
    parts = map_rows(in_part, composed, "conv_id long, part long, step array<long>")
    whole = (parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "step"))).alias("t"))
             .select("conv_id", F.col("t.part").alias("parts"), F.flatten("t.step").alias("steps")))

    def through():
        def row(conv, parts_, steps):
            steps = unpacked(steps)
            end, tail = closing(forward(steps, 0, len(steps), alone(START))[0])
            states = crossings(steps, START, end)
            return conv, parts_, [START, *states[:-1]], states, [""] * (len(parts_) - 1) + [tail]
        return row
    crossed = map_rows(whole, through, "conv_id long, parts array<long>, enter array<long>, leave array<long>, tail array<string>")
    borders = (crossed.select("conv_id", F.explode(F.arrays_zip("parts", "enter", "leave", "tail")).alias("x"))
               .select(F.col("conv_id").alias("c"), F.col("x.parts").alias("p"), "x.enter", "x.leave", "x.tail"))

    def within():
        def row(conv, part_, blocks_, steps, enter, leave, tail):
            states = crossings(unpacked(steps), enter, leave)
            return conv, part_, blocks_, [enter, *states[:-1]], states, [""] * (len(blocks_) - 1) + [tail]
        return row
    inner = map_rows(in_part.join(borders, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
                     .select("conv_id", "part", "blocks", "steps", F.col("enter").cast("long"), F.col("leave").cast("long"), "tail"),
                     within, "conv_id long, part long, blocks array<long>, enter array<long>, leave array<long>, tail array<string>")
    ways = (inner.select("conv_id", "part", F.explode(F.arrays_zip("blocks", "enter", "leave", "tail")).alias("x"))
            .select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("x.blocks").alias("b"), "x.enter", "x.leave",
                    "x.tail"))

    def lined():
        def row(places, initials, faults, copies, enter, leave, tail):
            done = edits_of(list(zip(initials, faults, copies, strict=True)), enter, leave)
            edits, made = map(list, zip(*done, strict=True))
            at_ = leave
            for _ in tail:
                role = "a" if at_ == USER else "u"
                edits[-1], made[-1], at_ = edits[-1] + "I", made[-1] + role, NEXT[role, at_]
            return places, edits, made
        return row
    joined = blocks.join(ways, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
                         & (F.col("block") == F.col("b")))
    solved_ = map_rows(joined.select("places", "initials", "faults", "copies", "enter", "leave", "tail"), lined,
                       "places array<long>, edits array<string>, made array<string>")
    lines = (solved_.select(F.explode(F.arrays_zip("places", "edits", "made")).alias("x"))
             .select(F.col("x.places").alias("place"), "x.edits", "x.made"))
    name = F.element_at(F.array(*(F.lit(f) for f in FAULTS)), F.col("fault") + 1)
    return (placed.select("conv_id", "place", "turn", "role", "text")
            .join(coded.select("place", "fault", "copies"), "place").join(lines, "place")
            .select("conv_id", "place", "turn", "role", "text", "copies", name.alias("fault"), "edits", "made"))


def packed(step: tuple) -> list[int]:
    """A step as 32 numbers; an impossible entry is (-1, -1)."""
    return [x for row in step for e in row for x in (e or (-1, -1))]


def unpacked(numbers: list[int]) -> list[tuple]:
    out = []
    for at in range(0, len(numbers), 32):
        e = [None if numbers[k] < 0 else (numbers[k], numbers[k + 1]) for k in range(at, at + 32, 2)]
        out.append(tuple(tuple(e[4 * p:4 * p + 4]) for p in STATES))
    return out


def streams(turns: DataFrame, **limits: int) -> tuple[DataFrame, DataFrame | None]:
    """Sorted rows of TURN of the conversations that a task solves whole, and
    rows of EDITED of the large ones, sorted; each conversation in one task."""
    block = limits.pop("block", BLOCK)
    rows = with_state(turns)
    there = rows.where("copies > 0")
    large = large_conversations(there, **limits)
    mine = lambda d: d.repartition("conv_id").sortWithinPartitions
    if large.isEmpty():
        return mine(rows)(*whole_order()), None
    same = F.col("conv_id").eqNullSafe(F.col("large"))
    cut = edits_of_large(there.join(large, same, "left_semi"), block)
    return (mine(rows.join(large, same, "left_anti"))(*whole_order()),
            mine(cut)(F.col("conv_id").asc_nulls_first(), "place"))


def repair(turns: DataFrame, **limits: int) -> DataFrame:
    """One row for each turn (repeated ones together): its fault, its edits
    and the role initials of the turns that come of it."""
    small, large = streams(turns, **limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches((r for _, rows in runs(batches) for r in solved(rows)), EDITED_ARROW)
    out = small.mapInArrow(run, EDITED)
    return out if large is None else out.unionByName(large)


def repaired(edited: DataFrame) -> DataFrame:
    """The legal conversations: conv_id, place and part (their order), role, text."""
    kept = F.translate("edits", "D", "")
    made = edited.select("conv_id", "place", "role", "text", "made", F.posexplode(F.split(kept, "")).alias("part", "edit"))
    initial = F.substring(F.col("made"), F.col("part") + 1, F.lit(1))
    full = F.when(initial == "u", "user").otherwise("assistant")
    return made.where("edit <> ''").select(
        "conv_id", "place", "part", F.when(F.col("edit") == "K", F.col("role")).otherwise(full).alias("role"),
        F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"))


REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
REPORT_ARROW = pa.schema([("conv_id", pa.int64()), *((n, pa.int64()) for n in (
    "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])
LEGAL_PAIRS = {"su", "ua", "au"}


def reported(conv: int | None, rows: Iterable[tuple]) -> tuple:
    """The report of one conversation's rows of EDITED, read once in order;
    only the audit grows with them."""
    count = dict.fromkeys(FAULTS, 0)
    illegal = cost = distinct = 0
    first = last = before = None
    audit, digest, lead = [], hashlib.sha256(), b""
    for _, _, turn, role, text, copies, fault, edits, made in rows:
        again = fault in ("blank", "duplicate")
        count[fault] += copies if again else 1
        count["duplicate"] += 0 if again else copies - 1
        initial = role[:1]
        illegal += copies - 1 + (before is not None and before + initial not in LEGAL_PAIRS)
        before = initial
        if turn is not None and turn != last:
            first, last, distinct = turn if first is None else first, turn, distinct + 1
        stays = "K" in edits or "R" in edits
        cost += sum(map({"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}.get, edits))
        cost += STAYS_TRUNCATED * (fault == "truncated" and stays)
        audit.append(edits)
        for edit, as_ in zip(edits.replace("D", ""), made, strict=True):
            name, said = (role if edit == "K" else FULL_ROLE[as_]), ("" if edit == "I" else text)
            digest.update(lead + f"{name}:{said}".encode())
            lead = b"\n"
    gaps = last - first + 1 - distinct if distinct else 0
    return (conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, "".join(audit),
            digest.hexdigest())


def report(turns: DataFrame, **limits: int) -> DataFrame:
    """Faults, cost, audit and digest of the repair of every conversation that
    has a row (if only of turns that are not there: zeros, no edits).  A digest is sequential: one task streams through its
    conversation's turns, holding the audit alone."""
    small, large = streams(turns, **limits)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches((reported(conv, solved(rows)) for conv, rows in runs(batches)), REPORT_ARROW)

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches((reported(conv, rows) for conv, rows in runs(batches)), REPORT_ARROW)
    out = small.mapInArrow(whole, REPORT)
    return out if large is None else out.unionByName(large.mapInArrow(streamed, REPORT))


def damage(conversations: DataFrame) -> DataFrame:
    """Turns with faults put in by crc32 of ``conv_id:turn`` (nulls: one
    space); a dropped turn has no copies, a repeated one two."""
    def said(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", said("conv_id"), said("turn"))) % 20
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(said("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))
