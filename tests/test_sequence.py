"""previous_in_sequence: split and plain plans equal a brute-force scan."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayflow.operators.sequence import Track, lag_by_entity, previous_in_sequence

SCHEMA = T.StructType([T.StructField("e", T.StringType()), T.StructField("d", T.DateType()),
                       T.StructField("k", T.LongType()), T.StructField("v", T.IntegerType()),
                       T.StructField("m", T.BooleanType())])


def make_rows(seed, n=400):
    rnd = random.Random(seed)
    base = dt.date(2008, 1, 1)
    rows = []
    for i in range(n):
        # one entity holds about a third of the rows; some NULL entities
        e = "hot" if rnd.random() < 0.33 else (None if rnd.random() < 0.05 else f"p{rnd.randrange(40)}")
        d = base + dt.timedelta(days=rnd.randrange(60))  # many same-day ties
        k = rnd.randrange(10_000) if rnd.random() > 0.02 else None
        rows.append((e, d, k, rnd.randrange(100), rnd.random() < 0.6))
    return rows


def brute(rows, member_idx=None):
    """For each row: v of the last earlier row (same e, by d, k NULLS LAST) that is a member."""
    def key(r):
        return (r[1], r[2] is None, r[2] if r[2] is not None else 0)
    out = {}
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(r[0], []).append(i)
    for idxs in groups.values():
        idxs.sort(key=lambda i: key(rows[i]))
        last = None
        for i in idxs:
            out[i] = last
            if member_idx is None or rows[i][member_idx]:
                last = rows[i][3]
    return out


def unique_order(rows):
    # Make (e, d, k) unique so the expected answer is well defined.
    seen, res = set(), []
    for r in rows:
        if (r[0], r[1], r[2]) not in seen:
            seen.add((r[0], r[1], r[2]))
            res.append(r)
    return res


@pytest.mark.parametrize("hk", [-1, 0, 5, 50])
@pytest.mark.parametrize("seed", [1, 2])
def test_lag_equals_brute_force(spark, hk, seed):
    rows = unique_order(make_rows(seed))
    df = spark.createDataFrame([r + (i,) for i, r in enumerate(rows)],
                               T.StructType(SCHEMA.fields + [T.StructField("i", T.IntegerType())]))
    got = lag_by_entity(df, "e", ["d", "k"], {"pv": F.col("v")}, hot_key_rows=hk)
    res = {r.i: r.pv for r in got.select("i", "pv").collect()}
    assert res == brute(rows)


@pytest.mark.parametrize("hk", [-1, 3])
def test_member_tracks(spark, hk):
    rows = unique_order(make_rows(7))
    df = spark.createDataFrame([r + (i,) for i, r in enumerate(rows)],
                               T.StructType(SCHEMA.fields + [T.StructField("i", T.IntegerType())]))
    got = previous_in_sequence(df, "e", ["d", "k"],
                               [Track(F.col("m"), {"pm": F.col("v")}), Track(F.lit(True), {"pa": F.col("v")})],
                               hot_key_rows=hk)
    res = {r.i: (r.pm, r.pa) for r in got.select("i", "pm", "pa").collect()}
    bm, ba = brute(rows, member_idx=4), brute(rows)
    assert res == {i: (bm[i], ba[i]) for i in bm}


def test_hot_branch_is_used(spark):
    rows = unique_order(make_rows(3))
    df = spark.createDataFrame(rows, SCHEMA)
    plan = lag_by_entity(df, "e", ["d", "k"], {"pv": F.col("v")}, hot_key_rows=5)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in text and "Window" in text


@pytest.mark.parametrize("hk", [-1, 3, 40])
def test_heaps_of_copies(spark, hk):
    rows = unique_order(make_rows(5, n=200))
    heap = rows[17]
    rows = rows + [heap] * 700 + [rows[3]] * 3 + [rows[50]] * 2   # one row holds most of the data
    df = spark.createDataFrame(rows, SCHEMA)
    got = previous_in_sequence(df, "e", ["d", "k"],
                               [Track(F.col("m"), {"pm": F.col("v")}), Track(F.lit(True), {"pa": F.col("v")})],
                               hot_key_rows=hk)
    res = sorted(((tuple(r[c] for c in ("e", "d", "k", "v", "m")), (r.pm, r.pa)) for r in got.collect()), key=repr)
    bm, ba = brute(rows, member_idx=4), brute(rows)
    assert len(res) == len(rows)
    assert res == sorted(((r, (bm[i], ba[i])) for i, r in enumerate(rows)), key=repr)
