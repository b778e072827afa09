"""Stored, rolled-up and incrementally refreshed rates."""

import random
import re

import pytest
from conftest import SF0001, rows_of
from pyspark.sql import functions as F

from stayflow.operators import bitmaps as BM
from stayflow.operators import rates as R
from stayflow.plans import catalog as CAT
from stayflow.sources import adapter as A
from stayflow.streaming import refresh as RF

C, B = A.LAYOUT.claims, A.LAYOUT.bene
KEYS = ["year", B.state, B.sex]
COUNTS = ["readmissions", "total_admissions"]


def claims_of(spark, n=400, seed=1, null_planned=False):
    """Few persons, claim ids shared by rows and persons, NULL ids and dates."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        day = f"199{rng.randint(5, 8)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
        dx = [rng.choice(["Brand#1", "Brand#7", "Brand#30"]) for _ in range(9)] if rng.random() < .9 else [None] * 9
        claim = rng.choice([k, k, k, rng.randint(0, n)])
        if rng.random() < .05:
            claim, dx[0] = None, dx[0] if null_planned else "Brand#1"
        rows.append((rng.choice([None, *range(25)]), claim, day if rng.random() < .95 else None, rng.randint(0, 20), 1.0, *dx))
    d = ", ".join(f"d{i} string" for i in range(1, 10))
    df = spark.createDataFrame(rows, f"person_id long, claim_id long, admit string, days int, pay_amt double, {d}")
    admit = F.col("admit").cast("date")
    disch = F.when(F.col("days") > 0, F.date_add(admit, F.col("days")))
    return df.withColumns({"admit_dt": admit, "disch_dt": disch}).drop("admit", "days")


def bene_of(spark):
    rows = [(p, s, "1" if p % 2 else "2") for p in range(25) for s in ({p % 3, (p + p % 2) % 3})]
    return spark.createDataFrame(rows, "person_id long, state_code long, sex string")


RULES = CAT.GAP


def batch(claims, bene):
    return R.readmission_rate(claims, bene, RULES, c=C, b=B).select(*KEYS, *COUNTS).where("total_admissions > 0")


def state_in(spark, folder):
    return RF.RateState(spark, folder, RULES, C, B, slices=4)


@pytest.mark.parametrize("seed", [1, 2])
def test_halves_equal_the_whole(spark, tmp_dir, seed):
    claims, bene = claims_of(spark, seed=seed).cache(), bene_of(spark)
    state = state_in(spark, tmp_dir)
    part = F.pmod(F.xxhash64(*claims.columns), F.lit(3))
    for k in range(3):
        got = RF.append(state, claims.where(part == k), bene)
        assert rows_of(got, [*KEYS, *COUNTS]) == rows_of(batch(claims.where(part <= k), bene))
    assert state.runs() == [0, 1, 2]
    # A run delivered again, and an empty one, change nothing.
    RF.append(state, claims.where(part == 1), bene, run=1)
    RF.append(state, claims.limit(0), bene)
    assert state.runs() == [0, 1, 2] and rows_of(state.rates(), [*KEYS, *COUNTS]) == rows_of(batch(claims, bene))


def test_a_failed_run_changes_nothing_and_can_be_repeated(spark, tmp_dir):
    claims, bene = claims_of(spark).cache(), bene_of(spark)
    state = state_in(spark, tmp_dir)
    RF.append(state, claims.where("claim_id % 2 = 0"), bene)
    before = rows_of(state.rates())
    rest = claims.where("claim_id % 2 = 1 OR claim_id IS NULL")
    bad = bene.withColumn(B.sex, F.when(F.col("person_id") == 3, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col(B.sex)))
    with pytest.raises(Exception, match="lost"):
        RF.append(state, rest, bad)
    assert state.runs() == [0] and rows_of(state.rates()) == before
    assert rows_of(RF.append(state, rest, bene), [*KEYS, *COUNTS]) == rows_of(batch(claims, bene))


def test_only_touched_persons_are_read(spark, tmp_dir):
    claims, bene = claims_of(spark).cache(), bene_of(spark)
    state = state_in(spark, tmp_dir)
    RF.append(state, claims.where("person_id IS NULL OR person_id <> 3"), bene)
    RF.append(state, claims.where("person_id = 3"), bene)
    df = RF.claims_of_touched(state, 1)
    assert {r.person_id for r in df.collect()} == {3}
    # One slice of each run is scanned.
    assert re.search(r"PartitionFilters: \[[^\]]*slice#\d+ (= \d|IN \(\d\))", df._jdf.queryExecution().toString())
    assert spark.read.parquet(state.path("rows", 1)).where("person_id <> 3").isEmpty()


def test_a_planned_stay_without_id_empties_the_rates(spark, tmp_dir):
    claims, bene = claims_of(spark, null_planned=True).cache(), bene_of(spark)
    state = state_in(spark, tmp_dir)
    RF.append(state, claims.where("claim_id IS NOT NULL"), bene)
    assert state.rates().count() > 0
    RF.append(state, claims.where("claim_id IS NULL"), bene)
    assert state.rates().count() == batch(claims, bene).count() == 0


def test_refresh_on_arrival(spark, tmp_dir):
    claims, bene = claims_of(spark).cache(), bene_of(spark)
    src, state = f"{tmp_dir}/in", state_in(spark, f"{tmp_dir}/state")
    half = F.pmod(F.xxhash64(*claims.columns), F.lit(2))
    for k in range(2):
        claims.where(half == k).coalesce(1).write.mode("append").parquet(src)
        arrivals = spark.readStream.schema(claims.schema).option("maxFilesPerTrigger", 1).parquet(src)
        RF.refresh_on_arrival(state, arrivals, bene, f"{tmp_dir}/checkpoint").awaitTermination()
    assert len(state.runs()) == 2
    assert rows_of(state.rates(), [*KEYS, *COUNTS]) == rows_of(batch(claims, bene))


@pytest.mark.parametrize("by", [KEYS, ["year"], [B.state], [B.sex, "year"], []])
def test_roll_up_is_exact(spark, by):
    claims, bene = claims_of(spark), bene_of(spark)
    pairs = R.episode_pairs(claims, bene, RULES, {B.state: B.state, B.sex: B.sex}, c=C, b=B)
    got = BM.rolled_up(BM.rate_bitmaps(pairs, KEYS, C.claim), by).where("total_admissions > 0")
    want = R.counted(R.episode_pairs(claims, bene, RULES, {x: x for x in by if x != "year"}, c=C, b=B, with_year="year" in by),
                     by, C)
    assert rows_of(got.select(*by, *COUNTS)) == rows_of(want.where("total_admissions > 0").select(*by, *COUNTS))


def test_a_group_of_claims_without_id_exists(spark):
    rows = [(None, "a", True, True, False), (1, "b", True, True, False), (1, "a", True, True, False), (2, "b", True, False, True)]
    pairs = spark.createDataFrame(rows, "claim_id long, k string, __in boolean, __f boolean, __p boolean")
    fine, planned = pairs.where("not __p"), pairs
    for df, want in ((fine, [("a", 1, 1), ("b", 1, 1)]), (planned, [("a", 1, 1), ("b", 1, 1)])):
        assert rows_of(R.counted(df, ["k"], C)) == want
        kept = BM.settled(df, ["k"], C.claim)
        assert rows_of(BM.rolled_up(BM.claim_bitmaps(kept, BM.number_claims(kept, C.claim, ["k"]), C.claim, ["k"], "__f"), ["k"])) == want
    alone = fine.where("claim_id IS NULL")
    assert rows_of(R.counted(alone, ["k"], C)) == [("a", 0, 0)]


def test_no_set_is_collected(spark):
    for name in ("state_rates", "readmission_rate", "state_rates_for_cohort_gap"):
        plan = CAT.QUERIES[name](spark, SF0001)._jdf.queryExecution().toString()
        assert "collect_set" not in plan and "ObjectHashAggregate" not in plan
