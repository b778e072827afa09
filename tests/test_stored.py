"""Stored tables: upserts in place, layouts that are used, counts with the load,
rejected values, pages by key; cohorts by a prefix table and many at once."""

import glob
import os
import random

import pytest
from conftest import SF0001, rows_of
from pyspark.sql import functions as F

from stayflow import jobs as J
from stayflow.operators import codes as K
from stayflow.operators import rates as R
from stayflow.operators import tables as TB
from stayflow.plans import catalog as CAT
from stayflow.schemas import CLAIM_COLUMNS
from stayflow.sources import files as FL

RATES = "year int, st string, n int"
KEYS = ["year", "st"]


def rates_df(spark, rows):
    return spark.createDataFrame(rows, RATES)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]


# -- upsert in place ------------------------------------------------------------

def test_upsert_in_place_rewrites_touched_partitions_only(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    TB.upsert_in_place(path, rates_df(spark, [(2008, "01", 1), (2008, "02", 2), (2009, "01", 3)]), KEYS, "year")
    old = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/year=2008/*")}
    got = TB.upsert_in_place(path, rates_df(spark, [(2009, "01", 30), (2010, "03", 4)]), KEYS, "year")
    assert got.columns == ["year", "st", "n"] and [t for _, t in got.dtypes] == ["int", "string", "int"]
    want = [(2008, "01", 1), (2008, "02", 2), (2009, "01", 30), (2010, "03", 4)]
    assert rows_of(got) == want
    assert {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/year=2008/*")} == old
    again = TB.upsert_in_place(path, rates_df(spark, [(2009, "01", 30), (2010, "03", 4)]), KEYS, "year")
    assert rows_of(again) == want


@pytest.mark.parametrize("bad", [[(2009, "01", 5), (2009, "01", 6)], [(2009, None, 5)], [(None, "01", 5)]])
def test_a_failed_upsert_changes_nothing(spark, tmp_dir, bad):
    path = f"{tmp_dir}/t"
    TB.upsert_in_place(path, rates_df(spark, [(2008, "01", 1), (2009, "01", 3)]), KEYS, "year")
    old = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}
    with pytest.raises(Exception, match="duplicate or NULL key"):
        TB.upsert_in_place(path, rates_df(spark, [(2008, "07", 7), *bad]), KEYS, "year")
    assert {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)} == old


def test_upsert_in_place_needs_its_partition_among_the_keys(spark, tmp_dir):
    with pytest.raises(ValueError):
        TB.upsert_in_place(f"{tmp_dir}/t", rates_df(spark, []), ["st"], "year")


# -- layout ---------------------------------------------------------------------

def loaded(spark):
    i = CAT.Inputs(spark, SF0001)
    typed = lambda df, cols: df.select(*[FL.typed(n, t) for n, t in cols])
    from stayflow.schemas import BENEFICIARY_COLUMNS
    return typed(CAT._claims_extract(i), CLAIM_COLUMNS), typed(CAT._bene_extract(i), BENEFICIARY_COLUMNS)


def test_the_stored_layout_saves_the_person_shuffle(spark, tmp_dir):
    if spark.conf.get("spark.sql.adaptive.enabled") != "true":
        pytest.skip("the empty hot branch goes at run time")
    claims, bene = loaded(spark)
    c, n = J.store_by_person(claims, f"{tmp_dir}/c", "DESYNPUF_ID", ["CLM_ADMSN_DT", "CLM_ID"], 4)
    b, _ = J.store_by_person(bene, f"{tmp_dir}/b", "DESYNPUF_ID", [], 4)
    assert n == claims.count() == c.count()
    want = rows_of(R.readmission_rate(claims, bene, CAT.GAP))
    df = R.readmission_rate(c, b, CAT.GAP)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = final_plan(df)
        assert rows_of(df) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Window" in plan and "hashpartitioning(DESYNPUF_ID" not in plan


@pytest.mark.parametrize("hot", ["1", None])
def test_a_hot_person_is_not_put_in_one_bucket(spark, tmp_dir, hot):
    claims, bene = loaded(spark)
    person = F.when(F.col("CLM_ID").cast("long") % 3 == 0, F.lit(hot)).otherwise(F.col("DESYNPUF_ID"))
    skewed = claims.withColumn("DESYNPUF_ID", person)
    old = spark.conf.get("spark.stayflow.hotKeyRows", None)
    spark.conf.set("spark.stayflow.hotKeyRows", "100")
    try:
        c, _ = J.store_by_person(skewed, f"{tmp_dir}/c", "DESYNPUF_ID", ["CLM_ADMSN_DT", "CLM_ID"], 4)
        parts = c.where(F.col("DESYNPUF_ID").eqNullSafe(F.lit(hot))).select(F.input_file_name()).distinct().count()
        assert parts > 1 and rows_of(c.select("CLM_ID", "DESYNPUF_ID")) == rows_of(skewed.select("CLM_ID", "DESYNPUF_ID"))
        # The same rates from either layout, hot person or NULL.
        got = rows_of(R.readmission_rate(c, bene, CAT.GAP))
        assert got == rows_of(R.readmission_rate(skewed, bene, CAT.GAP, hot_key_rows=-1))
    finally:
        if old is None:
            spark.conf.unset("spark.stayflow.hotKeyRows")
        else:
            spark.conf.set("spark.stayflow.hotKeyRows", old)


def tallied(spark, rows=1000):
    """Rows of ten persons, and how many of them were computed."""
    seen = spark.sparkContext.accumulator(0)

    def tally(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(rows, numPartitions=3).mapInArrow(tally, "id long")
    return df.select((F.col("id") % 10).alias("p"), "id"), seen


def test_storing_by_person_reads_the_source_once(spark, tmp_dir):
    if spark.conf.get("spark.sql.adaptive.enabled") != "true":
        pytest.skip("without AQE the persons are counted first")
    df, seen = tallied(spark)
    stored, n = J.store_by_person(df, f"{tmp_dir}/t", "p", ["id"], 4)
    assert seen.value == n == 1000 and rows_of(stored) == rows_of(spark.range(1000).select(F.expr("id % 10 AS p"), "id"))


def test_a_found_hot_person_leaves_no_table_behind(spark, tmp_dir):
    old = spark.conf.get("spark.stayflow.hotKeyRows", None)
    spark.conf.set("spark.stayflow.hotKeyRows", "99")
    before = {t.name for t in spark.catalog.listTables()}
    try:
        df, _ = tallied(spark)
        stored, n = J.store_by_person(df, f"{tmp_dir}/t", "p", ["id"], 4)
    finally:
        if old is None:
            spark.conf.unset("spark.stayflow.hotKeyRows")
        else:
            spark.conf.set("spark.stayflow.hotKeyRows", old)
    assert {t.name for t in spark.catalog.listTables()} == before
    want = rows_of(spark.range(1000).select(F.expr("id % 10 AS p"), "id"))
    assert n == 1000 and rows_of(stored) == rows_of(spark.read.parquet(f"{tmp_dir}/t")) == want


def test_a_large_bucket_is_dealt_to_several_tasks(spark, tmp_dir):
    if spark.conf.get("spark.sql.adaptive.enabled") != "true":
        pytest.skip("without AQE the persons are counted first")
    claims, bene = loaded(spark)
    person = F.when(F.col("CLM_ID").cast("long") % 3 == 0, F.lit("1")).otherwise(F.col("DESYNPUF_ID"))
    claims.withColumn("DESYNPUF_ID", person).repartition(8).write.parquet(f"{tmp_dir}/in")
    skewed = spark.read.parquet(f"{tmp_dir}/in")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(size)
    spark.conf.set(size, "32k")
    try:
        c, n = J.store_by_person(skewed, f"{tmp_dir}/c", "DESYNPUF_ID", ["CLM_ADMSN_DT", "CLM_ID"], 4)
    finally:
        spark.conf.set(size, old)
    assert c.where("DESYNPUF_ID = '1'").select(F.input_file_name()).distinct().count() > 1
    assert n == c.count() == claims.count()
    assert rows_of(R.readmission_rate(c, bene, CAT.GAP)) == rows_of(R.readmission_rate(skewed, bene, CAT.GAP))


@pytest.mark.parametrize("dtype,read", [("date", "try_to_date("), ("int", "try_cast("), ("decimal(10,2)", "try_cast(")])
def test_a_value_is_read_once(spark, dtype, read):
    """What tests a text's type gives the value too."""
    from pyspark.sql import types as T
    texts = spark.createDataFrame([("20080229",), (" ",), (None,), ("",)], "x string")
    got = texts.select(FL.typed("x", T.DataType.fromDDL(dtype)))
    assert got._jdf.queryExecution().analyzed().toString().split("\n")[0].count(read) == 1
    assert [r[0] is None for r in got.collect()] == [False, True, True, True]
    with pytest.raises(Exception, match="cannot"):
        texts.select(F.lit("20080431x").alias("x")).select(FL.typed("x", T.DataType.fromDDL(dtype))).collect()


# -- counts ---------------------------------------------------------------------

def test_counts_come_with_the_write(spark, tmp_dir):
    scanned = spark.sparkContext.accumulator(0)

    def tally(batches):
        for b in batches:
            scanned.add(b.num_rows)
            yield b
    df = spark.range(1000, numPartitions=3).mapInArrow(tally, "id long")
    got = rows_of(TB.write_counted({"a": (df, f"{tmp_dir}/a"), "empty": (df.where("id < 0"), f"{tmp_dir}/b")}))
    assert got == [("a", 1000), ("empty", 0)]
    assert scanned.value == 2000  # once for each table


# -- rejected values --------------------------------------------------------------

def test_rejected_values_and_lines(spark, tmp_dir):
    from pyspark.sql import types as T
    cols = [("id", T.StringType()), ("d", T.DateType()), ("n", T.IntegerType()), ("x", T.DecimalType(5, 2))]
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write("id,d,n,x,more\n1,20080101,5,1.25,m\n2,20080431,x,9,m\n3,,,,m\n4,20080102\n5,20080103,7,99999,m\n"
                '6," 20080104 ", 8 ,1,m\n7,20080105,1,2,m,extra\n')
    with open(f"{tmp_dir}/b.csv", "w") as f:
        f.write("id,d,n,x,more\n8,1999-01-01,1,1,m\n")
    got = FL.load_checked(spark, tmp_dir, cols, keys=["id"])
    assert {r.id for r in got.good.collect()} >= {"1", "3"}
    assert got.good.dtypes == [("id", "string"), ("d", "date"), ("n", "int"), ("x", "decimal(5,2)")]
    bad = {(os.path.basename(r.file), r.id, r.column, r.value) for r in got.rejected.collect()}
    assert {("a.csv", "2", "d", "20080431"), ("a.csv", "2", "n", "x"), ("a.csv", "5", "x", "99999"),
            ("b.csv", "8", "d", "1999-01-01")} <= bad
    assert {v for _, i, c, v in bad if c is None} == {"4,20080102", "7,20080105,1,2,m,extra"}
    # Every line is in exactly one of the two.
    assert got.good.count() + len({(f, i) for f, i, *_ in bad}) == 8
    with pytest.raises(ValueError):
        FL.load_checked(spark, tmp_dir, [("absent", T.StringType())])


# -- pages by key -----------------------------------------------------------------

def test_pages_by_key_are_the_sorted_rows(spark, tmp_dir):
    rng = random.Random(1)
    rows = list({(rng.choice([None, *range(6)]), rng.choice([None, "a", "b", "c", f"s{k % 20}"])) for k in range(300)})
    df = spark.createDataFrame(rows, "a int, s string")
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))
    for files in (1, 7):
        TB.store_sorted(df, f"{tmp_dir}/t{files}", ["a", "s"], files=files)
        got, last = [], None
        while True:
            page = [tuple(r) for r in TB.page_after(spark, f"{tmp_dir}/t{files}", ["a", "s"], last, 9).collect()]
            if not page:
                break
            got, last = got + page, page[-1]
        assert got == want


def test_a_late_page_reads_no_earlier_rows(spark, tmp_dir):
    df = spark.range(200_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    TB.store_sorted(df, f"{tmp_dir}/t", ["k"], files=20, row_group_bytes=64 << 10)
    page = TB.page_after(spark, f"{tmp_dir}/t", ["k"], [99_989], 10)  # page 10,000
    assert [r.k for r in page.collect()] == list(range(99_990, 100_000))
    plan = page._jdf.queryExecution().executedPlan()
    scan = plan.toString()
    assert "PushedFilters" in scan and "GreaterThan" in scan and "LessThan" in scan
    # Rows that leave the scan: those of the row groups around the page.
    stack, read = [plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan], None
    while stack:
        node = stack.pop()
        if "FileSourceScanExec" in node.getClass().getSimpleName():
            read = node.metrics().apply("numOutputRows").value()
        stack += [node.children().apply(k) for k in range(node.children().size())]
        if "QueryStage" in node.getClass().getSimpleName():
            stack.append(node.plan())
    assert read is not None and read < 30_000


# -- cohorts ----------------------------------------------------------------------

def test_prefixes_by_hash(spark):
    rng = random.Random(4)
    codes = [None, "", "A", *("".join(rng.choices("AB0", k=rng.randint(1, 5))) for _ in range(200))]
    prefixes = [(p, c) for p, c in {(rng.choice(codes), rng.choice("xyz")) for _ in range(25)}]
    df = spark.createDataFrame([(c, k) for k, c in enumerate(codes)], "code string, cohort long")
    table = spark.createDataFrame(prefixes, "prefix string, cohort string")
    hit = lambda c, of="xyz": sorted({n for p, n in prefixes if n in of and p is not None and c is not None and c.startswith(p)})
    assert rows_of(K.cohort_by_prefixes(df, "code", table)) == sorted(((c, k) for k, c in enumerate(codes) if hit(c)), key=repr)
    got = {r.code: r.cohorts for r in K.with_cohorts(df, "code", table).collect()}
    assert got == {c: hit(c) for c in codes}
    none = table.where("prefix = 'no such'")
    assert K.cohort_by_prefixes(df, "code", none).count() == 0 and K.with_cohorts(df, "code", none).count() == len(codes)


def test_no_nested_loops_and_one_claims_shuffle(spark):
    if spark.conf.get("spark.sql.adaptive.enabled") != "true":
        pytest.skip("the empty hot branch goes at run time")
    q = CAT.QUERIES
    for name in ("cohort_by_prefix_table", "rates_for_cohort_table"):
        plan = q[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    plan = final_plan(q["rates_for_five_cohorts"](spark, SF0001))
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning(person_id" in x and "admit" not in x]
    assert plan.count("Window [") <= 2 + 1 and len([x for x in shuffles if "ENSURE" in x]) <= 3
    # Each cohort as if it were alone.
    i = CAT.Inputs(spark, SF0001)
    got = R.rates_for_cohorts(i.claims_icd10().join(i.claims.drop("pay_amt", "admit_dt", "disch_dt", "d1", "person_id"), "claim_id"),
                              None, i.bene, i.state, CAT.STRICT, cohorts={"b": ["B"], "all": "icd10_code IS NOT NULL"},
                              flag_rules=CAT.GAP, c=CAT.C, b=CAT.B, s=CAT.ST)
    want = i.cohort_rates(CAT.GAP, cohort=["B"])
    assert rows_of(got.where("cohort = 'b'").drop("cohort")) == rows_of(want)
