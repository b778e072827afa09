"""Driver contract and the registered queries against their oracle SQL."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF0001

FAST = ["all_cause_readmission", "readmission_rate_gap", "state_rates", "state_rates_for_cohort",
        "claims_icd10", "cohort_breadth", "rates_preview", "upsert_rates", "exclude_planned",
        "rate_scaled", "label_rates", "refresh_state_rates", "load_claims", "load_beneficiaries",
        "all_cause_readmission_tied", "state_rates_for_broad_cohort", "cohort_breadth_ten_groups",
        "all_cause_readmission_skewed", "readmission_rate_skewed", "state_rates_rolled_up", "incremental_rates",
        "rates_for_five_cohorts", "rates_for_cohort_table", "cohort_by_prefix_table", "upsert_in_place", "state_rates_stored",
        "flag_view", "row_counts_with_load", "claims_page_by_key", "load_claims_checked", "rejected_claims"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 25
    assert df.columns == ["state_name", "readmissions", "total_admissions", "readmission_rate"]


def test_every_query_of_the_library_has_an_oracle():
    from stayflow.plans.catalog import QUERIES
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("nation", "customer", "part", "orders", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def _norm(rows):
    def v(x):
        return round(x, 9) if isinstance(x, float) else x
    return sorted((tuple(v(x) for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    orows = res.fetchall()
    idx = [ocols.index(c) for c in df.columns]
    assert _norm(df.collect()) == _norm([tuple(r[i] for i in idx) for r in orows])


def test_fixture_numbers(spark):
    q = E.queries()
    assert q["all_cause_readmission"](spark, SF0001).count() == 0
    assert q["all_cause_readmission_null_safe"](spark, SF0001).count() == 55
    assert q["all_cause_readmission_gap"](spark, SF0001).count() == 168
    r = q["readmission_rate_gap"](spark, SF0001).collect()
    assert (len(r), sum(x.readmissions for x in r), sum(x.total_admissions for x in r)) == (246, 2, 645)
    c = q["state_rates_for_cohort_gap"](spark, SF0001).collect()
    assert (len(c), sum(x.total_readmissions for x in c), sum(x.total_admissions for x in c)) == (19, 5, 47)


def test_refresh_upserts_into_stored_table(spark, tmp_dir):
    from dataclasses import replace

    from pyspark.sql import functions as F

    from stayflow import jobs as J
    from stayflow.plans import catalog as CAT
    from stayflow.sources import extracts as X
    i = CAT.Inputs(spark, SF0001)
    claims = X.write_csv_extract(CAT._claims_extract(i))
    bene = X.write_csv_extract(X.beneficiary_extract(i.bene, {
        "DESYNPUF_ID": F.col("person_id"), "SP_STATE_CODE": F.lpad(F.col("state_code").cast("string"), 2, "0"),
        "BENE_SEX_IDENT_CD": F.col("sex")}))
    state = X.write_csv_extract(X.state_extract(i.state, {
        "state_name": F.col("state_name"), "sp_state_code": F.lpad(F.col("state_code").cast("string"), 2, "0"),
        "state_abbr": F.col("state_abbr")}))
    kw = dict(claims_path=claims, bene_path=bene, state_path=state, out_dir=tmp_dir)
    table = f"{tmp_dir}/rates"
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{table}/year=*/*.parquet")}
    years = lambda: {r.year for r in spark.read.parquet(table).select("year").collect()}
    first = J.refresh_measure(spark, rules=replace(CAT.GAP, years=(1996, 1997)), run_id="r1", rates_table=table, **kw)
    before, old96 = files(), sorted(map(tuple, spark.read.parquet(table).where("year = 1996").collect()))
    assert years() == {1996, 1997} and first.rates == table
    assert first.counts == {"claims": i.claims.count(), "bene": i.bene.count(), "state": 25}
    J.refresh_measure(spark, rules=replace(CAT.GAP, years=(1997, 1998)), run_id="r2", rates_table=table, **kw)
    after = files()
    assert years() == {1996, 1997, 1998}
    # Only the years of the second run were written.
    assert {f for f in before if "1996" in f} == {f for f in after if "1996" in f}
    assert all(after[f] == t for f, t in before.items() if "year=1996" in f)
    assert not {f for f in before if "year=1997" in f} & set(after)
    assert old96 == sorted(map(tuple, spark.read.parquet(table).where("year = 1996").collect()))


def test_refresh_stores_crosswalked_claims(spark, tmp_dir):
    from pyspark.sql import functions as F

    from stayflow import jobs as J
    from stayflow.plans import catalog as CAT
    from stayflow.sources import extracts as X
    i = CAT.Inputs(spark, SF0001)
    claims = X.write_csv_extract(CAT._claims_extract(i))
    bene = X.write_csv_extract(X.beneficiary_extract(i.bene, {
        "DESYNPUF_ID": F.col("person_id"), "SP_STATE_CODE": F.col("state_code").cast("string"),
        "BENE_SEX_IDENT_CD": F.col("sex")}))
    state = X.write_csv_extract(X.state_extract(i.state, {
        "state_name": F.col("state_name"), "sp_state_code": F.col("state_code").cast("string"),
        "state_abbr": F.col("state_abbr")}))
    # The brands do not fit the file's five characters: shorter names on both sides.
    claims = X.write_csv_extract(CAT._claims_extract(i).withColumn(
        "ICD9_DGNS_CD_1", F.regexp_replace("ICD9_DGNS_CD_1", "Brand#", "B")))
    xw = X.write_fixed_width(i.xwalk.select(F.regexp_replace("icd9", "Brand#", "B").alias("icd9"), "icd10"),
                             {"icd9": 5, "icd10": 9})
    desc = X.write_fixed_width(i.codes, {"code": 7, "description": 180})
    st = J.refresh_measure(spark, claims_path=claims, bene_path=bene, state_path=state, out_dir=tmp_dir,
                           rules=CAT.GAP, crosswalk_path=xw, descriptions_path=desc)
    cic = spark.read.parquet(st.claims_icd10)
    assert cic.count() == i.claims.count()
    want = sorted((str(r.claim_id), r.icd10_code or "") for r in i.claims_icd10().collect())
    assert sorted((r.CLM_ID, r.ICD10_DGNS_CODE or "") for r in cic.collect()) == want
    assert sum(code != "" for _, code in want) > 100
    from stayflow.schemas import RATE_TABLE_COLUMNS
    # The partition column stands last in the stored table.
    stored = {(f.name, f.dataType) for f in spark.read.parquet(st.rates).schema}
    assert stored == set(RATE_TABLE_COLUMNS)
    assert spark.read.parquet(st.icd10_codes).count() == i.codes.count()


def test_no_hot_keys_runs_the_plain_window_plan(spark):
    # Default threshold: no person is hot, AQE drops the split branch at run
    # time and the executed plan is one window over one person shuffle.
    if spark.conf.get("spark.sql.adaptive.enabled") != "true":
        pytest.skip("runtime plan pruning needs AQE")
    df = E.queries()["all_cause_readmission"](spark, SF0001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
    assert "Union" not in plan
    assert plan.count("Window [") == 1
