"""Loaders (CSV by header name, fixed width) and table maintenance."""

import os

import pytest
from pyspark.sql import functions as F

from stayflow.operators import tables as TB
from stayflow.schemas import BENEFICIARY_COLUMNS, CLAIM_COLUMNS
from stayflow.sources import dims, files


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def bene_csv(rows, order=None):
    names = [n for n, _ in BENEFICIARY_COLUMNS]
    order = order or names
    lines = [",".join(order)]
    for r in rows:
        d = dict(zip(names, r))
        lines.append(",".join(d.get(n, "") for n in order))
    return "\n".join(lines) + "\n"


def test_beneficiary_csv_types_and_zeros(spark, tmp_dir):
    names = [n for n, _ in BENEFICIARY_COLUMNS]
    r1 = ["00013D2EFD8E45D1", "19230501", "", "1", "1", "0", "01", "001"] + ["12"] * 15 + ["10.50"] * 8
    order = list(reversed(names)) + ["EXTRA_COL"]  # header order does not matter, extras ignored
    write(f"{tmp_dir}/bene/a.csv", bene_csv([r1], order))
    write(f"{tmp_dir}/bene/b.csv", bene_csv([["X2"] + r1[1:]]))
    write(f"{tmp_dir}/bene/notes.txt", "not a csv\n")
    with pytest.raises(Exception):   # one scan: a shifted header fails, never reads shifted
        files.load_beneficiaries(spark, f"{tmp_dir}/bene").collect()
    df = files.load_beneficiaries(spark, f"{tmp_dir}/bene", by_header=True)
    rows = {r.DESYNPUF_ID: r for r in df.collect()}
    assert len(rows) == 2
    r = rows["00013D2EFD8E45D1"]
    assert str(r.BENE_BIRTH_DT) == "1923-05-01" and r.BENE_DEATH_DT is None
    assert r.SP_STATE_CODE == "01" and r.BENE_COUNTY_CD == "001"
    assert r.SP_CHF == 12 and str(r.MEDREIMB_IP) == "10.50"
    assert [f.name for f in df.schema.fields] == names


def test_impossible_date_fails_or_nulls(spark, tmp_dir):
    names = [n for n, _ in CLAIM_COLUMNS]
    vals = {n: "" for n in names}
    vals.update(DESYNPUF_ID="P1", CLM_ID="C1", CLM_ADMSN_DT="20080431", NCH_BENE_DSCHRG_DT="20080502")
    write(f"{tmp_dir}/claims/c.csv", ",".join(names) + "\n" + ",".join(vals[n] for n in names) + "\n")
    with pytest.raises(Exception):
        files.load_claims(spark, f"{tmp_dir}/claims").collect()
    r = files.load_claims(spark, f"{tmp_dir}/claims", on_error="null").collect()[0]
    assert r.CLM_ADMSN_DT is None and str(r.NCH_BENE_DSCHRG_DT) == "2008-05-02"
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:  # the failure does not depend on ANSI mode
        with pytest.raises(Exception):
            files.load_claims(spark, f"{tmp_dir}/claims").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_bad_number_fails_or_nulls(spark, tmp_dir):
    names = [n for n, _ in CLAIM_COLUMNS]
    vals = {n: "" for n in names}
    vals.update(DESYNPUF_ID="P1", CLM_ID="C1", SEGMENT="x1", CLM_PMT_AMT="12.5")
    write(f"{tmp_dir}/claims/c.csv", ",".join(names) + "\n" + ",".join(vals[n] for n in names) + "\n")
    with pytest.raises(Exception):
        files.load_claims(spark, f"{tmp_dir}/claims").collect()
    r = files.load_claims(spark, f"{tmp_dir}/claims", on_error="null").collect()[0]
    assert r.SEGMENT is None and str(r.CLM_PMT_AMT) == "12.50"


def test_missing_declared_column_is_an_error(spark, tmp_dir):
    write(f"{tmp_dir}/s/state.csv", "state_name,state_abbr\nAlabama,AL\n")
    with pytest.raises(ValueError):
        files.load_state(spark, f"{tmp_dir}/s/state.csv")


def test_fixed_width_crosswalk(spark, tmp_dir):
    text = ("0010 A000     1\n"
            "0011 A001\n"        # shorter line: second field only partly present
            "\n"                 # blank line skipped
            "NA   B000\n"        # missing marker -> NULL
            "0019\n")            # line shorter than the second field
    write(f"{tmp_dir}/gem.txt", text)
    got = sorted(files.load_icd_crosswalk(spark, f"{tmp_dir}/gem.txt").collect(), key=repr)
    assert [tuple(r) for r in got] == sorted([("0010", "A000     1"[:9].strip()), ("0011", "A001"),
                                              (None, "B000"), ("0019", None)], key=repr)


def test_fixed_width_descriptions(spark, tmp_dir):
    write(f"{tmp_dir}/codes.txt", "A000   Cholera due to Vibrio cholerae\nA001   Cholera, eltor\n")
    got = {r.icd10_cm_code: r.description for r in files.load_icd10_descriptions(spark, f"{tmp_dir}/codes.txt").collect()}
    assert got == {"A000": "Cholera due to Vibrio cholerae", "A001": "Cholera, eltor"}


def rates_df(spark, rows):
    return spark.createDataFrame(rows, "year int, st string, sex string, age_grp_id int, "
                                       "condition_type_id int, readmissions bigint")


KEYS = ["year", "st", "sex", "age_grp_id", "condition_type_id"]


def test_upsert_same_new_and_kept(spark):
    old = rates_df(spark, [(2008, "01", "1", 0, 0, 5), (2008, "02", "1", 0, 0, 7)])
    new = rates_df(spark, [(2008, "01", "1", 0, 0, 9), (2009, "01", "1", 0, 0, 1)])
    got = sorted(tuple(r) for r in TB.upsert(old, new, KEYS).collect())
    assert got == [(2008, "01", "1", 0, 0, 9), (2008, "02", "1", 0, 0, 7), (2009, "01", "1", 0, 0, 1)]
    twice = TB.upsert(TB.upsert(old, new, KEYS), new, KEYS)
    assert sorted(tuple(r) for r in twice.collect()) == got


def test_upsert_rejects_null_and_duplicate_keys(spark):
    old = rates_df(spark, [(2008, "01", "1", 0, 0, 5)])
    with pytest.raises(Exception):
        TB.upsert(old, rates_df(spark, [(2008, None, "1", 0, 0, 1)]), KEYS).collect()
    with pytest.raises(Exception):
        TB.upsert(old, rates_df(spark, [(2009, "01", "1", 0, 0, 1), (2009, "01", "1", 0, 0, 2)]), KEYS).collect()


def test_upsert_table_writes_new_folder(spark, tmp_dir):
    old = rates_df(spark, [(2008, "01", "1", 0, 0, 5)])
    old.write.parquet(f"{tmp_dir}/rates")
    out = TB.upsert_table(f"{tmp_dir}/rates", rates_df(spark, [(2008, "01", "1", 0, 0, 6)]), KEYS)
    assert out != f"{tmp_dir}/rates"
    assert [r.readmissions for r in spark.read.parquet(out).collect()] == [6]
    assert [r.readmissions for r in spark.read.parquet(f"{tmp_dir}/rates").collect()] == [5]


def test_key_violations_and_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    got = sorted((tuple(r) for r in TB.key_violations(df, ["k"]).collect()), key=repr)
    assert got == sorted([("a", 2), (None, 1)], key=repr)
    rc = {r.table_name: r.n_rows for r in TB.row_counts({"x": df, "g": dims.dim_gender(spark)}).collect()}
    assert rc == {"x": 4, "g": 2}


def test_clustered_claims_order(spark):
    df = spark.createDataFrame([(p, d, c) for p in range(20) for d, c in ((2, 1), (1, 2), (1, 1))],
                               "DESYNPUF_ID int, CLM_ADMSN_DT int, CLM_ID int")
    out = TB.clustered_claims(df, partitions=3)
    parts = out.rdd.glom().collect()
    for p in parts:
        keys = [(r[0], r[1], r[2]) for r in p]
        assert keys == sorted(keys)
    assert sum(len(p) for p in parts) == 60


def test_reload_table(spark, tmp_dir):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    back = TB.reload_table(df, f"{tmp_dir}/t")
    assert sorted(r.x for r in back.collect()) == [0, 2, 4, 6, 8]


def test_cluster_conf_sizes():
    from stayflow.session import HOT_KEY_ROWS_CONF, cluster_conf
    c = cluster_conf(100e12, 1000, 8, 64 * 2**30)
    parts = int(c["spark.sql.shuffle.partitions"])
    assert parts * 256 * 2**20 >= 0.5 * 100e12 and parts >= 3 * 8000
    hot = int(c[HOT_KEY_ROWS_CONF])
    assert 5e11 / hot < 1e5  # the hot-key broadcast stays small
    small = cluster_conf(1e9, 2, 4, 8 * 2**30)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
