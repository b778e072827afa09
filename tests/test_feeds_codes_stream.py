"""Feeds, cohort helpers, NOT IN semantics and incremental ingestion."""

import os

import pytest

from pyspark.sql import functions as F

from stayflow.functions.codes import code_absent, cohort_predicate
from stayflow.operators import codes as K
from stayflow.operators import feeds as FD
from stayflow.operators.stays import exclude_ids
from stayflow.schemas import CLAIM_COLUMNS, CodeCols
from stayflow.sources import files
from stayflow.streaming import ingest as IN


def state_rates(spark, rows):
    return spark.createDataFrame(rows, "state_name string, readmission_rate double")


def test_top_states_drops_nulls_and_breaks_ties(spark):
    sr = state_rates(spark, [(f"S{i:02d}", float(i % 5)) for i in range(14)] + [("SX", None)])
    got = [r.state_name for r in FD.top_states(sr, 10).collect()]
    assert len(got) == 10 and "SX" not in got
    assert got[:3] == ["S04", "S09", "S03"]


def test_state_map_feed_zero_fills_and_excludes(spark):
    dim = spark.createDataFrame([("Alabama", "01", "AL"), ("Puerto Rico", "72", "PR"), ("Ohio", "39", "OH"),
                                 ("Texas", "48", "TX")], "state_name string, sp_state_code string, state_abbr string")
    sr = state_rates(spark, [("Alabama", 1.5), ("Texas", None)])
    got = {r.state_name: r.readmission_rate for r in FD.state_map_feed(sr, dim).collect()}
    assert got == {"Alabama": 1.5, "Ohio": 0.0, "Texas": 0.0}


def test_rate_range_and_scaling(spark):
    sr = state_rates(spark, [("A", 2.0), ("B", 4.0), ("C", None)])
    rng = FD.rate_range(sr).collect()[0]
    assert (rng.min_rate, rng.max_rate) == (2.0, 4.0)
    empty = state_rates(spark, [("C", None)])
    r0 = FD.rate_range(empty).collect()[0]
    assert (r0.min_rate, r0.max_rate) == (0.0, 1.0)
    fixed = FD.rate_range(sr, fixed=FD.DASHBOARD_RATE_RANGE).collect()[0]
    assert (fixed.min_rate, fixed.max_rate) == (0.0, 0.1)
    sc = {r.state_name: r.rate_scaled for r in FD.rate_scaled(sr.fillna(0.0), FD.rate_range(sr)).collect()}
    assert sc == {"A": 0.0, "B": 1.0, "C": -1.0}
    flat = state_rates(spark, [("A", 3.0), ("B", 3.0)])
    assert {r.rate_scaled for r in FD.rate_scaled(flat, FD.rate_range(flat)).collect()} == {0.0}


def test_paging_and_titles(spark):
    df = spark.range(45).withColumn("g", F.col("id") % 3)
    p2 = [r.id for r in FD.page_of(df, ["g", "id"], page=2, size=10).collect()]
    assert p2 == [30, 33, 36, 39, 42, 1, 4, 7, 10, 13]
    p = FD.page_of(df, ["id"], page=5, size=10, where="g = 0").collect()
    assert p == []
    t = FD.with_titles(spark.createDataFrame([("AL", 1, 2, 0.5)],
                                             "state string, total_readmissions bigint, total_admissions bigint, readmission_rate double"))
    assert t.columns == ["State", "Total Readmissions", "Total Admissions", "Readmission Rate"]


def test_percent_text(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (0, 5), (1, 0)], "readmissions bigint, total_admissions bigint")
    got = [r.p for r in df.select(FD.percent_text("readmissions", "total_admissions").alias("p")).collect()]
    assert got == ["12.50%", "33.33%", "66.67%", "0.00%", None]


def test_exclude_ids_null_rules(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    ids = lambda rows: spark.createDataFrame(rows, "id string")
    assert sorted(r.id for r in exclude_ids(df, ids([("a",)]), "id").collect()) == ["b"]
    assert exclude_ids(df, ids([("a",), (None,)]), "id").count() == 0
    assert sorted(exclude_ids(df, ids([]), "id").collect(), key=repr) == sorted(df.collect(), key=repr)


def test_code_absent_three_valued(spark):
    df = spark.createDataFrame([("x", "y"), ("x", None), ("V642", None)], "a string, b string")
    strict = [r.k for r in df.select(code_absent("V642", ["a", "b"]).alias("k")).collect()]
    safe = [r.k for r in df.select(code_absent("V642", ["a", "b"], null_safe=True).alias("k")).collect()]
    assert strict == [True, None, False] and safe == [True, True, False]


def test_cohort_forms_and_fallback(spark):
    codes = spark.createDataFrame([(f"{ch}{n:02d}1", f"d{ch}{n}") for ch in "ABCDEFGHIJKL" for n in range(3)],
                                  "icd10_cm_code string, description string")
    k = CodeCols()
    col_form = cohort_predicate("icd10_cm_code", F.col("icd10_cm_code").startswith("A"))
    sql_form = cohort_predicate("icd10_cm_code", "icd10_cm_code LIKE 'A%'")
    list_form = cohort_predicate("icd10_cm_code", ["A"])
    for pred in (col_form, sql_form, list_form):
        assert codes.where(pred).count() == 3
    # Letters name no code group, however many codes they cover.
    assert tuple(K.cohort_breadth(codes, list("ABCDEFGHIJKL"), k).first()) == (36, 0, False)
    claims = spark.createDataFrame([("A001",), ("C011",), (None,)], "ICD10_DGNS_CODE string")
    for few in (["A"], "ICD10_DGNS_CODE LIKE 'A%'", [f"A{n:02d}" for n in range(9)]):
        assert claims.where(K.cohort_or_all(few, "ICD10_DGNS_CODE")).count() == 1
    ten = [f"A{n:02d}" for n in range(10)]
    sql = " OR ".join(f"ICD10_DGNS_CODE LIKE '{p}%'" for p in ten)
    as_column = cohort_predicate("ICD10_DGNS_CODE", ten)
    for many in (ten, sql, as_column):
        assert K.too_broad(many) and K.cohort_or_all(many, "ICD10_DGNS_CODE") is None
        # Asked without the fallback, the filter stays.
        assert tuple(K.cohort_breadth(codes, many, k, "ICD10_DGNS_CODE").first()) == (3, 10, True)


def _claims_file(path, rows):
    names = [n for n, _ in CLAIM_COLUMNS]
    with open(path, "w") as f:
        f.write(",".join(names) + "\n")
        for pid, cid, adm in rows:
            v = {n: "" for n in names}
            v.update(DESYNPUF_ID=pid, CLM_ID=cid, CLM_ADMSN_DT=adm, SEGMENT="1")
            f.write(",".join(v[n] for n in names) + "\n")


def test_streaming_ingest_is_incremental(spark, tmp_dir):
    src, table, ck = f"{tmp_dir}/in", f"{tmp_dir}/table", f"{tmp_dir}/ck"
    os.makedirs(src)
    _claims_file(f"{src}/a.csv", [("p1", "c1", "20080101"), ("p1", "c2", "20080201")])
    IN.ingest_claims(spark, src, table, checkpoint=ck).awaitTermination()
    assert spark.read.parquet(table).count() == 2
    _claims_file(f"{src}/b.csv", [("p2", "c3", "20090101")])
    IN.ingest_claims(spark, src, table, checkpoint=ck).awaitTermination()   # only the new file
    got = spark.read.parquet(table)
    assert sorted(r.CLM_ID for r in got.collect()) == ["c1", "c2", "c3"]
    assert dict(got.dtypes)["CLM_ADMSN_DT"] == "date" and dict(got.dtypes)["SEGMENT"] == "int"
    batch = files.load_claims(spark, src)
    assert sorted(tuple(r) for r in batch.select("CLM_ID", "CLM_ADMSN_DT").collect()) == \
        sorted(tuple(r) for r in got.select("CLM_ID", "CLM_ADMSN_DT").collect())


def test_streaming_ingest_twice_with_defaults(spark, tmp_dir):
    src, table = f"{tmp_dir}/in", f"{tmp_dir}/table"
    os.makedirs(src)
    _claims_file(f"{src}/a.csv", [("p1", "c1", "20080101")])
    IN.ingest_claims(spark, src, table).awaitTermination()
    _claims_file(f"{src}/b.csv", [("p2", "c2", "20090101")])
    IN.ingest_claims(spark, src, table).awaitTermination()
    assert sorted(r.CLM_ID for r in spark.read.parquet(table).collect()) == ["c1", "c2"]


def test_streaming_ingest_binds_columns_by_name(spark, tmp_dir):
    src, table = f"{tmp_dir}/in", f"{tmp_dir}/table"
    os.makedirs(src)
    names = ["EXTRA", *[n for n, _ in CLAIM_COLUMNS][::-1]]
    v = dict.fromkeys(names, "") | {"DESYNPUF_ID": "p", "CLM_ID": "c", "CLM_ADMSN_DT": "20080102", "EXTRA": "x"}
    with open(f"{src}/a.csv", "w") as f:
        f.write(",".join(names) + "\n" + ",".join(v[n] for n in names) + "\n")
    IN.ingest_claims(spark, src, table).awaitTermination()
    row = spark.read.parquet(table).first()
    assert (row.DESYNPUF_ID, row.CLM_ID, str(row.CLM_ADMSN_DT)) == ("p", "c", "2008-01-02")


def test_fixed_width_never_cuts(spark):
    from stayflow.sources import extracts as X
    with pytest.raises(Exception, match="does not fit"):
        X.write_fixed_width(spark.createDataFrame([("Brand#11",)], "a string"), {"a": 5})


def test_named_groups_rule():
    from stayflow.functions.codes import named_groups
    assert named_groups(["I21", "I22", "I21", "B", "E119", "I2101"]) == {"I21", "I22", "E119"}
    assert named_groups("x LIKE 'I21%' OR x like 'C5%' OR x LIKE 'I%' OR y = 'E11'") == {"I21", "C5"}
    assert named_groups(cohort_predicate("x", ["I21", "I"])) == {"I21"}
    # Upper-case groups, of the code column alone.
    text = "x LIKE 'i21%' OR t.x NOT LIKE 'J4%' OR y LIKE 'K5%' OR starts_with(`x`, 'L6') OR x LIKE '%M7%'"
    assert named_groups(text, "x") == {"J4", "L6"} and named_groups(text) == {"J4", "K5", "L6"}
    x, y = F.col("t.x"), F.col("y")
    tree = ~(x.startswith("I21") & y.like("K5%")) | x.like("e11%") | x.like("C5_%") | F.expr(text) | (F.lower(x) == "d10")
    assert named_groups(tree, "x") == {"I21", "J4", "L6"}
    assert named_groups(x.startswith("A1").alias("q") | x.isin("B20"), {"x", "z"}) == {"A1"}
    assert not K.too_broad(" OR ".join(f"y LIKE 'A{n}%'" for n in range(20)), code_cols="x")


def test_partition_count_does_not_change_answer(spark):
    from edge_fixture import frames
    from stayflow.operators import rates as R
    from stayflow.rules import CLAIMS_RULES
    t = frames(spark)
    base = sorted(tuple(r) for r in R.readmission_rate(t["claims"], t["bene"], CLAIMS_RULES.gap_only()).collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = sorted(tuple(r) for r in R.readmission_rate(t["claims"].repartition(3), t["bene"],
                                                              CLAIMS_RULES.gap_only()).collect())
            assert got == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
