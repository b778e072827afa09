"""What a task reads or computes grows with the rows, not with a fixed count or
one value's share of them."""

from conftest import SF0001, rows_of

from stayflow.plans import catalog as CAT
from stayflow.sources import extracts as X
from stayflow.sources import files as FL
from stayflow.streaming import ingest as IN


def test_stream_extract_has_as_many_files_as_tasks(spark, monkeypatch):
    seen = []
    ingest = IN.ingest_claims

    def watched(session, folder, *args, **kw):
        seen.append(len(session.read.option("pathGlobFilter", "*.csv").text(folder).inputFiles()))
        return ingest(session, folder, *args, **kw)
    monkeypatch.setattr(IN, "ingest_claims", watched)
    i = CAT.Inputs(spark, SF0001)

    class Spread(CAT.Inputs):
        @property
        def claims(self):
            return i.claims.repartition(7)
    n = CAT._stream_ingest_claims(Spread(spark, SF0001)).count()
    assert seen == [7] and n == i.claims.count()


def test_wide_projections_stay_out_of_whole_stage_code(spark):
    i = CAT.Inputs(spark, SF0001)
    extract = CAT._claims_extract(i)
    assert "*" not in top_project(extract)
    assert "*" not in top_project(FL.load_claims(spark, X.write_csv_extract(extract)))


def top_project(df):
    """The first projection of a plan that ran, with its mark of whole-stage code."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0].splitlines()
    return next(x for x in lines if "Project [" in x).split("Project [")[0]


def test_no_shuffle_of_claims_by_code(spark):
    """Claims with a frequent code, or none, do not meet in one task."""
    for name in ("rates_for_cohort_table", "rates_for_five_cohorts", "claims_icd10", "cohort_by_prefix_table"):
        plan = CAT.QUERIES[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
        joins = [x for x in plan.splitlines() if "Join [" in x and ("[d1#" in x or "icd10_code#" in x.split("Join [")[1][:40])]
        assert joins and all("BroadcastHashJoin" in x for x in joins), joins


def test_hot_entities_are_broadcast_however_many_there_are(spark):
    """The shuffle by person holds cold persons only."""
    kw = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in kw}
    try:
        for k, v in kw.items():
            spark.conf.set(k, v)
        plan = CAT.QUERIES["all_cause_readmission_tied"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert not [x for x in plan.splitlines() if "SortMergeJoin" in x and "__hk" in x]
    assert [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "__hk" in x]


def test_unsplit_rows_are_narrow(spark):
    """The shuffle by person does not carry the diagnoses that only break ties."""
    plan = CAT.QUERIES["all_cause_readmission_tied_unsplit"](spark, SF0001)
    text = plan._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0].splitlines()
    at = next(k for k, x in enumerate(text) if "Exchange hashpartitioning(person_id" in x)
    below = next(x for x in text[at + 1:] if "Project [" in x)
    assert not [d for d in ("d5#", "d6#", "d7#") if d in below.split("Project [")[1]], below


def test_unsplit_ties_rank_like_the_split(spark):
    q = CAT.QUERIES
    assert rows_of(q["all_cause_readmission_tied_unsplit"](spark, SF0001)) == rows_of(q["all_cause_readmission_tied"](spark, SF0001))
