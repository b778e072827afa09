"""Registered queries: each operator of the library run on the test tables.

Every entry is ``(spark, sf_dir) -> DataFrame`` over the whole given tables
(through the claims-shaped views of ``sources.adapter``); none collects.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import jobs as J
from ..functions.codes import code_absent
from ..functions.wide import in_small_methods
from ..operators import bitmaps as BM
from ..operators import codes as K
from ..operators import feeds as FD
from ..operators import rates as R
from ..operators import stays as S
from ..operators import tables as TB
from ..schemas import BENEFICIARY_COLUMNS, CLAIM_COLUMNS, RATE_TABLE_COLUMNS
from ..session import materialize, scratch_path
from ..sources import adapter as A
from ..sources import dims as D
from ..sources import extracts as X
from ..sources import files as FL
from ..streaming import ingest as IN
from ..streaming import refresh as RF

L = A.LAYOUT
C, B, ST, KC = L.claims, L.bene, L.state, L.codes
STRICT = A.RULES
NULL_SAFE = A.RULES.with_null_safe()
GAP = A.RULES.gap_only()
RATE_KEYS = ["year", B.state, B.sex, "age_grp_id", "condition_type_id"]
CODE_PREFIX = "B"
# Cohorts as SQL text: nine named code groups (a filter) and ten (too broad).
NINE_GROUPS = " OR ".join(f"{C.icd10} LIKE '{x}0%'" for x in "BCDEFGHIJ")
TEN_GROUPS = f"{NINE_GROUPS} OR {C.icd10} LIKE 'K0%'"


class Inputs:
    """Lazy claims-shaped inputs for one (session, folder)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @property
    def claims(self) -> DataFrame:
        return A.claims(self.spark, self.sf_dir)

    @property
    def bene(self) -> DataFrame:
        return A.bene(self.spark, self.sf_dir)

    @property
    def state(self) -> DataFrame:
        return A.state(self.spark, self.sf_dir)

    @property
    def xwalk(self) -> DataFrame:
        return A.xwalk(self.spark, self.sf_dir)

    @property
    def codes(self) -> DataFrame:
        return A.codes(self.spark, self.sf_dir)

    def claims_icd10(self) -> DataFrame:
        return K.claims_icd10(self.claims, self.xwalk, C, icd9=KC.icd9, icd10=KC.icd10)

    def rates(self, rules=STRICT, flag_rules=None) -> DataFrame:
        return R.readmission_rate(self.claims, self.bene, rules, flag_rules=flag_rules, c=C, b=B)

    def state_rates(self, rules=GAP) -> DataFrame:
        return R.state_rates(self.rates(rules), self.state, b=B, s=ST)

    def cohort_rates(self, flag_rules=STRICT, cohort=A.COHORT_PREFIXES, top_n=None) -> DataFrame:
        xw = K.crosswalk_min(self.xwalk, icd9=KC.icd9, icd10=KC.icd10)
        return R.state_rates_for_cohort(
            self.claims, xw, self.bene, self.state, STRICT,
            cohort=cohort,
            flag_rules=flag_rules, top_n=top_n, c=C, b=B, s=ST, icd9=KC.icd9, icd10=KC.icd10)


def q(fn: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Inputs(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _against_advice(i: Inputs, null_safe: bool) -> DataFrame:
    return i.claims.where(code_absent(STRICT.exclude_any_dx, C.dx, null_safe))


# Skewed variant of the claims: every third claim (by claim id) moves to
# customer 1, so one person holds a third of all rows.  With the hot-key
# threshold at 100 rows that person takes the split path at every scale.
SKEW_PERSON, SKEW_HOT_ROWS = 1, 100


def _skewed_claims(i: Inputs, claims: DataFrame | None = None) -> DataFrame:
    return (i.claims if claims is None else claims).withColumn(C.person, F.when(F.col(C.claim) % 3 == 0, F.lit(SKEW_PERSON).cast("long"))
                                          .otherwise(F.col(C.person)))


def _tied_claims(i: Inputs) -> DataFrame:
    """The skewed claims, every second claim with a second segment that differs
    in discharge and diagnosis only (the claims are read once)."""
    segments = F.when(F.col(C.claim) % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    second = F.col("__segment") == 2
    both = i.claims.withColumn("__segment", F.explode(segments)).withColumns(
        {C.disch: F.when(second, F.date_add(C.disch, 9)).otherwise(F.col(C.disch)),
         C.dx1: F.when(second, F.col(C.dx[1])).otherwise(F.col(C.dx1))}).drop("__segment")
    return _skewed_claims(i, both)


def _key_violations_mixed(i: Inputs) -> DataFrame:
    """Keys that are unique, repeated and missing."""
    n = F.col(C.claim)
    key = F.when(n % 10 == 0, F.lit(None).cast("long")).when(n % 10 < 4, F.expr(f"{C.claim} div 20")).otherwise(-n)
    return TB.key_violations(i.claims.select(key.alias("k")), ["k"])


def _upsert(i: Inputs) -> DataFrame:
    old = i.rates(replace(STRICT, years=(1996, 1997)))
    new = i.rates(replace(GAP, years=(1997, 1998)))
    return TB.upsert(old, new, RATE_KEYS)


def _rate_scaled(i: Inputs) -> DataFrame:
    # The state rates feed both the map and its range: stored once in the
    # shared folder (as the reference stores its rate table), read twice.
    sr = materialize(i.state_rates(GAP), "state-rates")
    return FD.rate_scaled(FD.state_map_feed(sr, i.state, s=ST), FD.rate_range(sr))


def _label_rates(i: Inputs) -> DataFrame:
    sp = i.spark
    # The tables carry no sexes, age groups or conditions: codes that the
    # dimensions have, and some that they lack.
    sex, code = F.col(B.sex), F.col(B.state)
    rates = i.rates(STRICT).withColumns({
        B.sex: F.when(sex == "AUTOMOBILE", "1").when(sex == "BUILDING", "2").otherwise(sex),
        "age_grp_id": (code % 7).cast("int"), "condition_type_id": (11 * (code % 11)).cast("int")})
    return FD.label_rates(rates, D.dim_gender(sp), D.dim_age_group(sp),
                          D.dim_condition(sp), i.state, b=B, s=ST)


# ---------------------------------------------------------------------------
# Loader round trips: an extract derived from the given tables is written by
# Spark into the shared folder and read back by the loader under test.
# ---------------------------------------------------------------------------
def _filled(column: int, dtype, n: str) -> Column:
    """A value of the column's type made from the row's number ``n``; every
    eleventh is missing."""
    i = F.col(n)
    kind = dtype.typeName()
    if kind == "date":
        v = F.date_add(F.lit("2008-01-01").cast("date"), (i % 900 + column).cast("int"))
    elif kind == "integer":
        v = (i + column) % 50
    elif kind == "decimal":
        v = ((i * 7 + column * 13) % 100000).cast("decimal(13,2)") / 100
    else:
        v = F.lpad(((i * column) % 1000).cast("string"), 4, "0")
    return F.when((i + column) % 11 != 0, v.cast(dtype))


def _layout(columns, n: str, known: dict[str, Column]) -> dict[str, Column]:
    return {name: known.get(name, _filled(k, t, n)) for k, (name, t) in enumerate(columns, 1)}


def _claims_extract(i: Inputs) -> DataFrame:
    """All 81 columns, filled from the given tables."""
    known = {"DESYNPUF_ID": F.col(C.person), "CLM_ID": F.col(C.claim), "CLM_ADMSN_DT": F.col(C.admit),
             "NCH_BENE_DSCHRG_DT": F.col(C.disch), "CLM_PMT_AMT": F.col("pay_amt"),
             **{f"ICD9_DGNS_CD_{k}": F.col(d) for k, d in enumerate(C.dx, 1)}}
    return X.claims_extract(i.claims, _layout(CLAIM_COLUMNS, C.claim, known))


def _bene_extract(i: Inputs) -> DataFrame:
    """All 31 columns."""
    known = {"DESYNPUF_ID": F.col(B.person), "SP_STATE_CODE": F.lpad(F.col(B.state).cast("string"), 2, "0"),
             "BENE_SEX_IDENT_CD": F.col(B.sex)}
    return X.beneficiary_extract(i.bene, _layout(BENEFICIARY_COLUMNS, B.person, known))


# ---------------------------------------------------------------------------
# Rates as stored bitmaps: computed once per (year, state, sex), rolled up to
# any coarser grouping without the claims.
# ---------------------------------------------------------------------------
BITMAP_KEYS = ["year", B.state, B.sex]


def _rate_bitmaps(i: Inputs, bene: DataFrame | None = None) -> DataFrame:
    pairs = R.episode_pairs(i.claims, i.bene if bene is None else bene, GAP, {B.state: B.state, B.sex: B.sex}, c=C, b=B)
    return BM.rate_bitmaps(pairs, BITMAP_KEYS, C.claim)


def _with_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn("readmission_rate", R.ratio("readmissions", "total_admissions"))


def _state_rates_rolled_up(i: Inputs) -> DataFrame:
    return R.state_rates(BM.rolled_up(_rate_bitmaps(i), [B.state]), i.state, b=B, s=ST)


def _incremental_rates(i: Inputs) -> DataFrame:
    """The claims in three loads, most persons met in each; the second load is
    delivered twice."""
    state = RF.RateState(i.spark, scratch_path(i.spark, "rate-state"), GAP, C, B, slices=8)
    third = F.col(C.claim) % 3
    RF.append(state, i.claims.where(third == 0), i.bene)
    RF.append(state, i.claims.where(third == 1), i.bene, run=1)
    RF.append(state, i.claims.where(third == 1), i.bene, run=1)
    return RF.append(state, i.claims.where(third == 2), i.bene, run=2)


# ---------------------------------------------------------------------------
# Cohorts as code tables: every code whose number is even is a prefix (half of
# all codes: about 1,000 at sf0.01), and some single letters.
# ---------------------------------------------------------------------------
def _prefix_table(i: Inputs) -> DataFrame:
    code, letter = F.col(KC.code), F.left(KC.code, F.lit(1))
    full = i.codes.where(F.right(code, F.lit(1)).isin("0", "2", "4", "6", "8")).select(code.alias("prefix"))
    short = i.codes.where(letter.isin("B", "C")).select(letter.alias("prefix"))
    return full.unionByName(short).distinct()


# Five cohorts: two of one letter each, two that overlap, one of full codes.
COHORTS = {"b": ["B"], "c": ["C"], "many": list(A.COHORT_PREFIXES), "low": ["B0", "C0", "D0"], "sql": f"{C.icd10} LIKE 'H%'"}


def _cohort_table(i: Inputs) -> DataFrame:
    """The first four of them as rows (prefix, cohort)."""
    rows = F.array(*[F.struct(F.lit(p).alias("prefix"), F.lit(n).alias("cohort"))
                     for n, d in COHORTS.items() if isinstance(d, list) for p in d])
    return i.codes.select(F.explode(rows).alias("x")).select("x.*").distinct()


def _many_cohorts(i: Inputs, **which) -> DataFrame:
    xw = K.crosswalk_min(i.xwalk, icd9=KC.icd9, icd10=KC.icd10)
    return R.rates_for_cohorts(i.claims, xw, i.bene, i.state, STRICT, flag_rules=GAP, c=C, b=B, s=ST, icd9=KC.icd9,
                               icd10=KC.icd10, **which)


# ---------------------------------------------------------------------------
# Stored tables: upsert in place, counts with the load, pages by key, rejects.
# ---------------------------------------------------------------------------
def _stored_rates(i: Inputs, *rates: DataFrame) -> tuple[str, DataFrame]:
    path = scratch_path(i.spark, "rate-table")
    for r in rates:
        table = TB.upsert_in_place(path, r, RATE_KEYS, "year")
    return path, table


def _upsert_in_place(i: Inputs) -> DataFrame:
    return _stored_rates(i, i.rates(replace(STRICT, years=(1996, 1997))), i.rates(replace(GAP, years=(1997, 1998))))[1]


def _state_rates_stored(i: Inputs) -> DataFrame:
    """From the stored rate table in its declared types; no claim is read."""
    names = {"SP_STATE_CODE": B.state, "BENE_SEX_IDENT_CD": B.sex}
    declared = [(names.get(n, n), i.bene.schema[names[n]].dataType if n in names else t) for n, t in RATE_TABLE_COLUMNS]
    return R.state_rates(_stored_rates(i, TB.as_declared(i.rates(GAP), declared))[1], i.state, b=B, s=ST)


def _flag_view(i: Inputs) -> DataFrame:
    """The flag as an SQL view, recomputed on each read."""
    TB.replace_view("all_cause_readmission_view", S.all_cause_readmission(i.claims, GAP, C))
    return i.spark.sql(f"""SELECT year({C.admit}) AS year, count(*) AS n_flagged, count(DISTINCT {C.person}) AS n_persons
                           FROM all_cause_readmission_view GROUP BY 1""")


def _counts_with_load(i: Inputs) -> DataFrame:
    return TB.write_counted({name: (df, scratch_path(i.spark, name)) for name, df in {
        "claims": i.claims, "bene": i.bene, "state": i.state,
        "all_cause_readmission": S.all_cause_readmission(i.claims, STRICT, C)}.items()})


def _rates_page_by_key(i: Inputs) -> DataFrame:
    """The second page, by the last key of the first."""
    path, keys = scratch_path(i.spark, "sorted-rates"), ["year", B.state, B.sex]
    TB.store_sorted(i.rates(GAP), path, keys)
    last = TB.page_after(i.spark, path, keys, None, 20).collect()[-1]
    return TB.page_after(i.spark, path, keys, [last[k] for k in keys], 20)


PAGE_AFTER = (dt.date(1996, 6, 30), 1000)


def _claims_page_by_key(i: Inputs) -> DataFrame:
    path, keys = scratch_path(i.spark, "sorted-claims"), [C.admit, C.claim]
    TB.store_sorted(i.claims, path, keys, files=32)
    return TB.page_after(i.spark, path, keys, PAGE_AFTER, 50)


def _spoilt_claims(i: Inputs) -> FL.Checked:
    """The claims extract with impossible dates and amounts that are no numbers."""
    n = F.col("CLM_ID").cast("long")
    spoilt = _claims_extract(i).withColumns({
        "CLM_ADMSN_DT": F.when(n % 7 == 0, "20080431").otherwise(F.col("CLM_ADMSN_DT")),
        "CLM_PMT_AMT": F.when(n % 11 == 0, "12,50").otherwise(F.col("CLM_PMT_AMT")),
        "CLM_UTLZTN_DAY_CNT": in_small_methods(F.when(n % 13 == 0, "ten").otherwise(F.col("CLM_UTLZTN_DAY_CNT")))})
    return FL.load_checked(i.spark, X.write_csv_extract(spoilt), CLAIM_COLUMNS, keys=["CLM_ID"])


def _rejected_claims(i: Inputs) -> DataFrame:
    return _spoilt_claims(i).rejected.select("CLM_ID", "column", "value", F.col("file").like("%.csv").alias("has_file"))


def _load_claims(i: Inputs) -> DataFrame:
    return FL.load_claims(i.spark, X.write_csv_extract(_claims_extract(i)))


def _load_beneficiaries(i: Inputs) -> DataFrame:
    return FL.load_beneficiaries(i.spark, X.write_csv_extract(_bene_extract(i)))


def _load_state(i: Inputs) -> DataFrame:
    m = {"state_name": F.col(ST.name), "sp_state_code": F.lpad(F.col(ST.code).cast("string"), 2, "0"),
         "state_abbr": F.col(ST.abbr)}
    return FL.load_state(i.spark, X.write_csv_extract(X.state_extract(i.state, m)))


def _load_icd_crosswalk(i: Inputs) -> DataFrame:
    # The brands are longer than the file's field of 5: the whole brand number
    # is written, under one letter.
    brand = F.lpad(F.substring(KC.icd9, 7, 100), 4, "0")
    xw = i.xwalk.select(F.concat(F.lit("B"), brand).alias("icd9"), F.col(KC.icd10).alias("icd10"))
    return FL.load_icd_crosswalk(i.spark, X.write_fixed_width(xw, {"icd9": 5, "icd10": 9}))


def _load_icd10_descriptions(i: Inputs) -> DataFrame:
    path = X.write_fixed_width(i.codes, {KC.code: 7, KC.description: 180})
    return FL.load_icd10_descriptions(i.spark, path)


def _reload_claims(i: Inputs) -> DataFrame:
    return TB.reload_table(i.claims, scratch_path(i.spark, "reload-claims"))


def _refresh_state_rates(i: Inputs) -> DataFrame:
    """The batch job end to end on extracts derived from the given tables."""
    claims_path = X.write_csv_extract(_claims_extract(i))
    bene_path = X.write_csv_extract(_bene_extract(i))
    state_m = {"state_name": F.col(ST.name), "sp_state_code": F.lpad(F.col(ST.code).cast("string"), 2, "0"),
               "state_abbr": F.col(ST.abbr)}
    state_path = X.write_csv_extract(X.state_extract(i.state, state_m))
    stored = J.refresh_measure(i.spark, claims_path=claims_path, bene_path=bene_path,
                               state_path=state_path, out_dir=scratch_path(i.spark, "measure"),
                               rules=GAP)
    return i.spark.read.parquet(stored.state_rates)


def _stream_ingest_claims(i: Inputs) -> DataFrame:
    src = X.write_csv_extract(_claims_extract(i))
    table = scratch_path(i.spark, "ingested-claims")
    q = IN.ingest_claims(i.spark, src, table, available_now=True)
    q.awaitTermination()
    return i.spark.read.parquet(table)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # filters and the previous stay
    "complete_stays": q(lambda i: S.complete_stays(i.claims, C)),
    "stays_in_years": q(lambda i: S.stays_in_years(i.claims, STRICT.years, C)),
    "prev_stay": q(lambda i: S.prev_stay(i.claims, C)),
    "against_advice_filter": q(lambda i: _against_advice(i, False)),
    "against_advice_filter_null_safe": q(lambda i: _against_advice(i, True)),
    # the flag
    "all_cause_readmission": q(lambda i: S.all_cause_readmission(i.claims, STRICT, C)),
    "all_cause_readmission_null_safe": q(lambda i: S.all_cause_readmission(i.claims, NULL_SAFE, C)),
    "all_cause_readmission_gap": q(lambda i: S.all_cause_readmission(i.claims, GAP, C)),
    # index and planned stays
    "index_stays": q(lambda i: S.index_stays(i.claims, STRICT, C)),
    "planned_stays": q(lambda i: S.planned_stays(i.claims, STRICT, C)),
    "exclude_planned": q(lambda i: S.exclude_planned(S.index_stays(i.claims, STRICT, C), i.claims, STRICT, C)),
    # rates
    "readmission_rate": q(lambda i: i.rates(STRICT)),
    "readmission_rate_gap": q(lambda i: i.rates(GAP)),
    "state_rates": q(lambda i: i.state_rates(GAP)),
    "state_rates_strict": q(lambda i: i.state_rates(STRICT)),
    "readmission_rate_from_bitmaps": q(lambda i: _with_rate(BM.rolled_up(_rate_bitmaps(i), BITMAP_KEYS))),
    "state_rates_rolled_up": q(_state_rates_rolled_up),
    "year_rates_rolled_up": q(lambda i: _with_rate(BM.rolled_up(_rate_bitmaps(i), ["year"]))),
    "total_rate_rolled_up": q(lambda i: _with_rate(BM.rolled_up(_rate_bitmaps(i), []))),
    "incremental_rates": q(_incremental_rates),
    # codes and cohorts
    "crosswalk_min": q(lambda i: K.crosswalk_min(i.xwalk, icd9=KC.icd9, icd10=KC.icd10)),
    "claims_icd10": q(lambda i: i.claims_icd10()),
    "stored_claims_icd10": q(lambda i: materialize(i.claims_icd10(), "claims-icd10")),
    "codes_by_prefix": q(lambda i: K.codes_by_prefix(i.codes, CODE_PREFIX, KC)),
    "condition_cohort": q(lambda i: K.condition_cohort(i.claims_icd10(), A.COHORT_PREFIXES, C)),
    "cohort_codes": q(lambda i: K.cohort_codes(i.codes, A.COHORT_PREFIXES, KC)),
    "cohort_breadth": q(lambda i: K.cohort_breadth(i.codes, A.COHORT_PREFIXES, KC)),
    "cohort_breadth_nine_groups": q(lambda i: K.cohort_breadth(i.codes, NINE_GROUPS, KC, C.icd10)),
    "cohort_breadth_ten_groups": q(lambda i: K.cohort_breadth(i.codes, TEN_GROUPS, KC, C.icd10)),
    "code_groups": q(lambda i: K.code_groups(i.codes, KC)),
    "state_rates_for_cohort": q(lambda i: i.cohort_rates(STRICT)),
    "state_rates_for_cohort_gap": q(lambda i: i.cohort_rates(GAP)),
    "state_rates_for_cohort_null_safe": q(lambda i: i.cohort_rates(NULL_SAFE)),
    "state_rates_all_claims": q(lambda i: i.cohort_rates(STRICT, cohort=None)),
    "top_states_for_cohort": q(lambda i: i.cohort_rates(GAP, top_n=10)),
    "cohort_by_prefix_table": q(lambda i: K.cohort_by_prefixes(i.claims_icd10(), C.icd10, _prefix_table(i))),
    "cohort_codes_by_prefix_table": q(lambda i: K.cohort_by_prefixes(i.codes, KC.code, _prefix_table(i))),
    "rates_for_five_cohorts": q(lambda i: _many_cohorts(i, cohorts=COHORTS)),
    "rates_for_cohort_table": q(lambda i: _many_cohorts(
        i, prefixes=_cohort_table(i), names=[n for n, d in COHORTS.items() if isinstance(d, list)])),
    "titled_rates": q(lambda i: FD.with_titles(i.cohort_rates(GAP))),
    "state_rates_for_letter_cohort": q(lambda i: i.cohort_rates(GAP, cohort=f"{C.icd10} LIKE 'B%'")),
    "state_rates_for_narrow_cohort": q(lambda i: i.cohort_rates(GAP, cohort=K.cohort_or_all(NINE_GROUPS, C.icd10))),
    "state_rates_for_broad_cohort": q(lambda i: i.cohort_rates(GAP, cohort=K.cohort_or_all(TEN_GROUPS, C.icd10))),
    # feeds
    "top_states": q(lambda i: FD.top_states(i.state_rates(GAP), 10, name=ST.name)),
    "state_map_feed": q(lambda i: FD.state_map_feed(i.state_rates(GAP), i.state, s=ST)),
    "rate_range": q(lambda i: FD.rate_range(i.cohort_rates(GAP))),
    "rate_scaled": q(_rate_scaled),
    "page_of_rates": q(lambda i: FD.page_of(i.rates(GAP), ["year", B.state, B.sex], page=2, size=20)),
    "readmission_preview": q(lambda i: FD.readmission_preview(S.all_cause_readmission(i.claims, GAP, C), 10, C)),
    "rates_preview": q(lambda i: FD.rates_preview(i.rates(GAP), 10, B)),
    "label_rates": q(_label_rates),
    # tables
    "upsert_rates": q(_upsert),
    "upsert_in_place": q(_upsert_in_place),
    "state_rates_stored": q(_state_rates_stored),
    "flag_view": q(_flag_view),
    "row_counts_with_load": q(_counts_with_load),
    "rates_page_by_key": q(_rates_page_by_key),
    "claims_page_by_key": q(_claims_page_by_key),
    "load_claims_checked": q(lambda i: _spoilt_claims(i).good),
    "rejected_claims": q(_rejected_claims),
    "key_violations_mixed": q(_key_violations_mixed),
    "key_violations": q(lambda i: TB.key_violations(i.bene.select(B.person), [B.person])),
    "row_counts": q(lambda i: TB.row_counts({
        "claims": i.claims, "bene": i.bene, "state": i.state,
        "all_cause_readmission": S.all_cause_readmission(i.claims, STRICT, C)})),
    "clustered_claims": q(lambda i: TB.clustered_claims(i.claims, C)),
    # one person with a third of the rows (split path)
    "all_cause_readmission_tied": q(lambda i: S.all_cause_readmission(
        _tied_claims(i), GAP, C, hot_key_rows=SKEW_HOT_ROWS)),
    "all_cause_readmission_tied_unsplit": q(lambda i: S.all_cause_readmission(
        _tied_claims(i), GAP, C, hot_key_rows=-1)),
    "all_cause_readmission_skewed": q(lambda i: S.all_cause_readmission(
        _skewed_claims(i), GAP, C, hot_key_rows=SKEW_HOT_ROWS)),
    "readmission_rate_skewed": q(lambda i: R.readmission_rate(
        _skewed_claims(i), i.bene, GAP, c=C, b=B, hot_key_rows=SKEW_HOT_ROWS)),
    "reload_table": q(_reload_claims),
    # loaders
    "load_claims": q(_load_claims),
    "load_beneficiaries": q(_load_beneficiaries),
    "load_state": q(_load_state),
    "load_icd_crosswalk": q(_load_icd_crosswalk),
    "load_icd10_descriptions": q(_load_icd10_descriptions),
    "stream_ingest_claims": q(_stream_ingest_claims),
    "refresh_state_rates": q(_refresh_state_rates),
}

# Headline queries timed by bench.py.
BENCH_QUERIES = [
    "all_cause_readmission", "all_cause_readmission_null_safe", "all_cause_readmission_gap",
    "claims_icd10", "readmission_rate", "readmission_rate_gap", "state_rates",
    "state_rates_for_cohort_gap",
]

FLAGSHIP = "state_rates"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[FLAGSHIP](spark, sf_dir)


def explain(name: str, spark: SparkSession, sf_dir: str, mode: str = "formatted") -> None:
    QUERIES[name](spark, sf_dir).explain(mode)


__all__ = ["QUERIES", "BENCH_QUERIES", "FLAGSHIP", "flagship", "explain", "Inputs", "F"]
