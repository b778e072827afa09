"""Stay-level operators: filters, previous stay, the 30-day flag, index stays,
planned stays and their null-aware exclusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import flag_exclusions, planned_code
from ..functions.dates import days_between, in_years
from ..rules import RuleSet
from ..schemas import ClaimCols
from .sequence import Track, previous_in_sequence

PREV_DISCHARGE = "prev_discharge_date"
PREV_DIAGNOSIS = "prev_diagnosis"
IS_READMISSION = "is_readmission"


def stay_order(claims: DataFrame, c: ClaimCols) -> list[str]:
    """Admission date, claim id, segment, then every column that the measure
    carries or tests: rows that still tie are the same to it, so the previous
    stay does not depend on the order of the input or on how it is split."""
    names = [c.admit, c.claim, c.segment, c.disch, *c.dx, c.proc1]
    return [n for n in dict.fromkeys(names) if n and n in claims.columns]


def needed(claims: DataFrame, c: ClaimCols, *more: str) -> DataFrame:
    """The columns that the measure reads, so that both branches of the
    sequence scan only them."""
    return claims.select(*dict.fromkeys([c.person, *stay_order(claims, c), *more]))


def complete_stays(claims: DataFrame, c: ClaimCols = ClaimCols()) -> DataFrame:
    """Stays with both an admission and a discharge date."""
    return claims.where(F.col(c.admit).isNotNull() & F.col(c.disch).isNotNull())


def stays_in_years(claims: DataFrame, years, c: ClaimCols = ClaimCols()) -> DataFrame:
    """Stays admitted in one of ``years`` (date bounds when contiguous)."""
    return claims.where(in_years(c.admit, years))


def prev_stay(claims: DataFrame, c: ClaimCols = ClaimCols(), **seq_kw) -> DataFrame:
    """Complete stays with the previous complete stay's discharge date and
    principal diagnosis (NULL for a person's first stay)."""
    seq_kw.setdefault("key_source", claims)
    return previous_in_sequence(
        complete_stays(claims, c), c.person, stay_order(claims, c),
        [Track(F.lit(True), {PREV_DISCHARGE: F.col(c.disch), PREV_DIAGNOSIS: F.col(c.dx1)})],
        **seq_kw)


def readmission_condition(rules: RuleSet, c: ClaimCols = ClaimCols(),
                          prev_col: str = PREV_DISCHARGE) -> Column:
    """TRUE when the stay counts as a readmission after ``prev_col``.

    No lower bound on the gap: an overlapping stay (negative gap) counts, a
    stay admitted on the previous discharge day does not.  Exclusions keep
    SQL NULL semantics (a NULL principal diagnosis is never flagged).
    """
    return readmission_gap(rules, c, prev_col) & flag_exclusions(c.dx1, c.dx[:9], rules)


def readmission_gap(rules: RuleSet, c: ClaimCols = ClaimCols(), prev_col: str = PREV_DISCHARGE) -> Column:
    """The part of ``readmission_condition`` that needs the previous stay."""
    admit, prev = F.col(c.admit), F.col(prev_col)
    return (days_between(admit, prev) <= F.lit(rules.max_gap)) & (admit != prev)


def all_cause_readmission(claims: DataFrame, rules: RuleSet, c: ClaimCols = ClaimCols(),
                          **seq_kw) -> DataFrame:
    """Flagged stays: complete stays whose previous complete stay (any year)
    ended at most ``max_gap`` days before admission, after exclusions."""
    seq_kw.setdefault("key_source", claims)
    # The exclusions are the row's own: tested before the rows move.
    tested = needed(claims, c).withColumn("__counts", flag_exclusions(c.dx1, c.dx[:9], rules))
    p = prev_stay(tested, c, **seq_kw)
    cols = [c.person, c.claim, c.admit, c.disch, c.dx1] + ([c.proc1] if c.proc1 else [])
    return (p.where(readmission_gap(rules, c) & F.col("__counts"))
             .select(*cols, PREV_DISCHARGE, PREV_DIAGNOSIS, F.lit(1).alias(IS_READMISSION)))


def index_condition(rules: RuleSet, c: ClaimCols = ClaimCols(), prev_col: str = PREV_DISCHARGE) -> Column:
    """Index stay: first stay, or more than ``max_gap`` days after the previous one."""
    prev = F.col(prev_col)
    return (days_between(c.admit, prev) > F.lit(rules.max_gap)) | prev.isNull()


def index_stays(claims: DataFrame, rules: RuleSet, c: ClaimCols = ClaimCols(), **seq_kw) -> DataFrame:
    """Stays in the measured years that open a new episode.

    The year filter runs *below* the previous-stay lookup and NULL discharge
    dates are kept, so the previous stay is the previous stay in the years.
    """
    s = stays_in_years(needed(claims, c), rules.years, c)
    seq_kw.setdefault("key_source", claims)
    p = previous_in_sequence(s, c.person, stay_order(claims, c),
                             [Track(F.lit(True), {PREV_DISCHARGE: F.col(c.disch)})], **seq_kw)
    return (p.where(index_condition(rules, c))
             .select(c.claim, c.person, c.admit, F.year(c.admit).alias("year"), PREV_DISCHARGE))


def planned_stays(claims: DataFrame, rules: RuleSet, c: ClaimCols = ClaimCols()) -> DataFrame:
    """Claim ids of planned stays (transplant rule on the principal diagnosis)."""
    return claims.where(planned_code(c.dx1, rules)).select(c.claim)


def exclude_ids(df: DataFrame, ids: DataFrame, col: str, ids_col: str | None = None) -> DataFrame:
    """``df WHERE NOT (col IN (SELECT ids_col FROM ids))`` with SQL NULL rules.

    A NULL among the ids removes every row; a NULL ``col`` survives only an
    empty id set.  Built as an ordinary anti join on the non-null ids (shuffle
    or, when AQE measures the ids as small, broadcast) plus two scalar
    subqueries -- never a nested-loop join.
    """
    ids_col = ids_col or col
    idv = ids.select(F.col(ids_col).alias("__id"))
    stats = idv.agg(F.struct(F.count(F.lit(1)).alias("n"),
                             F.count_if(F.col("__id").isNull()).alias("n_null"))).scalar()
    n_all, n_null = stats.getField("n"), stats.getField("n_null")
    kept = df.join(idv.where(F.col("__id").isNotNull()), F.col(col) == F.col("__id"), "left_anti")
    return kept.where((n_all == F.lit(0)) | (F.col(col).isNotNull() & (n_null == F.lit(0))))


def exclude_planned(stays: DataFrame, claims: DataFrame, rules: RuleSet,
                    c: ClaimCols = ClaimCols()) -> DataFrame:
    """Stays whose claim id is not a planned stay's claim id."""
    if not rules.has_planned_rule:
        return stays
    return exclude_ids(stays, planned_stays(claims, rules, c), c.claim)


# Column names used when both sequences of the rate come out of one pass
# (see rates.episode_counts).
FLAG_PREV = "__prev_dis_complete"
MEASURED_PREV = "__prev_dis_measured"
IS_COMPLETE = "__complete"
IS_MEASURED = "__measured"
