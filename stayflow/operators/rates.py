"""Readmission rates: by year/state/sex, by state, and for a cohort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import any_of, cohort_predicate, planned_code
from ..functions.dates import in_years
from ..rules import RuleSet
from ..schemas import BeneCols, ClaimCols, StateCols
from .codes import with_cohorts, with_icd10
from .sequence import Track, previous_in_sequence
from .stays import (FLAG_PREV, IS_COMPLETE, IS_MEASURED, MEASURED_PREV, index_condition,
                    readmission_condition, stay_order)


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as DOUBLE, NULL when den is 0 (never raises under ANSI)."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.try_divide(n.cast("double"), d.cast("double"))


def hundredths_of_percent(num: str, den: str) -> Column:
    """ROUND(num / den * 100, 2) * 100 as an exact integer (half up), for
    non-negative integer columns; NULL when den is 0."""
    n, d = f"CAST(`{num}` AS BIGINT)", f"CAST(`{den}` AS BIGINT)"
    return F.when(F.col(den) != 0, F.expr(f"({n} * 20000 + {d}) div ({d} * 2)"))


def percent_2dp(num: str, den: str) -> Column:
    """ROUND(num / den * 100, 2), half up, computed exactly on integers."""
    return hundredths_of_percent(num, den).cast("double") / F.lit(100.0)


def episode_rows(claims: DataFrame, rules: RuleSet, *, flag_rules: RuleSet | None = None,
                 c: ClaimCols = ClaimCols(), measured: dict[str, Column] | None = None,
                 exclude_planned: bool = True, extra: list[str] | None = None, **seq_kw) -> DataFrame:
    """The rows that count: claim, person, year, ``__flag``, ``__planned`` and
    one truth column per entry of ``measured`` (default ``__index``).

    An entry is a set of stays, narrowed from the measured years by its
    predicate; its column is true for the stays that open an episode, the
    previous stay being taken within that set.  All previous stays (one per
    entry and the flag's) come out of one shuffle by person (sequence.py).
    """
    flag_rules = flag_rules or rules
    sets = {"__index": None} if measured is None else measured
    complete = F.col(c.admit).isNotNull() & F.col(c.disch).isNotNull()
    years = in_years(c.admit, rules.years)
    member = {name: years if pred is None else years & pred for name, pred in sets.items()}
    use_planned = exclude_planned and rules.has_planned_rule
    planned_row = planned_code(c.dx1, rules) if use_planned else F.lit(False)
    order = stay_order(claims, c)
    cols = list(dict.fromkeys([c.person, *order, *(extra or [])]))
    wanted = any_of([complete, *member.values(), planned_row])
    src = (claims.where(wanted)
                 .select(*cols, F.coalesce(complete, F.lit(False)).alias(IS_COMPLETE),
                         *[F.coalesce(m, F.lit(False)).alias(f"{IS_MEASURED}{k}") for k, m in enumerate(member.values())],
                         F.coalesce(planned_row, F.lit(False)).alias("__planned")))
    seq_kw.setdefault("key_source", claims)
    seq = previous_in_sequence(
        src, c.person, order,
        [Track(F.col(IS_COMPLETE), {FLAG_PREV: F.col(c.disch)}),
         *[Track(F.col(f"{IS_MEASURED}{k}"), {f"{MEASURED_PREV}{k}": F.col(c.disch)}) for k in range(len(member))]],
        **seq_kw)
    opens = [(F.col(f"{IS_MEASURED}{k}") & F.coalesce(index_condition(rules, c, f"{MEASURED_PREV}{k}"), F.lit(False)))
             .alias(name) for k, name in enumerate(member)]
    is_flag = F.col(IS_COMPLETE) & F.coalesce(readmission_condition(flag_rules, c, FLAG_PREV), F.lit(False))
    rows = seq.select(c.claim, c.person, F.year(c.admit).alias("year"), *opens, is_flag.alias("__flag"), "__planned")
    return rows.where(any_of([F.col(n) for n in (*member, "__flag", "__planned")]))


def bene_groups(bene: DataFrame, groups: dict[str, str], person: str, b: BeneCols = BeneCols()) -> DataFrame:
    """Distinct (person, group columns) of the beneficiaries."""
    return (bene.select(F.col(b.person).alias(person), *[F.col(src).alias(out) for out, src in groups.items()])
                .distinct().withColumn("__b", F.lit(True)))


def claim_pairs(rows: DataFrame, keys: list[str], c: ClaimCols = ClaimCols()) -> DataFrame:
    """One row per claim and group that its index rows fall in (``__in``), and one
    without group (keys NULL) for its other rows: claim, keys, ``__in``, ``__f``
    (some row of the claim is flagged), ``__p`` (some row is planned).

    ``rows`` carry claim, keys, ``__in`` (the row counts for that group),
    ``__flag`` and ``__planned``.  Rows of one claim and group combine before the
    first shuffle, so a claim id on many rows is a handful of rows after it;
    what is true of the whole claim then spreads over them in a window.  Hash
    aggregation throughout; nothing gathers a set.
    """
    group = [F.when(F.col("__in"), F.col(k)).alias(k) for k in keys]
    small = (rows.select(c.claim, *group, "__in", "__flag", "__planned")
                 .groupBy(c.claim, *keys, "__in").agg(F.max("__flag").alias("__f"), F.max("__planned").alias("__p")))
    whole = Window.partitionBy(c.claim)
    return small.withColumns({"__f": F.max("__f").over(whole), "__p": F.max("__p").over(whole)})


def counted(pairs: DataFrame, keys: list[str], c: ClaimCols = ClaimCols()) -> DataFrame:
    """COUNT(DISTINCT claim) and that of flagged claims per group, without the
    claims that have a planned row (SQL ``NOT IN``).

    The rules for NULL ids need two facts about all claims: are there planned
    rows, and is one of their ids NULL (then nothing is left).  They are counted
    beside the groups, in the row of pairs that fall in no group, and meet the
    groups in a window over this small result, so no second pass over the claims
    is needed.  A NULL claim is in no count, but where no row is planned its group
    exists.
    """
    known, kept = F.col(c.claim).isNotNull(), ~F.col("__p")
    groups = pairs.groupBy(*keys, "__in").agg(
        F.count_if(known & kept & F.col("__f")).alias("readmissions"),
        F.count_if(known & kept).alias("total_admissions"),
        F.count_if(~known & kept).alias("__null"),
        F.count_if(~kept).alias("__planned"), F.count_if(~kept & ~known).alias("__planned_null"))
    everything = Window.partitionBy(F.lit(0))
    whole = groups.withColumns({"__planned": F.sum("__planned").over(everything),
                                "__planned_null": F.sum("__planned_null").over(everything)})
    there = (F.col("total_admissions") > 0) | ((F.col("__null") > 0) & (F.col("__planned") == 0))
    return (whole.where(F.col("__in") & (F.col("__planned_null") == 0) & there)
                 .select(*keys, "readmissions", "total_admissions"))


def episode_pairs(claims: DataFrame, bene: DataFrame, rules: RuleSet, groups: dict[str, str], *,
                  flag_rules: RuleSet | None = None, c: ClaimCols = ClaimCols(), b: BeneCols = BeneCols(),
                  measured: Column | None = None, exclude_planned: bool = True, with_year: bool = True,
                  extra: list[str] | None = None, **seq_kw) -> DataFrame:
    """The distinct (claim, group) pairs that the rates count (``claim_pairs``).

    Semantics: index stays in the measured years (``rules``; ``measured``
    narrows them, e.g. to a cohort), inner-joined to beneficiaries on the
    person id, left-joined by claim id to the stays flagged over all complete
    stays (``flag_rules``) and to the planned stays, which ``counted`` leaves out.

    Plan, with one consumer per stage so nothing is computed twice:
    1. one shuffle by person: both previous stays and the row tests;
    2. the beneficiary groups (collapsed to distinct values first) join on the
       person: a broadcast when AQE measures them small, otherwise a join that
       reads step 1's partitioning by person, so the claims move only once;
    3. rows combine by claim and group, then by claim (``claim_pairs``).
    """
    rows = episode_rows(claims, rules, flag_rules=flag_rules, c=c,
                        measured=None if measured is None else {"__index": measured},
                        exclude_planned=exclude_planned, extra=extra, **seq_kw)
    j = rows.join(bene_groups(bene, groups, c.person, b), c.person, "left")
    keys = (["year"] if with_year else []) + list(groups)
    return claim_pairs(j.withColumn("__in", F.col("__index") & F.col("__b").isNotNull()), keys, c)


def episode_counts(claims: DataFrame, bene: DataFrame, rules: RuleSet, groups: dict[str, str], *,
                   c: ClaimCols = ClaimCols(), with_year: bool = True, **kw) -> DataFrame:
    """COUNT(DISTINCT index claim) and COUNT(DISTINCT index claim that is also
    a flagged claim) per group, groups = (year,) + beneficiary columns."""
    pairs = episode_pairs(claims, bene, rules, groups, c=c, with_year=with_year, **kw)
    return counted(pairs, (["year"] if with_year else []) + list(groups), c)


def readmission_rate(claims: DataFrame, bene: DataFrame, rules: RuleSet, *,
                     flag_rules: RuleSet | None = None, c: ClaimCols = ClaimCols(),
                     b: BeneCols = BeneCols(), exclude_planned: bool = True,
                     by: tuple[str, ...] | None = None, **seq_kw) -> DataFrame:
    """Readmission rate by year, state and sex.

    Denominator: index stays (first stay or previous stay in the measured
    years more than ``max_gap`` days earlier) minus planned stays.  Numerator:
    those of them whose claim id is also flagged by the 30-day flag (computed
    with ``flag_rules``, default ``rules``).  Beneficiaries join on the person
    id only, so a person listed in two states counts in both.

    Default output: the rate table's columns (year, state, sex, counts, age
    group 0, condition 0, rate).  ``by`` picks another grouping, e.g.
    ``("year",)`` or ``("year", "SP_STATE_CODE")``.
    """
    if by is not None:
        # Other groupings: "year" and/or beneficiary columns, in that order.
        bene_cols = [x for x in by if x != "year"]
        counts = episode_counts(claims, bene, rules, {x: x for x in bene_cols}, flag_rules=flag_rules,
                                c=c, b=b, exclude_planned=exclude_planned, with_year="year" in by, **seq_kw)
        keys = [F.col("year").cast("int").alias("year")] if "year" in by else []
        return counts.select(*keys, *bene_cols, "readmissions", "total_admissions",
                             ratio("readmissions", "total_admissions").alias("readmission_rate"))
    counts = episode_counts(claims, bene, rules, {"__state": b.state, "__sex": b.sex},
                            flag_rules=flag_rules, c=c, b=b, exclude_planned=exclude_planned, **seq_kw)
    return counts.select(
        F.col("year").cast("int").alias("year"),
        F.col("__state").alias(b.state), F.col("__sex").alias(b.sex),
        "readmissions", "total_admissions",
        F.lit(0).alias("age_grp_id"), F.lit(0).alias("condition_type_id"),
        ratio("readmissions", "total_admissions").alias("readmission_rate"))


def state_rates(rates: DataFrame, state: DataFrame, *, b: BeneCols = BeneCols(),
                s: StateCols = StateCols()) -> DataFrame:
    """Percent rate by state name: ROUND(SUM(readm)/NULLIF(SUM(adm),0)*100, 2),
    highest first.  The state dimension is tiny; the planner broadcasts it
    from its measured size."""
    j = rates.join(state.select(F.col(s.code).alias("__code"), F.col(s.name).alias(s.name)),
                   F.col(b.state) == F.col("__code"))
    agg = j.groupBy(s.name).agg(F.sum("readmissions").alias("readmissions"),
                                F.sum("total_admissions").alias("total_admissions"))
    return (agg.select(s.name, "readmissions", "total_admissions",
                       percent_2dp("readmissions", "total_admissions").alias("readmission_rate"))
               .orderBy(F.col("readmission_rate").desc_nulls_last(), F.col(s.name).asc_nulls_last()))


def state_rates_for_cohort(claims: DataFrame, xwalk_min: DataFrame | None, bene: DataFrame,
                           state: DataFrame, rules: RuleSet, *, cohort=None,
                           flag_rules: RuleSet | None = None, top_n: int | None = None,
                           c: ClaimCols = ClaimCols(), b: BeneCols = BeneCols(),
                           s: StateCols = StateCols(), icd9: str = "icd9", icd10: str = "icd10",
                           **seq_kw) -> DataFrame:
    """Rate by state abbreviation for the claims of a cohort.

    ``cohort`` is a predicate on the crosswalked ICD-10 code column
    (``c.icd10``): a Column, SQL text or code prefixes; None for all claims.  The previous stay is taken within
    the cohort (cohort stays only), the flag over all claims -- both from one
    shuffle.  No planned-stay exclusion (as in the cohort dashboard).
    Output: state, total_readmissions, total_admissions, readmission_rate
    (fraction), highest rate first, optionally the first ``top_n``.
    """
    src, extra = claims, []
    if cohort is not None:
        cohort = cohort_predicate(c.icd10, cohort)
        if xwalk_min is not None:
            src = with_icd10(claims, xwalk_min, c, icd9=icd9, icd10=icd10)
        # else: ``claims`` already carries the mapped code (stored table)
        extra = [c.icd10]
    by_code = episode_counts(src, bene, rules, {"__state": b.state}, flag_rules=flag_rules, c=c, b=b,
                             measured=cohort, exclude_planned=False, with_year=False, extra=extra, **seq_kw)
    st = state.select(F.col(s.code).alias("__code"), F.col(s.abbr).alias("state"))
    by_abbr = (by_code.join(st, F.col("__state") == F.col("__code"))
                      .groupBy("state")
                      .agg(F.sum("readmissions").alias("total_readmissions"),
                           F.sum("total_admissions").alias("total_admissions")))
    out = (by_abbr.select("state", "total_readmissions", "total_admissions",
                          ratio("total_readmissions", "total_admissions").alias("readmission_rate"))
                  .orderBy(F.col("readmission_rate").desc_nulls_last(), F.col("state").asc_nulls_last()))
    return out.limit(top_n) if top_n else out


def rates_for_cohorts(claims: DataFrame, xwalk_min: DataFrame | None, bene: DataFrame, state: DataFrame, rules: RuleSet, *,
                      cohorts: dict[str, object] | None = None, prefixes: DataFrame | None = None,
                      names: Sequence[str] | None = None, flag_rules: RuleSet | None = None, c: ClaimCols = ClaimCols(),
                      b: BeneCols = BeneCols(), s: StateCols = StateCols(), icd9: str = "icd9", icd10: str = "icd10",
                      **seq_kw) -> DataFrame:
    """``state_rates_for_cohort`` for many cohorts in one pass: a column
    ``cohort`` and one row per cohort and state.

    ``cohorts``: name -> Column, SQL text or prefixes; or a code table ``prefixes``
    (prefix, cohort) with the ``names`` of its cohorts.  Each cohort's
    previous stay is taken within that cohort, all of them (and the flag's) from
    one shuffle of the claims by person: a sequence has one running value per
    cohort.  The work grows with claims x cohorts inside the tasks, not in shuffles;
    take batches of cohorts where they are hundreds.
    """
    if prefixes is not None:
        # The cohorts come with the code, from the crosswalk, where there is one:
        # the claims' codes are among its targets, so the claims are read once.
        if xwalk_min is not None:
            xw = with_cohorts(xwalk_min, icd10, prefixes, out="__cohorts")
            src = with_icd10(claims, xw, c, icd9=icd9, icd10=icd10)
        else:
            src = with_cohorts(claims, c.icd10, prefixes, out="__cohorts")
        member = {n: F.coalesce(F.array_contains("__cohorts", F.lit(n)), F.lit(False)) for n in names or ()}
    else:
        src = claims if xwalk_min is None else with_icd10(claims, xwalk_min, c, icd9=icd9, icd10=icd10)
        member = {n: cohort_predicate(c.icd10, d) for n, d in (cohorts or {}).items()}
    if not member:
        raise ValueError("name at least one cohort")
    columns = [f"__index{k}" for k in range(len(member))]
    seq_kw.setdefault("key_source", claims)
    rows = episode_rows(src, rules, flag_rules=flag_rules, c=c, measured=dict(zip(columns, member.values(), strict=True)),
                        exclude_planned=False, **seq_kw)
    opened = F.filter(F.array(*[F.when(F.col(k), F.lit(n)) for k, n in zip(columns, member, strict=True)]), lambda x: x.isNotNull())
    j = rows.withColumn("__opens", opened).join(bene_groups(bene, {"__state": b.state}, c.person, b), c.person, "left")
    each = j.withColumn("cohort", F.explode_outer("__opens"))
    pairs = claim_pairs(each.withColumn("__in", F.col("cohort").isNotNull() & F.col("__b").isNotNull()), ["cohort", "__state"], c)
    counts = counted(pairs, ["cohort", "__state"], c)
    st = state.select(F.col(s.code).alias("__code"), F.col(s.abbr).alias("state"))
    by_abbr = (counts.join(st, F.col("__state") == F.col("__code")).groupBy("cohort", "state")
                     .agg(F.sum("readmissions").alias("total_readmissions"),
                          F.sum("total_admissions").alias("total_admissions")))
    return by_abbr.select("cohort", "state", "total_readmissions", "total_admissions",
                          ratio("total_readmissions", "total_admissions").alias("readmission_rate"))
