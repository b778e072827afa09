"""Result feeds: ranked states, complete map tables, value ranges, paging,
previews and dimension labels.  All lazy; the caller collects."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..rules import DASHBOARD_RATE_RANGE, MAP_EXCLUDED_STATES
from ..session import materialize
from ..schemas import BeneCols, ClaimCols, CodeCols, StateCols
from . import codes as K
from .rates import hundredths_of_percent, state_rates_for_cohort


def top_states(rates: DataFrame, n: int = 10, *, name: str = "state_name",
               rate: str = "readmission_rate") -> DataFrame:
    """The ``n`` highest non-null rates (ties by name): a top-k, planned as
    TakeOrderedAndProject (per-task top-k, no full sort)."""
    return (rates.where(F.col(rate).isNotNull())
                 .orderBy(F.col(rate).desc(), F.col(name).asc_nulls_last())
                 .limit(n))


def state_map_feed(rates: DataFrame, state: DataFrame, *, s: StateCols = StateCols(),
                   rate: str = "readmission_rate",
                   excluded: Sequence[str] = MAP_EXCLUDED_STATES) -> DataFrame:
    """One row per state of the dimension (minus ``excluded``), rate 0 where
    the state has no rate or a NULL rate."""
    names = state.select(s.name).where(~F.col(s.name).isin(*excluded)).distinct()
    r = rates.select(F.col(s.name).alias("__n"), F.col(rate).alias("__r"))
    first = r.groupBy("__n").agg(F.max("__r").alias("__r"))  # names are unique in the feed
    return (names.join(first, F.col(s.name) == F.col("__n"), "left")
                 .select(s.name, F.coalesce(F.col("__r").cast("double"), F.lit(0.0)).alias(rate)))


def rate_range(rates: DataFrame, *, rate: str = "readmission_rate",
               default: tuple[float, float] = (0.0, 1.0), fixed: tuple[float, float] | None = None) -> DataFrame:
    """Min and max of the non-null rates; ``default`` when there is none.
    ``fixed`` (e.g. ``DASHBOARD_RATE_RANGE`` for the unfiltered view) gives
    that range instead of measuring it."""
    if fixed is not None:
        return rates.sparkSession.range(1).select(F.lit(float(fixed[0])).alias("min_rate"),
                                                  F.lit(float(fixed[1])).alias("max_rate"))
    return rates.agg(F.coalesce(F.min(F.col(rate).cast("double")), F.lit(float(default[0]))).alias("min_rate"),
                     F.coalesce(F.max(F.col(rate).cast("double")), F.lit(float(default[1]))).alias("max_rate"))


def rate_scaled(df: DataFrame, range_df: DataFrame, *, rate: str = "readmission_rate",
                out: str = "rate_scaled") -> DataFrame:
    """Linear scaling of ``rate`` to the range's [min, max] (0 when min = max).

    The range is one row; it enters as two scalar subqueries, evaluated once,
    so no join and no single-partition window is needed.
    """
    rng = range_df.select(F.struct("min_rate", "max_rate")).scalar()
    lo, hi = rng.getField("min_rate"), rng.getField("max_rate")
    x = F.col(rate).cast("double")
    return df.withColumn(out, F.when(hi > lo, (x - lo) / (hi - lo)).otherwise(F.lit(0.0)))


def page_of(df: DataFrame, order_by: Sequence[str | Column], page: int = 1, size: int = 10,
            where: Column | str | None = None) -> DataFrame:
    """Page ``page`` (1-based) of ``size`` rows under a total order."""
    if page < 1 or size < 1:
        raise ValueError("page and size must be >= 1")
    d = df.where(where) if where is not None else df
    cols = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]
    return d.orderBy(*cols).offset((page - 1) * size).limit(size)


def readmission_preview(acr: DataFrame, n: int = 10, c: ClaimCols = ClaimCols()) -> DataFrame:
    """First ``n`` flagged stays by (person, admission, claim)."""
    return acr.orderBy(F.col(c.person).asc_nulls_last(), F.col(c.admit).asc_nulls_last(),
                       F.col(c.claim).asc_nulls_last()).limit(n)


def percent_text(num: str, den: str) -> Column:
    """'12.34%' for num/den, rounded half up on exact integers."""
    h = hundredths_of_percent(num, den)
    whole = F.floor(h / F.lit(100)).cast("long")
    return F.concat(whole.cast("string"), F.lit("."),
                    F.lpad((h % 100).cast("string"), 2, "0"), F.lit("%"))


def rates_preview(rates: DataFrame, n: int = 10, b: BeneCols = BeneCols()) -> DataFrame:
    """First ``n`` rate rows by year, state, sex, with the rate as percent text."""
    return (rates.orderBy(F.col("year").asc_nulls_last(), F.col(b.state).asc_nulls_last(),
                          F.col(b.sex).asc_nulls_last())
                 .limit(n)
                 .withColumn("rate_pct", percent_text("readmissions", "total_admissions")))


def label_rates(rates: DataFrame, gender: DataFrame, age_group: DataFrame, condition: DataFrame,
                state: DataFrame, *, b: BeneCols = BeneCols(), s: StateCols = StateCols()) -> DataFrame:
    """Rate rows with the labels of their five key columns (NULL when a code
    has no label).  Dimensions are tiny; the planner broadcasts them."""
    g = gender.select(F.col("BENE_SEX_IDENT_CD").alias("__g"), F.col("BENE_SEX_IDENT_NM").alias("sex_label"))
    a = age_group.select(F.col("age_grp_id").alias("__a"), F.col("age_grp_desc").alias("age_group_label"))
    k = condition.select(F.col("condition_type_id").alias("__k"),
                         F.col("condition_type_nm").alias("condition_label"))
    st = state.select(F.col(s.code).alias("__s"), F.col(s.name).alias("state_label"))
    out = (rates.join(g, F.col(b.sex).cast("string") == F.col("__g"), "left")
                .join(a, F.col("age_grp_id") == F.col("__a"), "left")
                .join(k, F.col("condition_type_id") == F.col("__k"), "left")
                .join(st, F.col(b.state) == F.col("__s"), "left"))
    return out.drop("__g", "__a", "__k", "__s")


# Column titles of the dashboard table.
DASHBOARD_TITLES = {
    "state": "State",
    "total_readmissions": "Total Readmissions",
    "total_admissions": "Total Admissions",
    "readmission_rate": "Readmission Rate",
}


def with_titles(df: DataFrame, titles: dict[str, str] = DASHBOARD_TITLES) -> DataFrame:
    """Rename result columns to display titles (spaces allowed)."""
    return df.select(*[F.col(c).alias(titles.get(c, c)) for c in df.columns])



def cohort_dashboard(claims_icd10: DataFrame, bene: DataFrame, state: DataFrame, codes: DataFrame,
                     rules, cohort=None, *, flag_rules=None, top_n: int = 10,
                     c: ClaimCols = ClaimCols(), b: BeneCols = BeneCols(), s: StateCols = StateCols(),
                     code_col: str = "icd10_cm_code", description_col: str = "description",
                     all_if_too_broad: bool = True, store: bool = True) -> dict[str, DataFrame]:
    """Everything the cohort dashboard shows for one question, as lazy
    DataFrames: the state table, the top states, the colour range, the code
    list and the breadth.

    ``claims_icd10``: claims with the mapped ICD-10 column ``c.icd10`` (all
    claim columns, e.g. ``jobs.refresh_measure``'s stored table).  ``cohort``:
    Column / SQL text / prefixes, or None for all claims (then the fixed
    dashboard range is used).  ``breadth`` tells whether the definition names
    too many code groups; the dashboard then shows all claims, unless
    ``all_if_too_broad`` is off.
    ``store``: compute the state table once (a job now) and derive the other
    outputs from the stored rows; otherwise each output recomputes it.
    """
    k = CodeCols(code=code_col, description=description_col)
    if cohort is None:
        pred, code_list = None, codes.select(code_col, description_col).limit(0)
    else:
        pred = K.cohort_or_all(cohort, c.icd10) if all_if_too_broad else cohort
        code_list = K.cohort_codes(codes, cohort, k, c.icd10)
    table = state_rates_for_cohort(claims_icd10, None, bene, state, rules, cohort=pred,
                                   flag_rules=flag_rules, c=c, b=b, s=s)
    if store:
        # One row per state feeds three outputs: computed once, stored in
        # the shared folder, read three times.
        table = (materialize(table, "cohort-states")
                 .orderBy(F.col("readmission_rate").desc_nulls_last(), F.col("state").asc_nulls_last()))
    return {
        "states": table,
        "top": table.where(F.col("readmission_rate").isNotNull())
                    .orderBy(F.col("readmission_rate").desc(), F.col("state").asc_nulls_last()).limit(top_n),
        "range": rate_range(table, fixed=DASHBOARD_RATE_RANGE if cohort is None else None),
        "codes": code_list,
        "breadth": K.cohort_breadth(codes, cohort, k, c.icd10) if cohort is not None else None,
    }
