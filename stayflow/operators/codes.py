"""Diagnosis-code operators: crosswalk, crosswalked claims, cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import code_group, cohort_predicate, named_groups
from ..rules import MAX_COHORT_GROUPS
from ..schemas import ClaimCols, CodeCols


def crosswalk_min(xwalk: DataFrame, *, icd9: str = "icd9", icd10: str = "icd10") -> DataFrame:
    """One target per source code: the alphabetically smallest ICD-10."""
    return xwalk.groupBy(icd9).agg(F.min(icd10).alias(icd10))


def with_icd10(claims: DataFrame, xwalk_min: DataFrame, c: ClaimCols = ClaimCols(), *,
               icd9: str = "icd9", icd10: str = "icd10") -> DataFrame:
    """All claim columns plus ``c.icd10`` mapped from the principal diagnosis.

    The crosswalk side is pre-aggregated to one row per ICD-9 code, so the
    left join never multiplies claims; its size is bounded by the code system and it
    is broadcast: a shuffle of the claims by code would bring those of a frequent
    code (and those without one) into one task.
    """
    more = [x for x in xwalk_min.columns if x not in (icd9, icd10)]
    xw = xwalk_min.select(F.col(icd9).alias("__icd9"), F.col(icd10).alias(c.icd10), *more)
    return claims.join(F.broadcast(xw), F.col(c.dx1) == F.col("__icd9"), "left").drop("__icd9")


def claims_icd10(claims: DataFrame, xwalk: DataFrame, c: ClaimCols = ClaimCols(), *,
                 icd9: str = "icd9", icd10: str = "icd10") -> DataFrame:
    """Narrow crosswalked claims table (one row per claim row): the
    ``c.icd10_columns`` the claims have, then the mapped code."""
    m = with_icd10(claims, crosswalk_min(xwalk, icd9=icd9, icd10=icd10), c, icd9=icd9, icd10=icd10)
    cols = [x for x in c.icd10_columns if x in claims.columns] + [c.icd10]
    return m.select(*cols)


def codes_by_prefix(codes: DataFrame, prefix: str, k: CodeCols = CodeCols()) -> DataFrame:
    """Code table rows whose code starts with ``prefix``, ordered by code."""
    return (codes.where(F.col(k.code).startswith(prefix))
                 .select(k.code, k.description)
                 .orderBy(F.col(k.code).asc_nulls_last(), F.col(k.description).asc_nulls_last()))


def condition_cohort(claims_icd10_df: DataFrame, cohort, c: ClaimCols = ClaimCols()) -> DataFrame:
    """Crosswalked claims matching a cohort (Column, SQL text or prefixes)."""
    return claims_icd10_df.where(cohort_predicate(c.icd10, cohort))


COHORT = "cohort"


def cohorts_of_codes(codes: DataFrame, code: str, prefixes: DataFrame, prefix: str = "prefix",
                     cohort: str | None = None) -> DataFrame:
    """Each distinct code of ``codes`` that starts with a prefix of the code
    table ``prefixes`` (with ``cohort``: once per cohort of such a prefix).

    A prefix is a key like any other: a code is cut to the lengths that occur
    among the prefixes, and the cuts are joined to them by hash.  Thousands of
    prefixes cost what one does; an OR chain would test each against each row.  The
    lengths (no more than a code has characters) are a scalar subquery.  NULL
    codes and NULL prefixes match nothing, the empty prefix matches all codes.
    """
    wanted = prefixes.where(F.col(prefix).isNotNull()).select(
        F.col(prefix).alias("__prefix"), *([F.col(cohort).alias(COHORT)] if cohort else [])).distinct()
    lengths = wanted.agg(F.sort_array(F.collect_set(F.length("__prefix")))).scalar()
    distinct = codes.where(F.col(code).isNotNull()).select(F.col(code).alias("__code")).distinct()
    cut = (distinct.withColumn("__lengths", lengths).select("__code", F.explode("__lengths").alias("__n"))
                   .where(F.col("__n") <= F.length("__code")).withColumn("__prefix", F.left("__code", F.col("__n"))))
    return cut.join(wanted, "__prefix").select(F.col("__code").alias(code), *([COHORT] if cohort else [])).distinct()


def cohort_by_prefixes(df: DataFrame, code: str, prefixes: DataFrame, prefix: str = "prefix") -> DataFrame:
    """Rows of ``df`` whose code starts with one of the prefixes: a semi join
    with the distinct codes that do (broadcast: no more than the code system has)."""
    found = cohorts_of_codes(df, code, prefixes, prefix).select(F.col(code).alias("__match"))
    return df.join(F.broadcast(found), F.col(code) == F.col("__match"), "left_semi")


def with_cohorts(df: DataFrame, code: str, prefixes: DataFrame, prefix: str = "prefix", cohort: str = COHORT,
                 out: str = "cohorts") -> DataFrame:
    """``df`` with the array of the cohorts that its code belongs to (empty if
    none): no row is multiplied, and none moves (the codes are broadcast)."""
    of = cohorts_of_codes(df, code, prefixes, prefix, cohort).groupBy(F.col(code).alias("__match")).agg(
        F.sort_array(F.collect_set(COHORT)).alias(out))
    kind = of.schema[out].dataType
    joined = df.join(F.broadcast(of), F.col(code) == F.col("__match"), "left").drop("__match")
    return joined.withColumn(out, F.coalesce(out, F.array().cast(kind)))


def cohort_codes(codes: DataFrame, cohort, k: CodeCols = CodeCols(), claim_code_col: str | None = None) -> DataFrame:
    """The cohort predicate applied to the code table (codes + descriptions).

    A predicate written against the claims' code column is re-pointed at the
    code table's column by renaming that column first.
    """
    src = codes.select(k.code, k.description)
    if claim_code_col and claim_code_col != k.code:
        src = src.withColumnRenamed(k.code, claim_code_col)
        out = src.where(cohort_predicate(claim_code_col, cohort))
        return out.withColumnRenamed(claim_code_col, k.code)
    return src.where(cohort_predicate(k.code, cohort))


def too_broad(cohort, max_groups: int = MAX_COHORT_GROUPS, code_cols=None) -> bool:
    """Does the cohort's definition name ``max_groups`` code groups or more
    (of the code columns)?  It depends on the question alone, never on the data."""
    return cohort is not None and len(named_groups(cohort, code_cols)) >= max_groups


def cohort_breadth(codes: DataFrame, cohort, k: CodeCols = CodeCols(), claim_code_col: str | None = None,
                   max_groups: int = MAX_COHORT_GROUPS) -> DataFrame:
    """One row: codes of the code table in the cohort, code groups named by
    its definition, and whether those are too many."""
    cols = {k.code, claim_code_col or k.code}
    return cohort_codes(codes, cohort, k, claim_code_col).agg(F.count(F.lit(1)).alias("n_codes")).select(
        "n_codes", F.lit(len(named_groups(cohort, cols))).cast("long").alias("n_groups"),
        F.lit(too_broad(cohort, max_groups, cols)).alias("too_broad"))


def cohort_or_all(cohort, claim_code_col: str, max_groups: int = MAX_COHORT_GROUPS) -> Column | None:
    """The dashboard's choice, for callers that ask for it: the cohort's
    predicate, or None (all claims) where its definition is too broad."""
    return None if too_broad(cohort, max_groups, claim_code_col) else cohort_predicate(claim_code_col, cohort)


def code_groups(codes: DataFrame, k: CodeCols = CodeCols()) -> DataFrame:
    """Codes of each code group; codes without one are left out."""
    named = codes.select(code_group(k.code).alias("code_group")).where(F.col("code_group").isNotNull())
    return named.groupBy("code_group").agg(F.count(F.lit(1)).alias("n_codes"))
