"""Inline dimension tables (a handful of rows each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Sex codes of the beneficiary file.
GENDER_ROWS = [("1", "Male"), ("2", "Female")]

# Age groups of the rate table (0 = all ages).
AGE_GROUP_ROWS = [
    (0, "All ages"),
    (1, "12 or less"),
    (2, "13-19 years"),
    (3, "20-39 years"),
    (4, "40-59 years"),
    (5, "60+ years"),
]

# Condition types of the rate table.
CONDITION_ROWS = [
    (11, "Acute Myocardial Infarction (AMI)"),
    (22, "Chronic Obstructive Pulmonary Disease (COPD)"),
    (33, "Heart Failure (HF)"),
    (44, "Pneumonia"),
    (55, "Coronary Artery Bypass Graft (CABG) Surgery"),
    (66, "Total Hip Arthroplasty / Total Knee Arthroplasty (THA/TKA)"),
    (77, "Sepsis"),
    (88, "Chronic Kidney Disease / ESRD"),
    (99, "Transplants"),
    (100, "Other Conditions"),
]

GENDER_SCHEMA = T.StructType([T.StructField("BENE_SEX_IDENT_CD", T.StringType()),
                              T.StructField("BENE_SEX_IDENT_NM", T.StringType())])
AGE_GROUP_SCHEMA = T.StructType([T.StructField("age_grp_id", T.IntegerType(), False),
                                 T.StructField("age_grp_desc", T.StringType())])
CONDITION_SCHEMA = T.StructType([T.StructField("condition_type_id", T.IntegerType(), False),
                                 T.StructField("condition_type_nm", T.StringType())])


def dim_gender(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(GENDER_ROWS, GENDER_SCHEMA)


def dim_age_group(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(AGE_GROUP_ROWS, AGE_GROUP_SCHEMA)


def dim_condition(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CONDITION_ROWS, CONDITION_SCHEMA)


def dims_sql_values() -> dict[str, str]:
    """The same rows as SQL VALUES lists (for oracle queries)."""
    def q(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    return {
        "gender": ", ".join(f"({q(a)}, {q(b)})" for a, b in GENDER_ROWS),
        "age_group": ", ".join(f"({q(a)}, {q(b)})" for a, b in AGE_GROUP_ROWS),
        "condition": ", ".join(f"({q(a)}, {q(b)})" for a, b in CONDITION_ROWS),
    }
