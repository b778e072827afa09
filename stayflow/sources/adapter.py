"""Claims-shaped views over the synthetic TPC-H-like test tables.

The test tables carry no claims, so a fixed mapping turns them into the five
inputs of the measure (all lazy, all read from the given Parquet files, so the
work grows with the tables):

* claims       orders (+ the part brands of all line items as diagnoses)
* bene         three yearly copies of customer; in the second copy every
               tenth customer has moved to the next state (fan-out case)
* state        nation
* xwalk        part brands -> invented ICD-10-like codes (some brands unmapped)
* codes        the same codes with the part name as description
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..rules import RuleSet
from ..schemas import BeneCols, ClaimCols, CodeCols, Layout, StateCols

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

LAYOUT = Layout(
    claims=ClaimCols(person="person_id", claim="claim_id", admit="admit_dt", disch="disch_dt",
                     dx=tuple(f"d{k}" for k in range(1, 10)), proc1=None, segment=None, icd10="icd10_code",
                     icd10_columns=("person_id", "claim_id", "pay_amt", "admit_dt", "disch_dt", "d1")),
    bene=BeneCols(person="person_id", state="state_code", sex="sex"),
    state=StateCols(name="state_name", code="state_code", abbr="state_abbr"),
    codes=CodeCols(icd9="icd9", icd10="icd10", code="code", description="description"),
)

# Line numbers of an order; nine diagnoses are those of its lines, then of
# lines 1 and 2 again.
LINES = tuple(range(1, 8))

# The rule set in adapter terms.
RULES = RuleSet(
    years=(1996, 1997, 1998),
    max_gap=30,
    exclude_exact="Brand#5",
    exclude_prefixes=("Brand#2",),
    exclude_any_dx="Brand#9",
    planned_prefixes=("Brand#7",),
    planned_codes=("Brand#11", "Brand#12"),
)
# Fixed value: cohort = codes starting with one of these letters.
COHORT_PREFIXES = ("B", "C", "H", "N")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` in ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: brands of the parts on its lines."""
    li = read(spark, sf_dir, "lineitem")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return j.groupBy("l_orderkey").agg(*[
        F.min(F.when(F.col("l_linenumber") == k, F.col("p_brand"))).alias(f"d{k}") for k in LINES])


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    admit = F.col("o_orderdate").cast("date")
    disch = F.when(F.col("o_orderkey") % 25 == 0, F.lit(None).cast("date")) \
             .otherwise(F.date_add(admit, (F.col("o_orderkey") % 8).cast("int")))
    j = o.join(dx(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.select(F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("claim_id"),
                    admit.alias("admit_dt"), disch.alias("disch_dt"),
                    F.col("o_totalprice").cast("decimal(10,2)").alias("pay_amt"),
                    *(f"d{k}" for k in LINES), F.col("d1").alias("d8"), F.col("d2").alias("d9"))


def bene(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = read(spark, sf_dir, "customer")

    def copy(state: Column) -> DataFrame:
        return cu.select(F.col("c_custkey").alias("person_id"), state.alias("state_code"),
                         F.col("c_mktsegment").alias("sex"))
    moved = F.when(F.col("c_custkey") % 10 == 0, (F.col("c_nationkey") + 1) % 25) \
             .otherwise(F.col("c_nationkey"))
    return copy(F.col("c_nationkey")).unionByName(copy(moved)).unionByName(copy(F.col("c_nationkey")))


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    return n.select(F.col("n_name").alias("state_name"), F.col("n_nationkey").alias("state_code"),
                    F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("state_abbr"))


def _brand_no() -> Column:
    return F.substring(F.col("p_brand"), 7, 100).cast("int")


def _code() -> Column:
    return F.concat(F.expr("chr(65 + cast(substring(p_brand, 7, 100) as int))"),
                    F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0"))


def xwalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.where(_brand_no() % 5 != 0).select(F.col("p_brand").alias("icd9"), _code().alias("icd10"))


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(_code().alias("code"), F.col("p_name").alias("description"))


def cohort_column(prefixes=COHORT_PREFIXES, col: str = "icd10_code") -> Column:
    from ..functions.codes import starts_with_any
    return starts_with_any(col, prefixes)
