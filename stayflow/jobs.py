"""Batch job: extracts in, stored measure out.

``refresh_measure`` runs the whole flow of the measure as one Spark
application: load the extracts, store typed tables, compute the rate table,
upsert it in place into the stored rate table (only the years that it has rows
of are rewritten) and store the by-state feed.  Every step is one of the library's
operators; each stored table cuts the lineage, so a lost executor only recomputes
from the last table written.  Rows are counted while they are stored.

Claims and beneficiaries are stored bucketed by person, claims also sorted by
admission: the previous-stay windows and the beneficiary join read them without a
shuffle by person.  Where one person (or NULL) holds more rows than one task should
(``spark.stayflow.hotKeyRows``), a bucket would too; claims are then range-partitioned by
person and admission instead, which splits that person, and the measure shuffles.
Extracts are parsed once: such persons are looked for in the stored table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import codes as K
from .operators import rates as R
from .operators import tables as TB
from .rules import CLAIMS_RULES, RuleSet
from .schemas import RATE_TABLE_COLUMNS, RATE_TABLE_KEYS, BeneCols, ClaimCols, StateCols
from .session import hot_key_rows
from .sources import files as FL


@dataclass
class Stored:
    claims: str
    bene: str
    state: str
    rates: str
    state_rates: str
    claims_icd10: str | None = None
    icd10_codes: str | None = None
    counts: dict[str, int] = field(default_factory=dict)


def _join(base: str, name: str) -> str:
    return base.rstrip("/") + "/" + name


def store_by_person(df: DataFrame, path: str, person: str, sort_by: list[str], buckets: int) -> tuple[DataFrame, int]:
    """``df`` stored in ``path`` by person, and its row count: bucketed unless a
    person is hot (then range-clustered, and read without buckets).

    ``df`` is read once: persons are counted in the bucketed table, of which that
    scans one column and shuffles nothing, and only if one is hot is the table
    written over.  AQE deals the buckets to the writing tasks by their size
    (``rebalance``), a large one to several, so that a hot person is in no one
    task before it is found; without AQE the persons are counted first.
    """
    spark = df.sparkSession
    limit = hot_key_rows(spark)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled").lower() == "true"
    hot = limit >= 0 and not adaptive and TB.has_hot_key(df, person, limit)
    if not hot:
        name = f"stayflow_{uuid.uuid4().hex}"
        dealt = df.hint("rebalance", buckets, person) if adaptive else df.repartition(buckets, person)
        n = TB.counted_write(dealt, lambda d: TB.save_bucketed(
            d, name, [person], buckets, sort_by=[person, *sort_by], path=path, by_task=True))
        stored = spark.table(name)
        if limit < 0 or not adaptive or not TB.has_hot_key(stored, person, limit):
            return stored, n
        spark.sql(f"DROP TABLE {name}")  # its files are written over
    order = [F.col(x).asc_nulls_last() for x in (person, *sort_by)]
    ready = df.repartitionByRange(buckets, *order).sortWithinPartitions(*order)
    n = TB.counted_write(ready, lambda d: d.write.mode("overwrite").parquet(path))
    return spark.read.parquet(path), n


def refresh_measure(spark: SparkSession, *, claims_path: str, bene_path: str, state_path: str,
                    out_dir: str, rules: RuleSet = CLAIMS_RULES, rates_table: str | None = None,
                    run_id: str = "run", crosswalk_path: str | None = None,
                    descriptions_path: str | None = None, buckets: int | None = None) -> Stored:
    """Load extracts, store typed tables, compute and upsert the rate table.

    ``rates_table``: folder of the stored rate table to upsert into (made if
    it is not there; None: one of this run).  Returns the folders written and the
    rows loaded.  ``buckets``: of the tables stored by person (default: the shuffle
    partitions).  With ``crosswalk_path`` the
    crosswalked claims table is stored too (read by every cohort question),
    with ``descriptions_path`` the ICD-10 code table.
    """
    c, b, s = ClaimCols(), BeneCols(), StateCols()
    base = _join(out_dir, run_id)
    claims_dir, bene_dir, state_dir = _join(base, "claims"), _join(base, "bene"), _join(base, "state")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    claims, n_claims = store_by_person(FL.load_claims(spark, claims_path), claims_dir, c.person, [c.admit, c.claim], n)
    bene, n_bene = store_by_person(FL.load_beneficiaries(spark, bene_path), bene_dir, b.person, [], n)
    n_state = TB.counted_write(FL.load_state(spark, state_path), lambda d: d.write.mode("overwrite").parquet(state_dir))
    state = spark.read.parquet(state_dir)

    rates = TB.as_declared(R.readmission_rate(claims, bene, rules, c=c, b=b), RATE_TABLE_COLUMNS)
    rates_dir = rates_table or _join(base, "readmission_rate")
    stored_rates = TB.upsert_in_place(rates_dir, rates, list(RATE_TABLE_KEYS), "year")
    sr_dir = _join(base, "state_rates")
    R.state_rates(stored_rates, state, b=b, s=s).write.mode("overwrite").parquet(sr_dir)
    stored = Stored(claims_dir, bene_dir, state_dir, rates_dir, sr_dir,
                    counts={"claims": n_claims, "bene": n_bene, "state": n_state})
    if crosswalk_path:
        stored.claims_icd10 = _join(base, "claims_icd10")
        xw = FL.load_icd_crosswalk(spark, crosswalk_path)
        # All claim columns plus the mapped code: the cohort rate also needs
        # the diagnoses its flag reads.
        K.with_icd10(claims, K.crosswalk_min(xw), c).write.mode("overwrite").parquet(stored.claims_icd10)
    if descriptions_path:
        stored.icd10_codes = _join(base, "icd10_codes")
        FL.load_icd10_descriptions(spark, descriptions_path).write.mode("overwrite").parquet(stored.icd10_codes)
    return stored


def main(argv: list[str] | None = None) -> None:
    """``python -m stayflow.jobs --claims DIR --bene DIR --state FILE --out DIR``
    (or through spark-submit).  Prints the folders written."""
    import argparse
    import json
    from dataclasses import asdict

    ap = argparse.ArgumentParser(prog="stayflow.jobs", description=refresh_measure.__doc__)
    ap.add_argument("--claims", required=True, help="claims extract folder (*.csv)")
    ap.add_argument("--bene", required=True, help="beneficiary extract folder (*.csv)")
    ap.add_argument("--state", required=True, help="state CSV")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--rates-table", help="stored rate table to upsert into")
    ap.add_argument("--crosswalk", help="ICD-9 to ICD-10 fixed-width file")
    ap.add_argument("--descriptions", help="ICD-10 code fixed-width file")
    ap.add_argument("--run-id", default="run")
    ap.add_argument("--rules", choices=("strict", "null-safe", "gap"), default="strict",
                    help="flag exclusions: all (three-valued), all (NULL-safe), none")
    a = ap.parse_args(argv)
    rules = {"strict": CLAIMS_RULES, "null-safe": CLAIMS_RULES.with_null_safe(),
             "gap": CLAIMS_RULES.gap_only()}[a.rules]
    spark = SparkSession.builder.appName("stayflow-refresh").getOrCreate()
    stored = refresh_measure(spark, claims_path=a.claims, bene_path=a.bene, state_path=a.state,
                             out_dir=a.out, rules=rules, rates_table=a.rates_table, run_id=a.run_id,
                             crosswalk_path=a.crosswalk, descriptions_path=a.descriptions)
    print(json.dumps(asdict(stored)))


if __name__ == "__main__":
    main()
