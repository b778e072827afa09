"""Plain-SQL statements of every registered query, for an independent engine.

Written from the meaning of each measure, not from the Spark plans: a person's
stays are numbered and each is paired with the one numbered before it; rates
first build the distinct set of claims of every group and then mark which of
them are flagged or planned.  All rule values are literals here, so an error in
the library's rule sets shows as a difference.  Integer results are BIGINT,
years INTEGER, rates DOUBLE.
"""

from __future__ import annotations

from ..schemas import BENEFICIARY_COLUMNS, CLAIM_COLUMNS

_NO = "CAST(substring(p_brand, 7) AS INTEGER)"
_ICD10 = f"concat(chr(65 + {_NO}), lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0'))"
DX = tuple(f"d{k}" for k in range(1, 10))
_LINES = ", ".join(f"min(CASE WHEN l_linenumber = {k} THEN p_brand END) AS d{k}" for k in range(1, 8))

# The adapter: claims-shaped tables from the given ones.  Nine diagnoses: the
# brands of lines 1 to 7, then those of lines 1 and 2 again.
ADAPTER = f"""
brands AS (
  SELECT l_orderkey, {_LINES}
  FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY l_orderkey),
claims AS (
  SELECT o_custkey AS person_id, o_orderkey AS claim_id, CAST(o_orderdate AS DATE) AS admit_dt,
         CASE WHEN o_orderkey % 25 <> 0
              THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 8 AS INTEGER) END AS disch_dt,
         CAST(o_totalprice AS DECIMAL(10,2)) AS pay_amt,
         d1, d2, d3, d4, d5, d6, d7, d1 AS d8, d2 AS d9
  FROM orders LEFT JOIN brands ON l_orderkey = o_orderkey),
bene AS (
  SELECT c_custkey AS person_id, c_mktsegment AS sex,
         CASE WHEN copy = 2 AND c_custkey % 10 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS state_code
  FROM customer CROSS JOIN (VALUES (1), (2), (3)) years(copy)),
state AS (
  SELECT n_nationkey AS state_code, n_name AS state_name,
         concat('N', CAST(n_nationkey AS VARCHAR)) AS state_abbr FROM nation),
xwalk AS (SELECT p_brand AS icd9, {_ICD10} AS icd10 FROM part WHERE {_NO} % 5 <> 0),
codes AS (SELECT {_ICD10} AS code, p_name AS description FROM part)"""

# One order of a person's stays without ties: date, claim, then what is carried.
STAY_ORDER = ", ".join(f"{c} NULLS LAST" for c in ("admit_dt", "claim_id", "disch_dt", *DX))

STUDY = "year(admit_dt) BETWEEN 1996 AND 1998"
PLANNED = "(starts_with(d1, 'Brand#7') OR d1 = 'Brand#11' OR d1 = 'Brand#12')"
COHORT = "substring({c}, 1, 1) IN ('B', 'C', 'H', 'N')"
NINE_GROUPS = "substring({c}, 1, 2) IN ('B0', 'C0', 'D0', 'E0', 'F0', 'G0', 'H0', 'I0', 'J0')"

# When does the diagnosis allow a flag?  strict: all nine are known and none is
# the against-advice code; null_safe: no known one is; gap: always.
_FIRST = "d1 <> 'Brand#5' AND NOT starts_with(d1, 'Brand#2')"
_ALL_DIFFER = " AND ".join(f"{d} <> 'Brand#9'" for d in DX)
_NONE_EQUAL = " AND ".join(f"{d} IS DISTINCT FROM 'Brand#9'" for d in DX)
ALLOWED = {"strict": f"{_FIRST} AND {_ALL_DIFFER}", "null_safe": f"{_FIRST} AND {_NONE_EQUAL}", "gap": "TRUE"}


def query(select: str, *parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in (ADAPTER, *parts)) + "\n" + select


def paired(name: str, rows: str) -> str:
    """Every row of ``rows`` with the discharge, diagnosis and gap in days of
    the same person's stay just before it."""
    return f"""
{name}_nth AS (
  SELECT r.*, row_number() OVER (PARTITION BY person_id ORDER BY {STAY_ORDER}) AS nth FROM ({rows}) r),
{name} AS (
  SELECT later.*, earlier.disch_dt AS before_dt, earlier.d1 AS before_dx,
         date_diff('day', earlier.disch_dt, later.admit_dt) AS gap
  FROM {name}_nth later LEFT JOIN {name}_nth earlier
    ON earlier.person_id = later.person_id AND earlier.nth + 1 = later.nth)"""


def flagged(name: str, rule: str, claims: str = "claims") -> str:
    """Stays that follow the last complete stay within 30 days, not on its
    last day."""
    return paired(f"{name}_pairs", f"SELECT * FROM {claims} WHERE NOT (admit_dt IS NULL OR disch_dt IS NULL)") + f""",
{name} AS (
  SELECT person_id, claim_id, admit_dt, disch_dt, d1, before_dt AS prev_discharge_date,
         before_dx AS prev_diagnosis, 1 AS is_readmission
  FROM {name}_pairs WHERE gap <> 0 AND gap < 31 AND {ALLOWED[rule]})"""


def openers(name: str, claims: str = "claims", years: str = STUDY) -> str:
    """Stays of the study years that open an episode."""
    return paired(f"{name}_pairs", f"SELECT * FROM {claims} WHERE {years}") + f""",
{name} AS (
  SELECT claim_id, person_id, admit_dt, CAST(year(admit_dt) AS INTEGER) AS year, before_dt AS prev_discharge_date
  FROM {name}_pairs WHERE coalesce(gap, 31) > 30)"""


def counted(name: str, keys: str, *, rule: str, claims: str = "claims", cohort: str = "claims",
            bene: str = "bene", years: str = STUDY, without_planned: bool = True) -> str:
    """Claims and flagged claims of every group: the groups' distinct claims
    first, then a mark on each."""
    planned = f"""
{name}_planned AS (SELECT DISTINCT claim_id AS id FROM {claims} WHERE {PLANNED}),""" if without_planned else ""
    # A claim is outside the planned ids if there are none; or if its own id and
    # all of theirs are known and it is not among them.
    kept = f"""WHERE NOT EXISTS (SELECT 1 FROM {name}_planned)
     OR (s.claim_id IS NOT NULL AND (SELECT count(*) - count(id) FROM {name}_planned) = 0
         AND NOT EXISTS (SELECT 1 FROM {name}_planned p WHERE p.id = s.claim_id))""" if without_planned else ""
    people = "".join(f", {k}" for k in keys.split(", ") if k not in ("year", ""))
    listed, grouped = (f"{keys}, ", f"GROUP BY {keys}") if keys else ("", "")
    return flagged(f"{name}_flag", rule, claims) + "," + openers(f"{name}_open", cohort, years) + f""",
{planned.strip()}
{name}_sets AS (
  SELECT DISTINCT {listed}o.claim_id
  FROM (SELECT DISTINCT person_id{people} FROM {bene}) g JOIN {name}_open o USING (person_id)),
{name} AS (
  SELECT {listed}count(m.claim_id) AS readmissions, count(s.claim_id) AS total_admissions
  FROM {name}_sets s LEFT JOIN (SELECT DISTINCT claim_id FROM {name}_flag) m ON m.claim_id = s.claim_id
  {kept}
  {grouped})"""


def rates(name: str = "rr", rule: str = "strict", **kw) -> str:
    return counted(f"{name}_n", "year, state_code, sex", rule=rule, **kw) + f""",
{name} AS (
  SELECT year, state_code, sex, CAST(readmissions AS BIGINT) AS readmissions,
         CAST(total_admissions AS BIGINT) AS total_admissions, 0 AS age_grp_id, 0 AS condition_type_id,
         CAST(readmissions AS DOUBLE) / nullif(total_admissions, 0) AS readmission_rate
  FROM {name}_n)"""


# round(100 * part / whole, 2) in hundredths, half up, on whole numbers.
HUNDREDTHS = "(({part} * 20000 + {whole}) // nullif({whole} * 2, 0))"


def by_state(name: str = "sr", rule: str = "gap", **kw) -> str:
    percent = HUNDREDTHS.format(part="r", whole="n")
    return rates(f"{name}_rr", rule, **kw) + f""",
{name} AS (
  SELECT state_name, r AS readmissions, n AS total_admissions, CAST({percent} AS DOUBLE) / 100.0 AS readmission_rate
  FROM (SELECT state_name, CAST(sum(readmissions) AS BIGINT) AS r, CAST(sum(total_admissions) AS BIGINT) AS n
        FROM state JOIN {name}_rr USING (state_code) GROUP BY state_name) t)"""


def distinct_rate(keys: str) -> str:
    """Rate of distinct claims by any of the keys (none: the whole)."""
    listed = f"{keys}, " if keys else ""
    return query(f"""SELECT {listed}readmissions, total_admissions,
        CAST(readmissions AS DOUBLE) / nullif(total_admissions, 0) AS readmission_rate FROM x""",
                 counted("x", keys, rule="gap"))


MAPPED = """
smallest AS (SELECT icd9, min(icd10) AS icd10_code FROM xwalk GROUP BY icd9),
mapped AS (SELECT c.*, icd10_code FROM claims c LEFT JOIN smallest ON icd9 = d1)"""
_SHOWN = "person_id, claim_id, pay_amt, admit_dt, disch_dt, d1, icd10_code"


def for_cohort(rule: str, cohort: str | None = COHORT, name: str = "cr") -> str:
    where = f"(SELECT * FROM mapped WHERE {cohort.format(c='icd10_code')})" if cohort else "mapped"
    return MAPPED + "," + counted(f"{name}_n", "state_code", rule=rule, cohort=where, without_planned=False) + f""",
{name} AS (
  SELECT state, r AS total_readmissions, n AS total_admissions, CAST(r AS DOUBLE) / nullif(n, 0) AS readmission_rate
  FROM (SELECT state_abbr AS state, CAST(sum(readmissions) AS BIGINT) AS r, CAST(sum(total_admissions) AS BIGINT) AS n
        FROM state JOIN {name}_n USING (state_code) GROUP BY state_abbr) t)"""


# One cohort after the other; the query takes them in one pass.
COHORT_TESTS = {"b": "substring({c}, 1, 1) = 'B'", "c": "substring({c}, 1, 1) = 'C'", "many": COHORT,
                "low": "substring({c}, 1, 2) IN ('B0', 'C0', 'D0')", "sql": "substring({c}, 1, 1) = 'H'"}


def many_cohorts(names) -> str:
    parts = [for_cohort("gap", COHORT_TESTS[n], name=f"co_{n}").removeprefix(MAPPED + ",") for n in names]
    return query("\nUNION ALL ".join(f"SELECT '{n}' AS cohort, * FROM co_{n}" for n in names), MAPPED, *parts)


PREFIXES = """
prefixes AS (
  SELECT DISTINCT code AS prefix FROM codes WHERE CAST(substring(code, 2) AS INTEGER) % 2 = 0
  UNION SELECT DISTINCT substring(code, 1, 1) FROM codes WHERE code LIKE 'B%' OR code LIKE 'C%')"""

MAP_FEED = """
feed AS (
  SELECT state_name, coalesce(readmission_rate, 0.0) AS readmission_rate
  FROM (SELECT DISTINCT state_name FROM state) s LEFT JOIN sr USING (state_name)
  WHERE state_name <> 'Puerto Rico' AND state_name <> 'District of Columbia')"""
SKEWED = """
heavy AS (SELECT * REPLACE (CASE WHEN claim_id % 3 <> 0 THEN person_id ELSE CAST(1 AS BIGINT) END AS person_id)
          FROM claims)"""
# A second segment of every second claim: same person, claim and admission.
TIED = """
tied AS (
  SELECT * FROM claims UNION ALL
  SELECT * REPLACE (disch_dt + 9 AS disch_dt, d2 AS d1) FROM claims WHERE claim_id % 2 = 0)"""
TIED_HEAVY = TIED + "," + SKEWED.replace("heavy AS", "tied_heavy AS").replace("FROM claims", "FROM tied")

# Labels: fixed rows of the dimensions, and the codes that the query gives to
# the rates so that each dimension is met with matching and missing codes.
LABELS = """
sexes AS (SELECT * FROM (VALUES ('1', 'Male'), ('2', 'Female')) t(sex, sex_label)),
ages AS (SELECT * FROM (VALUES (0, 'All ages'), (1, '12 or less'), (2, '13-19 years'), (3, '20-39 years'),
  (4, '40-59 years'), (5, '60+ years')) t(age_grp_id, age_group_label)),
conditions AS (SELECT * FROM (VALUES (11, 'Acute Myocardial Infarction (AMI)'),
  (22, 'Chronic Obstructive Pulmonary Disease (COPD)'), (33, 'Heart Failure (HF)'), (44, 'Pneumonia'),
  (55, 'Coronary Artery Bypass Graft (CABG) Surgery'),
  (66, 'Total Hip Arthroplasty / Total Knee Arthroplasty (THA/TKA)'), (77, 'Sepsis'),
  (88, 'Chronic Kidney Disease / ESRD'), (99, 'Transplants'), (100, 'Other Conditions'))
  t(condition_type_id, condition_label)),
coded AS (
  SELECT * REPLACE (
    CASE sex WHEN 'AUTOMOBILE' THEN '1' WHEN 'BUILDING' THEN '2' ELSE sex END AS sex,
    CAST(state_code % 7 AS INTEGER) AS age_grp_id,
    CAST(11 * (state_code % 11) AS INTEGER) AS condition_type_id) FROM rr)"""


def filled(column: int, kind: str) -> str:
    """The value that a test extract holds in a column, from the row's number."""
    empty = f"(id + {column}) % 11 = 0"
    value = {"string": f"lpad(CAST((id * {column}) % 1000 AS VARCHAR), 4, '0')",
             "date": f"DATE '2008-01-01' + CAST(id % 900 + {column} AS INTEGER)",
             "integer": f"CAST((id + {column}) % 50 AS INTEGER)"}.get(kind)
    if value is None:  # decimal(p,2)
        value = f"CAST(CAST((id * 7 + {column} * 13) % 100000 AS DOUBLE) / 100 AS {kind.upper()})"
    return f"CASE WHEN NOT ({empty}) THEN {value} END"


def whole_layout(columns, known: dict[str, str], source: str) -> str:
    cols = [f"{known.get(n) or filled(k, t.simpleString() if t.typeName() == 'decimal' else t.typeName())} AS {n}"
            for k, (n, t) in enumerate(columns, 1)]
    return f"SELECT {', '.join(cols)} FROM {source}"


_CLAIM_KNOWN = {"DESYNPUF_ID": "CAST(person_id AS VARCHAR)", "CLM_ID": "CAST(claim_id AS VARCHAR)",
                "CLM_ADMSN_DT": "admit_dt", "NCH_BENE_DSCHRG_DT": "disch_dt", "CLM_PMT_AMT": "pay_amt",
                **{f"ICD9_DGNS_CD_{k}": f"d{k}" for k in range(1, 10)}}
_BENE_KNOWN = {"DESYNPUF_ID": "CAST(person_id AS VARCHAR)",
               "SP_STATE_CODE": "lpad(CAST(state_code AS VARCHAR), 2, '0')", "BENE_SEX_IDENT_CD": "sex"}
LOADED_CLAIMS = query(whole_layout(CLAIM_COLUMNS, _CLAIM_KNOWN, "(SELECT *, claim_id AS id FROM claims) c"))
LOADED_BENE = query(whole_layout(BENEFICIARY_COLUMNS, _BENE_KNOWN, "(SELECT *, person_id AS id FROM bene) b"))

_SPOILT = (("CLM_ADMSN_DT", "20080431", 7), ("CLM_PMT_AMT", "12,50", 11), ("CLM_UTLZTN_DAY_CNT", "ten", 13))
LOADED_GOOD = query(whole_layout(CLAIM_COLUMNS, _CLAIM_KNOWN, f"""(SELECT *, claim_id AS id FROM claims
    WHERE {' AND '.join(f'claim_id % {m} <> 0' for *_, m in _SPOILT)}) c"""))
REJECTED = query("\nUNION ALL ".join(f"""SELECT CAST(claim_id AS VARCHAR) AS CLM_ID, '{c}' AS "column", '{v}' AS "value",
    true AS has_file FROM claims WHERE claim_id % {m} = 0""" for c, v, m in _SPOILT))

_TOP = "ORDER BY readmission_rate DESC NULLS LAST, state LIMIT 10"
_KEYS = "year, state_code, sex, age_grp_id, condition_type_id"

ORACLE: dict[str, str] = {
    "complete_stays": query("SELECT * FROM claims WHERE NOT (admit_dt IS NULL OR disch_dt IS NULL)"),
    "stays_in_years": query(f"SELECT * FROM claims WHERE {STUDY}"),
    "prev_stay": query(f"""SELECT person_id, claim_id, admit_dt, disch_dt, pay_amt, {', '.join(DX)},
        before_dt AS prev_discharge_date, before_dx AS prev_diagnosis FROM p""",
                       paired("p", "SELECT * FROM claims WHERE NOT (admit_dt IS NULL OR disch_dt IS NULL)")),
    "against_advice_filter": query(f"SELECT * FROM claims WHERE {_ALL_DIFFER}"),
    "against_advice_filter_null_safe": query(f"SELECT * FROM claims WHERE {_NONE_EQUAL}"),
    "all_cause_readmission": query("SELECT * FROM f", flagged("f", "strict")),
    "all_cause_readmission_null_safe": query("SELECT * FROM f", flagged("f", "null_safe")),
    "all_cause_readmission_gap": query("SELECT * FROM f", flagged("f", "gap")),
    "all_cause_readmission_skewed": query("SELECT * FROM f", SKEWED, flagged("f", "gap", "heavy")),
    "all_cause_readmission_tied": query("SELECT * FROM f", TIED_HEAVY, flagged("f", "gap", "tied_heavy")),
    "all_cause_readmission_tied_unsplit": query("SELECT * FROM f", TIED_HEAVY, flagged("f", "gap", "tied_heavy")),
    "index_stays": query("SELECT * FROM o", openers("o")),
    "planned_stays": query(f"SELECT claim_id FROM claims WHERE {PLANNED}"),
    "exclude_planned": query(f"""SELECT o.* FROM o LEFT JOIN
        (SELECT DISTINCT claim_id FROM claims WHERE {PLANNED}) p ON p.claim_id = o.claim_id
        WHERE p.claim_id IS NULL""", openers("o")),
    "readmission_rate": query("SELECT * FROM rr", rates()),
    "readmission_rate_gap": query("SELECT * FROM rr", rates(rule="gap")),
    "readmission_rate_skewed": query("SELECT * FROM rr", SKEWED, rates(rule="gap", claims="heavy", cohort="heavy")),
    "state_rates": query("SELECT * FROM sr", by_state()),
    "state_rates_strict": query("SELECT * FROM sr", by_state(rule="strict")),
    "readmission_rate_from_bitmaps": distinct_rate("year, state_code, sex"),
    "incremental_rates": distinct_rate("year, state_code, sex"),
    "year_rates_rolled_up": distinct_rate("year"),
    "total_rate_rolled_up": distinct_rate(""),
    # Distinct claims of a state, not the sum over its years and sexes.
    "state_rates_rolled_up": query(f"""SELECT state_name, readmissions, total_admissions,
        CAST({HUNDREDTHS.format(part="readmissions", whole="total_admissions")} AS DOUBLE) / 100.0 AS readmission_rate
        FROM state JOIN x USING (state_code)""", counted("x", "state_code", rule="gap")),
    "crosswalk_min": query("SELECT icd9, min(icd10) AS icd10 FROM xwalk GROUP BY icd9"),
    "claims_icd10": query(f"SELECT {_SHOWN} FROM mapped", MAPPED),
    "stored_claims_icd10": query(f"SELECT {_SHOWN} FROM mapped", MAPPED),
    "codes_by_prefix": query("SELECT code, description FROM codes WHERE starts_with(code, 'B') "
                             "ORDER BY code, description"),
    "code_groups": query("""SELECT grp AS code_group, count(*) AS n_codes FROM
        (SELECT regexp_extract(code, '^([A-Z][0-9]{1,3})', 1) AS grp FROM codes) t WHERE grp <> '' GROUP BY grp"""),
    "condition_cohort": query(f"SELECT {_SHOWN} FROM mapped WHERE {COHORT.format(c='icd10_code')}", MAPPED),
    "cohort_codes": query(f"SELECT code, description FROM codes WHERE {COHORT.format(c='code')}"),
    # Letters name no code group; nine groups are not too many, ten are.
    "cohort_breadth": query(f"""SELECT count(*) AS n_codes, CAST(0 AS BIGINT) AS n_groups, false AS too_broad
        FROM codes WHERE {COHORT.format(c='code')}"""),
    "cohort_breadth_nine_groups": query(f"""SELECT count(*) AS n_codes, CAST(9 AS BIGINT) AS n_groups,
        false AS too_broad FROM codes WHERE {NINE_GROUPS.format(c='code')}"""),
    "cohort_breadth_ten_groups": query(f"""SELECT count(*) AS n_codes, CAST(10 AS BIGINT) AS n_groups,
        true AS too_broad FROM codes WHERE {NINE_GROUPS.format(c='code')} OR substring(code, 1, 2) = 'K0'"""),
    "state_rates_for_cohort": query("SELECT * FROM cr", for_cohort("strict")),
    "state_rates_for_cohort_gap": query("SELECT * FROM cr", for_cohort("gap")),
    "state_rates_for_cohort_null_safe": query("SELECT * FROM cr", for_cohort("null_safe")),
    "state_rates_all_claims": query("SELECT * FROM cr", for_cohort("strict", None)),
    "state_rates_for_letter_cohort": query("SELECT * FROM cr", for_cohort("gap", "substring({c}, 1, 1) = 'B'")),
    "state_rates_for_narrow_cohort": query("SELECT * FROM cr", for_cohort("gap", NINE_GROUPS)),
    "state_rates_for_broad_cohort": query("SELECT * FROM cr", for_cohort("gap", None)),
    "top_states_for_cohort": query(f"SELECT * FROM cr {_TOP}", for_cohort("gap")),
    "rates_for_five_cohorts": many_cohorts(("b", "c", "many", "low", "sql")),
    "rates_for_cohort_table": many_cohorts(("b", "c", "many", "low")),
    "cohort_by_prefix_table": query(f"""SELECT {_SHOWN} FROM mapped
        WHERE EXISTS (SELECT 1 FROM prefixes WHERE starts_with(icd10_code, prefix))""", MAPPED, PREFIXES),
    "cohort_codes_by_prefix_table": query("""SELECT code, description FROM codes
        WHERE EXISTS (SELECT 1 FROM prefixes WHERE starts_with(code, prefix))""", PREFIXES),
    "titled_rates": query("""SELECT state AS "State", total_readmissions AS "Total Readmissions",
        total_admissions AS "Total Admissions", readmission_rate AS "Readmission Rate" FROM cr""", for_cohort("gap")),
    "top_states": query("SELECT * FROM sr WHERE readmission_rate IS NOT NULL "
                        "ORDER BY readmission_rate DESC, state_name LIMIT 10", by_state()),
    "state_map_feed": query("SELECT * FROM feed", by_state(), MAP_FEED),
    "rate_range": query("SELECT coalesce(min(readmission_rate), 0.0) AS min_rate, "
                        "coalesce(max(readmission_rate), 1.0) AS max_rate FROM cr", for_cohort("gap")),
    "rate_scaled": query("""SELECT state_name, readmission_rate,
        CASE WHEN hi > lo THEN (readmission_rate - lo) / (hi - lo) ELSE 0.0 END AS rate_scaled
        FROM feed CROSS JOIN (SELECT coalesce(min(readmission_rate), 0.0) AS lo,
                                     coalesce(max(readmission_rate), 1.0) AS hi FROM sr) e""", by_state(), MAP_FEED),
    "page_of_rates": query("SELECT * FROM rr ORDER BY year, state_code, sex LIMIT 20 OFFSET 20", rates(rule="gap")),
    "readmission_preview": query("SELECT * FROM f ORDER BY person_id, admit_dt, claim_id LIMIT 10",
                                 flagged("f", "gap")),
    "rates_preview": query("""SELECT year, state_code, sex, readmissions, total_admissions, age_grp_id,
        condition_type_id, readmission_rate,
        concat(CAST(h // 100 AS VARCHAR), '.', lpad(CAST(h % 100 AS VARCHAR), 2, '0'), '%') AS rate_pct
        FROM first_rows""", rates(rule="gap"), f"""
first_rows AS (SELECT *, {HUNDREDTHS.format(part='readmissions', whole='total_admissions')} AS h
  FROM (SELECT * FROM rr ORDER BY year, state_code, sex LIMIT 10) t)"""),
    "label_rates": query("""SELECT r.year, r.state_code, r.sex, r.readmissions, r.total_admissions, r.age_grp_id,
        r.condition_type_id, r.readmission_rate, sex_label, age_group_label, condition_label, state_name AS state_label
        FROM coded r LEFT JOIN sexes USING (sex) LEFT JOIN ages USING (age_grp_id)
        LEFT JOIN conditions USING (condition_type_id) LEFT JOIN state USING (state_code)""", rates(), LABELS),
    "upsert_rates": query(f"""SELECT * FROM new UNION ALL
        SELECT old.* FROM old LEFT JOIN (SELECT {_KEYS}, 1 AS hit FROM new) n USING ({_KEYS}) WHERE hit IS NULL""",
                          rates("old", "strict", years="year(admit_dt) IN (1996, 1997)"),
                          rates("new", "gap", years="year(admit_dt) IN (1997, 1998)")),
    "upsert_in_place": query(f"""SELECT * FROM new UNION ALL
        SELECT old.* FROM old LEFT JOIN (SELECT {_KEYS}, 1 AS hit FROM new) n USING ({_KEYS}) WHERE hit IS NULL""",
                             rates("old", "strict", years="year(admit_dt) IN (1996, 1997)"),
                             rates("new", "gap", years="year(admit_dt) IN (1997, 1998)")),
    "state_rates_stored": query("SELECT * FROM sr", by_state()),
    "flag_view": query("""SELECT CAST(year(admit_dt) AS INTEGER) AS year, count(*) AS n_flagged,
        count(DISTINCT person_id) AS n_persons FROM f GROUP BY 1""", flagged("f", "gap")),
    "row_counts_with_load": query("""SELECT 'claims' AS table_name, (SELECT count(*) FROM claims) AS n_rows
        UNION ALL SELECT 'bene', (SELECT count(*) FROM bene) UNION ALL SELECT 'state', (SELECT count(*) FROM state)
        UNION ALL SELECT 'all_cause_readmission', (SELECT count(*) FROM f)""", flagged("f", "strict")),
    "rates_page_by_key": query("SELECT * FROM rr ORDER BY year, state_code, sex LIMIT 20 OFFSET 20", rates(rule="gap")),
    "claims_page_by_key": query("""SELECT * FROM claims WHERE admit_dt > DATE '1996-06-30'
        OR (admit_dt = DATE '1996-06-30' AND claim_id > 1000) ORDER BY admit_dt, claim_id LIMIT 50"""),
    "load_claims_checked": LOADED_GOOD,
    "rejected_claims": REJECTED,
    "key_violations": query("""SELECT person_id, count(*) AS n_rows FROM bene
        GROUP BY person_id HAVING person_id IS NULL OR count(*) <> 1"""),
    # Unique, repeated and missing keys.
    "key_violations_mixed": query("""SELECT k, count(*) AS n_rows FROM
        (SELECT CASE WHEN claim_id % 10 = 0 THEN NULL WHEN claim_id % 10 < 4 THEN claim_id // 20 ELSE -claim_id END AS k
         FROM claims) t GROUP BY k HAVING k IS NULL OR count(*) <> 1"""),
    "row_counts": query("""SELECT 'claims' AS table_name, (SELECT count(*) FROM claims) AS n_rows
        UNION ALL SELECT 'bene', (SELECT count(*) FROM bene) UNION ALL SELECT 'state', (SELECT count(*) FROM state)
        UNION ALL SELECT 'all_cause_readmission', (SELECT count(*) FROM f)""", flagged("f", "strict")),
    "clustered_claims": query("SELECT * FROM claims"),
    "reload_table": query("SELECT * FROM claims"),
    "load_claims": LOADED_CLAIMS,
    "stream_ingest_claims": LOADED_CLAIMS,
    "load_beneficiaries": LOADED_BENE,
    "load_state": query("SELECT state_name, lpad(CAST(state_code AS VARCHAR), 2, '0') AS sp_state_code, state_abbr "
                        "FROM state"),
    "load_icd_crosswalk": query("SELECT concat('B', lpad(substring(icd9, 7), 4, '0')) AS icd9, icd10 FROM xwalk"),
    "load_icd10_descriptions": query("SELECT code AS icd10_cm_code, trim(description) AS description FROM codes"),
    # The job reads extracts: ids are text (and order as text).
    "refresh_state_rates": query("SELECT * FROM sr", """
texts AS (SELECT * REPLACE (CAST(person_id AS VARCHAR) AS person_id, CAST(claim_id AS VARCHAR) AS claim_id) FROM claims),
people AS (SELECT CAST(person_id AS VARCHAR) AS person_id, state_code, sex FROM bene)""",
                                 by_state(claims="texts", cohort="texts", bene="people")),
}
