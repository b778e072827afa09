"""Hand-made claims covering the null / tie / fan-out edge cases, in the
extract's own column layout, and a plain-Python version of each measure."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

D = dt.date
FILL = ["X0%d" % i for i in range(2, 10)]  # diagnoses 2..9, none excluded

CLAIM_SCHEMA = T.StructType(
    [T.StructField("DESYNPUF_ID", T.StringType()), T.StructField("CLM_ID", T.StringType()),
     T.StructField("CLM_ADMSN_DT", T.DateType()), T.StructField("NCH_BENE_DSCHRG_DT", T.DateType())]
    + [T.StructField(f"ICD9_DGNS_CD_{i}", T.StringType()) for i in range(1, 10)]
    + [T.StructField("ICD9_PRCDR_CD_1", T.StringType())])


def claim(person, cid, admit, disch, dx1="A10", dx=None):
    rest = list(dx) if dx is not None else list(FILL)
    return (person, cid, admit, disch, dx1, *rest, "P1")


CLAIMS = [
    # p1: gap 30 -> flagged; next gap 31 -> not flagged
    claim("p1", "c101", D(2008, 1, 1), D(2008, 1, 5)),
    claim("p1", "c102", D(2008, 2, 4), D(2008, 2, 5)),
    claim("p1", "c103", D(2008, 3, 7), D(2008, 3, 9)),
    # p2: admitted on the previous discharge day -> not flagged
    claim("p2", "c201", D(2008, 1, 1), D(2008, 1, 10)),
    claim("p2", "c202", D(2008, 1, 10), D(2008, 1, 12)),
    # p3: overlap (negative gap) -> flagged
    claim("p3", "c301", D(2009, 1, 1), D(2009, 1, 20)),
    claim("p3", "c302", D(2009, 1, 15), D(2009, 1, 25)),
    # p4: NULL discharge in the middle
    claim("p4", "c401", D(2009, 5, 1), D(2009, 5, 5)),
    claim("p4", "c402", D(2009, 5, 10), None),
    claim("p4", "c403", D(2009, 5, 20), D(2009, 5, 25)),
    # p5: NULL admission
    claim("p5", "c501", D(2010, 1, 1), D(2010, 1, 3)),
    claim("p5", "c502", None, D(2010, 1, 9)),
    claim("p5", "c503", D(2010, 1, 20), D(2010, 1, 22)),
    # p6: NULL principal diagnosis -> never flagged
    claim("p6", "c601", D(2010, 2, 1), D(2010, 2, 3)),
    claim("p6", "c602", D(2010, 2, 10), D(2010, 2, 12), dx1=None),
    # p7: one diagnosis NULL, none matching: strict no, null-safe yes
    claim("p7", "c701", D(2010, 3, 1), D(2010, 3, 3)),
    claim("p7", "c702", D(2010, 3, 10), D(2010, 3, 12), dx=FILL[:-1] + [None]),
    # p8: against-advice code among the diagnoses, others NULL
    claim("p8", "c801", D(2010, 4, 1), D(2010, 4, 3)),
    claim("p8", "c802", D(2010, 4, 10), D(2010, 4, 12), dx=[None, None, "V642", None, None, None, None, None]),
    # p9: rehab exact code vs a longer code
    claim("p9", "c901", D(2008, 6, 1), D(2008, 6, 3)),
    claim("p9", "c902", D(2008, 6, 10), D(2008, 6, 12), dx1="V57"),
    claim("p9", "c903", D(2008, 6, 20), D(2008, 6, 22), dx1="V5789"),
    # p10: psychiatric prefixes 29/30/31 excluded, 32 not
    claim("p10", "c1001", D(2008, 7, 1), D(2008, 7, 2)),
    claim("p10", "c1002", D(2008, 7, 5), D(2008, 7, 6), dx1="2951"),
    claim("p10", "c1003", D(2008, 7, 9), D(2008, 7, 10), dx1="3004"),
    claim("p10", "c1004", D(2008, 7, 13), D(2008, 7, 14), dx1="3119"),
    claim("p10", "c1005", D(2008, 7, 17), D(2008, 7, 18), dx1="3201"),
    # p11: tie on admission date, broken by claim id
    claim("p11", "c1102", D(2009, 8, 1), D(2009, 8, 9)),
    claim("p11", "c1101", D(2009, 8, 1), D(2009, 8, 3)),
    claim("p11", "c1103", D(2009, 8, 20), D(2009, 8, 22)),
    # p12: stay in the year before the measured years
    claim("p12", "c1201", D(2007, 12, 20), D(2007, 12, 28)),
    claim("p12", "c1202", D(2008, 1, 10), D(2008, 1, 12)),
    # p13: planned stays (transplant rule), one claim id on two rows
    claim("p13", "c1301", D(2009, 9, 1), D(2009, 9, 3)),
    claim("p13", "c1302", D(2009, 10, 20), D(2009, 10, 22), dx1="V4201"),
    claim("p13", "c1303", D(2009, 12, 1), D(2009, 12, 3), dx1="3751"),
    claim("p13", "c1303", D(2009, 12, 4), D(2009, 12, 6)),
    # p14: not in the beneficiary file
    claim("p14", "c1401", D(2010, 5, 1), D(2010, 5, 3)),
    claim("p14", "c1402", D(2010, 5, 9), D(2010, 5, 10)),
    # p15: lives in two states (fan-out), state code 99 has no state row
    claim("p15", "c1501", D(2010, 6, 1), D(2010, 6, 3)),
    claim("p15", "c1502", D(2010, 6, 9), D(2010, 6, 10), dx1="B20"),
    claim("p15", "c1503", D(2010, 8, 9), D(2010, 8, 10), dx1="B21"),
]

BENE = [  # DESYNPUF_ID, SP_STATE_CODE, BENE_SEX_IDENT_CD
    ("p1", "01", "1"), ("p2", "01", "2"), ("p3", "02", "1"), ("p4", "02", "2"),
    ("p5", "03", "1"), ("p6", "03", "2"), ("p7", "01", "1"), ("p8", "01", "2"),
    ("p9", "02", "1"), ("p10", "02", "2"), ("p11", "03", "1"), ("p12", "03", "2"),
    ("p13", "01", "1"), ("p15", "01", "2"), ("p15", "99", "2"), ("p15", "01", "2"),
]
BENE_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in
                            ("DESYNPUF_ID", "SP_STATE_CODE", "BENE_SEX_IDENT_CD")])

STATE = [("Alabama", "01", "AL"), ("Alaska", "02", "AK"), ("Arizona", "03", "AZ")]
STATE_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in
                             ("state_name", "sp_state_code", "state_abbr")])

XWALK = [  # two ICD-10 for one ICD-9 (smallest wins); B21 unmapped
    ("A10", "E119"), ("A10", "E110"), ("B20", "I214"), ("V57", "Z5189"), ("3201", "G000"),
    ("X02", "R69"),
]
XWALK_SCHEMA = T.StructType([T.StructField("icd9", T.StringType()), T.StructField("icd10", T.StringType())])


def frames(spark):
    return {
        "claims": spark.createDataFrame(CLAIMS, CLAIM_SCHEMA),
        "bene": spark.createDataFrame(BENE, BENE_SCHEMA),
        "state": spark.createDataFrame(STATE, STATE_SCHEMA),
        "xwalk": spark.createDataFrame(XWALK, XWALK_SCHEMA),
    }


# -- brute force ------------------------------------------------------------
# A claim is a tuple in CLAIM_SCHEMA's order.

PERSON, CLAIM, ADMIT, DISCH, DX1 = range(5)
AGAINST_ADVICE, REHAB, PSYCHIATRIC = "V642", "V57", ("29", "30", "31")
# The planned-stay codes.
PLANNED = ("5280", "5281", "5282", "3751", "3350", "3351", "3352", "4697", "4100", "4101", "4102", "4103", "4104", "4105",
           "4106", "4107", "4108", "4109", "5561", "5569", "5051", "5059")


def before(rows):
    """(row, the same person's row just before it or None), by admission,
    claim, discharge and codes, missing values last."""
    last, out = {}, []
    order = lambda r: [(v is None, v if v is not None else "") for v in (r[ADMIT], r[CLAIM], r[DISCH], *r[DX1:])]
    for r in sorted(rows, key=lambda r: [(repr(r[PERSON]),), *order(r)]):
        out.append((r, last.get(r[PERSON])))
        last[r[PERSON]] = r
    return out


def allowed(r, mode):
    """strict, null_safe or gap: may this stay be flagged?"""
    if mode == "gap":
        return True
    codes = r[DX1:DX1 + 9]
    if r[DX1] is None or r[DX1] == REHAB or r[DX1].startswith(PSYCHIATRIC) or AGAINST_ADVICE in codes:
        return False
    return mode == "null_safe" or None not in codes


def gap(r, earlier):
    return (r[ADMIT] - earlier[DISCH]).days if earlier and earlier[DISCH] else None


def expected_flags(rows, mode):
    complete = [r for r in rows if r[ADMIT] and r[DISCH]]
    out = []
    for r, e in before(complete):
        g = gap(r, e)
        if g is not None and g <= 30 and g != 0 and allowed(r, mode):
            out.append((*r[:5], r[-1], e[DISCH], e[DX1], 1))
    return sorted(out, key=repr)


def expected_sets(rows, mode, keys, among=None, planned_rule=True):
    """Group -> (flagged claims, claims), over the beneficiary rows."""
    flags = {f[CLAIM] for f in expected_flags(rows, mode)} - {None}
    years = [r for r in rows if r[ADMIT] and 2008 <= r[ADMIT].year <= 2010 and (among is None or among(r))]
    planned = [r[CLAIM] for r in rows if r[DX1] and (r[DX1].startswith("V42") or r[DX1] in PLANNED)]
    groups = {}
    for r, e in before(years):
        g = gap(r, e)
        if g is not None and g <= 30:
            continue
        if planned_rule and planned and (r[CLAIM] is None or None in planned or r[CLAIM] in planned):
            continue
        for person, state, sex in BENE:
            if person == r[PERSON]:
                at = dict(year=r[ADMIT].year, state=state, sex=sex)
                groups.setdefault(tuple(at[k] for k in keys), set()).add(r[CLAIM])
    return {k: (len(c & flags), len(c - {None})) for k, c in groups.items()}


def expected_rates(rows, mode, keys=("year", "state", "sex")):
    return sorted(((*k, *n) for k, n in expected_sets(rows, mode, keys).items()), key=repr)


def expected_cohort(rows, mode, letters):
    """By state abbreviation, claims whose smallest mapped code starts with one
    of the letters."""
    smallest = {}
    for icd9, icd10 in XWALK:
        smallest[icd9] = min(icd10, smallest.get(icd9, icd10))
    sets = expected_sets(rows, mode, ("state",), lambda r: smallest.get(r[DX1], "").startswith(tuple(letters)), False)
    name = {code: abbr for _, code, abbr in STATE}
    return sorted(((name[k[0]], *n) for k, n in sets.items() if k[0] in name), key=repr)
