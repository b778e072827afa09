"""Random claims vs plain Python for the flag and the rates."""

import datetime as dt
import random

import pytest

from stayflow.operators import rates as R
from stayflow.operators import stays as S
from stayflow.rules import CLAIMS_RULES

from conftest import rows_of
from edge_fixture import BENE, CLAIM_SCHEMA, expected_flags, expected_rates
from test_measure import ACR_COLS, RATE_COLS

CODES = ["A10", "B20", "V57", "V5789", "2951", "3004", "3119", "3201", "V642", "V4201", "3751", None]


def random_claims(seed, n=300):
    rnd = random.Random(seed)
    persons = [b[0] for b in BENE] + ["p14", "px"]
    start = dt.date(2007, 11, 1)
    rows = []
    while len(rows) < n:
        p = "p1" if rnd.random() < 0.3 else rnd.choice(persons)        # one hot person
        admit = None if rnd.random() < 0.03 else start + dt.timedelta(days=rnd.randrange(1200))
        cid = None if rnd.random() < 0.02 else f"c{rnd.randrange(400)}"  # ids repeat
        disch = None if rnd.random() < 0.05 or admit is None else admit + dt.timedelta(days=rnd.randrange(-3, 12))
        dx = [rnd.choice(CODES) if rnd.random() < 0.3 else f"X0{k}" for k in range(2, 10)]
        dx1 = rnd.choice(CODES)
        if cid is None and dx1 in ("V4201", "3751"):
            dx1 = "A10"  # a NULL planned claim id empties the rate (tested elsewhere)
        rows.append((p, cid, admit, disch, dx1, *dx, "P1"))
    return rows


@pytest.mark.parametrize("seed", [11, 12, 13])
@pytest.mark.parametrize("hk", [-1, 5])
def test_random_flag_and_rate(spark, seed, hk):
    rows = random_claims(seed)
    claims = spark.createDataFrame(rows, CLAIM_SCHEMA)
    bene = spark.createDataFrame(BENE, "DESYNPUF_ID string, SP_STATE_CODE string, BENE_SEX_IDENT_CD string")
    for rules, mode in [(CLAIMS_RULES, "strict"), (CLAIMS_RULES.with_null_safe(), "null_safe"),
                        (CLAIMS_RULES.gap_only(), "gap")]:
        got = rows_of(S.all_cause_readmission(claims, rules, hot_key_rows=hk), ACR_COLS)
        assert got == expected_flags(rows, mode)
    for rules, mode in [(CLAIMS_RULES, "strict"), (CLAIMS_RULES.gap_only(), "gap")]:
        got = rows_of(R.readmission_rate(claims, bene, rules, hot_key_rows=hk), RATE_COLS)
        assert got == expected_rates(rows, mode)
        assert len(got) > 10 and sum(r[4] for r in got) > 0
