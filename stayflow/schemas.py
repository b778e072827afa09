"""Table layouts and the column names operators work on.

Every operator takes its column names from one of the ``*Cols`` records, so
the same code runs on the claims layout of the CSV extracts (defaults) and on
any other table that carries the same facts under other names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Declared column layouts of the source extracts.
# ---------------------------------------------------------------------------

BENEFICIARY_COLUMNS: list[tuple[str, T.DataType]] = [
    ("DESYNPUF_ID", T.StringType()),
    ("BENE_BIRTH_DT", T.DateType()),
    ("BENE_DEATH_DT", T.DateType()),
    ("BENE_SEX_IDENT_CD", T.StringType()),
    ("BENE_RACE_CD", T.StringType()),
    ("BENE_ESRD_IND", T.StringType()),
    ("SP_STATE_CODE", T.StringType()),
    ("BENE_COUNTY_CD", T.StringType()),
    ("BENE_HI_CVRAGE_TOT_MONS", T.IntegerType()),
    ("BENE_SMI_CVRAGE_TOT_MONS", T.IntegerType()),
    ("BENE_HMO_CVRAGE_TOT_MONS", T.IntegerType()),
    ("PLAN_CVRG_MOS_NUM", T.IntegerType()),
    ("SP_ALZHDMTA", T.IntegerType()),
    ("SP_CHF", T.IntegerType()),
    ("SP_CHRNKIDN", T.IntegerType()),
    ("SP_CNCR", T.IntegerType()),
    ("SP_COPD", T.IntegerType()),
    ("SP_DEPRESSN", T.IntegerType()),
    ("SP_DIABETES", T.IntegerType()),
    ("SP_ISCHMCHT", T.IntegerType()),
    ("SP_OSTEOPRS", T.IntegerType()),
    ("SP_RA_OA", T.IntegerType()),
    ("SP_STRKETIA", T.IntegerType()),
    ("MEDREIMB_IP", T.DecimalType(13, 2)),
    ("BENRES_IP", T.DecimalType(13, 2)),
    ("PPPYMT_IP", T.DecimalType(13, 2)),
    ("MEDREIMB_OP", T.DecimalType(13, 2)),
    ("BENRES_OP", T.DecimalType(13, 2)),
    ("PPPYMT_OP", T.DecimalType(13, 2)),
    ("MEDREIMB_CAR", T.DecimalType(13, 2)),
    ("BENRES_CAR", T.DecimalType(13, 2)),
]

_CLAIM_HEAD: list[tuple[str, T.DataType]] = [
    ("DESYNPUF_ID", T.StringType()),
    ("CLM_ID", T.StringType()),
    ("SEGMENT", T.IntegerType()),
    ("CLM_FROM_DT", T.DateType()),
    ("CLM_THRU_DT", T.DateType()),
    ("PRVDR_NUM", T.StringType()),
    ("CLM_PMT_AMT", T.DecimalType(10, 2)),
    ("NCH_PRMRY_PYR_CLM_PD_AMT", T.DecimalType(10, 2)),
    ("AT_PHYSN_NPI", T.StringType()),
    ("OP_PHYSN_NPI", T.StringType()),
    ("OT_PHYSN_NPI", T.StringType()),
    ("CLM_ADMSN_DT", T.DateType()),
    ("ADMTNG_ICD9_DGNS_CD", T.StringType()),
    ("CLM_PASS_THRU_PER_DIEM_AMT", T.DecimalType(10, 2)),
    ("NCH_BENE_IP_DDCTBL_AMT", T.DecimalType(10, 2)),
    ("NCH_BENE_PTA_COINSRNC_LBLTY_AM", T.DecimalType(10, 2)),
    ("NCH_BENE_BLOOD_DDCTBL_LBLTY_AM", T.DecimalType(10, 2)),
    ("CLM_UTLZTN_DAY_CNT", T.IntegerType()),
    ("NCH_BENE_DSCHRG_DT", T.DateType()),
    ("CLM_DRG_CD", T.StringType()),
]
# Numbered code columns: 10 diagnoses, 6 procedures, 45 HCPCS codes.
N_DIAGNOSIS, N_PROCEDURE, N_HCPCS = 10, 6, 45

CLAIM_COLUMNS: list[tuple[str, T.DataType]] = (
    _CLAIM_HEAD
    + [(f"ICD9_DGNS_CD_{i}", T.StringType()) for i in range(1, N_DIAGNOSIS + 1)]
    + [(f"ICD9_PRCDR_CD_{i}", T.StringType()) for i in range(1, N_PROCEDURE + 1)]
    + [(f"HCPCS_CD_{i}", T.StringType()) for i in range(1, N_HCPCS + 1)]
)

STATE_COLUMNS: list[tuple[str, T.DataType]] = [
    ("state_name", T.StringType()),
    ("sp_state_code", T.StringType()),
    ("state_abbr", T.StringType()),
]

# Stored rate table: key = year, state, sex, age group, condition.
RATE_TABLE_COLUMNS: list[tuple[str, T.DataType]] = [
    ("year", T.IntegerType()),
    ("SP_STATE_CODE", T.StringType()),
    ("BENE_SEX_IDENT_CD", T.StringType()),
    ("readmissions", T.IntegerType()),
    ("total_admissions", T.IntegerType()),
    ("age_grp_id", T.IntegerType()),
    ("condition_type_id", T.IntegerType()),
    ("readmission_rate", T.FloatType()),
]
RATE_TABLE_KEYS = ("year", "SP_STATE_CODE", "BENE_SEX_IDENT_CD", "age_grp_id", "condition_type_id")


def struct_of(columns: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns])


# ---------------------------------------------------------------------------
# Column-name records.
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class ClaimCols:
    person: str = "DESYNPUF_ID"
    claim: str = "CLM_ID"
    admit: str = "CLM_ADMSN_DT"
    disch: str = "NCH_BENE_DSCHRG_DT"
    # The exclusion rules read the first nine diagnosis columns.
    dx: tuple[str, ...] = tuple(f"ICD9_DGNS_CD_{i}" for i in range(1, 10))
    proc1: str | None = "ICD9_PRCDR_CD_1"
    # A claim can have several segments, on rows of their own.
    segment: str | None = "SEGMENT"
    icd10: str = "ICD10_DGNS_CODE"
    # Columns of the crosswalked claims table, in order (the mapped code last).
    icd10_columns: tuple[str, ...] = (
        "DESYNPUF_ID", "CLM_ID", "CLM_FROM_DT", "CLM_THRU_DT", "CLM_PMT_AMT", "CLM_ADMSN_DT",
        "CLM_UTLZTN_DAY_CNT", "NCH_BENE_DSCHRG_DT", "CLM_DRG_CD", "ICD9_DGNS_CD_1")

    @property
    def dx1(self) -> str:
        return self.dx[0]


@dataclass(frozen=True)
class BeneCols:
    person: str = "DESYNPUF_ID"
    state: str = "SP_STATE_CODE"
    sex: str = "BENE_SEX_IDENT_CD"


@dataclass(frozen=True)
class StateCols:
    name: str = "state_name"
    code: str = "sp_state_code"
    abbr: str = "state_abbr"


@dataclass(frozen=True)
class CodeCols:
    """Crosswalk (icd9 -> icd10) and description table columns."""
    icd9: str = "icd9"
    icd10: str = "icd10"
    code: str = "icd10_cm_code"
    description: str = "description"


@dataclass(frozen=True)
class Layout:
    claims: ClaimCols = field(default_factory=ClaimCols)
    bene: BeneCols = field(default_factory=BeneCols)
    state: StateCols = field(default_factory=StateCols)
    codes: CodeCols = field(default_factory=CodeCols)
