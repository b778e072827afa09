"""Clinical rule sets as data.

A ``RuleSet`` holds everything the readmission measure needs besides the
tables: the measured years, the gap, the three exclusion rules of the flag
and the planned-stay (transplant) rule of the rate.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class RuleSet:
    years: tuple[int, ...]
    max_gap: int = 30
    # Flag exclusions on the principal diagnosis (None / () disables a rule).
    exclude_exact: str | None = None
    exclude_prefixes: tuple[str, ...] = ()
    # Code that must be absent from all diagnosis columns.
    exclude_any_dx: str | None = None
    # False: SQL three-valued "code NOT IN (dx...)" (NULL when any dx is NULL
    # and nothing matches, so such a stay is never flagged).
    # True: a stay is excluded only when some non-null dx equals the code.
    null_safe: bool = False
    # Planned stays removed from the rate denominator.
    planned_prefixes: tuple[str, ...] = ()
    planned_codes: tuple[str, ...] = ()

    def gap_only(self) -> "RuleSet":
        """Same measure without any diagnosis exclusion."""
        return replace(self, exclude_exact=None, exclude_prefixes=(), exclude_any_dx=None)

    def with_null_safe(self, value: bool = True) -> "RuleSet":
        return replace(self, null_safe=value)

    @property
    def has_planned_rule(self) -> bool:
        return bool(self.planned_prefixes or self.planned_codes)


# ---------------------------------------------------------------------------
# The claims measure (ICD-9 codes, without period marks).
# ---------------------------------------------------------------------------
MEASURED_YEARS = (2008, 2009, 2010)
MAX_GAP_DAYS = 30
REHAB_CODE = "V57"                       # exact match on diagnosis 1
PSYCHIATRIC_PREFIXES = ("29", "30", "31")  # prefixes of diagnosis 1
AGAINST_ADVICE_CODE = "V642"              # in any of diagnoses 1..9
TRANSPLANT_PREFIXES = ("V42",)
TRANSPLANT_CODES = (
    "5280", "5281", "5282",                # pancreas
    "3751",                                # heart
    "3350", "3351", "3352",                # lung
    "4697",                                # intestine
    "4100", "4101", "4102", "4103", "4104",
    "4105", "4106", "4107", "4108", "4109",  # bone marrow
    "5561", "5569",                        # kidney
    "5051", "5059",                        # liver
)

CLAIMS_RULES = RuleSet(
    years=MEASURED_YEARS,
    max_gap=MAX_GAP_DAYS,
    exclude_exact=REHAB_CODE,
    exclude_prefixes=PSYCHIATRIC_PREFIXES,
    exclude_any_dx=AGAINST_ADVICE_CODE,
    planned_prefixes=TRANSPLANT_PREFIXES,
    planned_codes=TRANSPLANT_CODES,
)

# Territories left off the state map.
MAP_EXCLUDED_STATES = ("District of Columbia", "Puerto Rico")

# Default colour range of the unfiltered dashboard (fraction).
DASHBOARD_RATE_RANGE = (0.0, 0.1)

# Cohort questions naming this many distinct code groups or more are too
# broad (``codes.too_broad``); callers decide what to do with them.
MAX_COHORT_GROUPS = 10
