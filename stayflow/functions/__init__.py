from .codes import (  # noqa: F401
    code_absent, code_group, cohort_predicate, flag_exclusions,
    not_exact, not_prefixed, planned_code, starts_with_any,
)
from .dates import days_between, in_years, parse_date  # noqa: F401
