"""stayflow: hospital-readmission analytics on Spark DataFrames."""

from .rules import CLAIMS_RULES, RuleSet  # noqa: F401
from .schemas import BeneCols, ClaimCols, CodeCols, Layout, StateCols  # noqa: F401
from .session import build_session, ensure_checkpoint_dir, materialize  # noqa: F401

__version__ = "0.1.0"
