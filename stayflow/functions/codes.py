"""Column expressions over diagnosis codes.

All of them are built-in Catalyst expressions (codegen, no Python per row) and
keep SQL three-valued logic unless a function says otherwise.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import RuleSet


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def any_of(preds: Iterable[Column]) -> Column | None:
    preds = list(preds)
    return reduce(lambda a, b: a | b, preds) if preds else None


def all_of(preds: Iterable[Column]) -> Column | None:
    preds = list(preds)
    return reduce(lambda a, b: a & b, preds) if preds else None


def starts_with_any(c: str | Column, prefixes: Iterable[str]) -> Column | None:
    """``c LIKE 'p1%' OR c LIKE 'p2%' ...`` (NULL when ``c`` is NULL)."""
    return any_of(_col(c).startswith(p) for p in prefixes)


def not_exact(c: str | Column, code: str) -> Column:
    """``c <> code``: NULL when ``c`` is NULL, so a NULL code is not kept."""
    return _col(c) != F.lit(code)


def not_prefixed(c: str | Column, prefixes: Iterable[str]) -> Column | None:
    """``c NOT LIKE 'p1%' AND c NOT LIKE 'p2%' ...``."""
    return all_of(~_col(c).startswith(p) for p in prefixes)


def code_absent(code: str, columns: Iterable[str | Column], null_safe: bool = False) -> Column:
    """Is ``code`` absent from every column?

    ``null_safe=False`` is SQL ``code NOT IN (c1, ..., cn)``: TRUE when all
    columns are non-null and differ, FALSE on a match, NULL otherwise.
    ``null_safe=True`` ignores NULL columns: FALSE only on a real match.
    """
    cols = [_col(c) for c in columns]
    if null_safe:
        return ~any_of(F.coalesce(c == F.lit(code), F.lit(False)) for c in cols)
    return ~F.lit(code).isin(*cols)


def planned_code(c: str | Column, rules: RuleSet) -> Column:
    """Planned-stay rule on one code column: prefix OR exact list."""
    parts = []
    if rules.planned_prefixes:
        parts.append(starts_with_any(c, rules.planned_prefixes))
    if rules.planned_codes:
        parts.append(_col(c).isin(*rules.planned_codes))
    return any_of(parts) if parts else F.lit(False)


def flag_exclusions(dx1: str | Column, dx_all: Iterable[str | Column], rules: RuleSet) -> Column:
    """Conjunction of the flag's diagnosis exclusions (TRUE = keep)."""
    parts = []
    if rules.exclude_exact is not None:
        parts.append(not_exact(dx1, rules.exclude_exact))
    if rules.exclude_prefixes:
        parts.append(not_prefixed(dx1, rules.exclude_prefixes))
    if rules.exclude_any_dx is not None:
        parts.append(code_absent(rules.exclude_any_dx, dx_all, rules.null_safe))
    return all_of(parts) if parts else F.lit(True)


# Fixed value: shape of a code group (a letter and one to three digits, e.g.
# I21, E11, C50).
CODE_GROUP = r"[A-Z][0-9]{1,3}"
CODE_GROUP_PATTERN = rf"^({CODE_GROUP})"


def named_groups(cohort, code_cols: str | Iterable[str] | None = None) -> set[str]:
    """Code groups that a cohort's definition names: prefixes that are a whole
    code group (``I21``, not ``I`` or ``I2101``), or the same as ``LIKE 'I21%'``
    or ``startswith`` on a code column, in SQL text or in a Column.

    ``code_cols`` names the code column (or columns); tests of others name no
    group.  None takes any column.  Groups are upper-case; SQL words are not
    case-sensitive.
    """
    cols = None if code_cols is None else {code_cols} if isinstance(code_cols, str) else set(code_cols)
    if isinstance(cohort, Column):
        return set(_groups_of_node(cohort._jc.node(), cols))
    if isinstance(cohort, str):
        return set(_groups_of_text(cohort, cols))
    return {p for p in cohort if re.fullmatch(CODE_GROUP, p)}


_NAME = r"`?([A-Za-z_][\w.]*)`?"
_LIKE = re.compile(rf"{_NAME}\s+(?i:not\s+)?(?i:like)\s+'({CODE_GROUP})%'")
_STARTS = re.compile(rf"(?i:starts_?with)\s*\(\s*{_NAME}\s*,\s*'({CODE_GROUP})'\s*\)")


def _is_code(name: str, cols: set[str] | None) -> bool:
    return cols is None or name.rpartition(".")[2] in cols


def _groups_of_text(sql: str, cols: set[str] | None) -> Iterable[str]:
    return (group for pattern in (_LIKE, _STARTS) for name, group in pattern.findall(sql) if _is_code(name, cols))


def _groups_of_node(node, cols: set[str] | None) -> Iterable[str]:
    """Walk a Column's expression tree."""
    kind = node.getClass().getSimpleName()
    if kind == "SqlExpression":
        yield from _groups_of_text(node.expression(), cols)
        return
    parts = [node.children().apply(k) for k in range(node.children().size())]
    if kind == "UnresolvedFunction" and node.functionName().lower() in ("startswith", "like") and len(parts) >= 2:
        kinds = [p.getClass().getSimpleName() for p in parts[:2]]
        if kinds == ["UnresolvedAttribute", "Literal"] and _is_code(parts[0].nameParts().last(), cols):
            text = str(parts[1].value()).removesuffix("%" if node.functionName().lower() == "like" else "")
            whole = node.functionName().lower() == "startswith" or str(parts[1].value()).endswith("%")
            if whole and re.fullmatch(CODE_GROUP, text):
                yield text
        return
    for p in parts:
        yield from _groups_of_node(p, cols)


def code_group(c: str | Column, pattern: str = CODE_GROUP_PATTERN) -> Column:
    """Leading code group of a code, NULL when it has none."""
    g = F.regexp_extract(_col(c), pattern, 1)
    return F.when(g != F.lit(""), g)


def cohort_predicate(code_col: str | Column, cohort) -> Column:
    """Turn a cohort definition into a predicate on a code column.

    ``cohort`` is a Column, an SQL boolean expression string, or an iterable
    of code prefixes (``LIKE 'p%'`` each, OR-ed).
    """
    if isinstance(cohort, Column):
        return cohort
    if isinstance(cohort, str):
        return F.expr(cohort)
    return starts_with_any(code_col, list(cohort))
