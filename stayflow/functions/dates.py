"""Date helpers: text parsing, day differences, year filters that prune."""

from __future__ import annotations

import datetime as _dt
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: date layout of the CSV extracts (e.g. 20080131).
SOURCE_DATE_FORMAT = "yyyyMMdd"


def blank_to_null(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t != F.lit(""), t)


def parse_date(c: Column, fmt: str = SOURCE_DATE_FORMAT, on_error: str = "fail") -> Column:
    """Text -> DATE; blank -> NULL.

    ``on_error="fail"`` raises on an impossible date such as 20080431 (the
    whole load fails, as a bad file did in the reference); ``"null"`` turns it
    into NULL.
    """
    t = blank_to_null(c)
    d = F.try_to_date(t, fmt)
    if on_error == "null":
        return d
    if on_error != "fail":
        raise ValueError(f"on_error must be 'fail' or 'null', got {on_error!r}")
    # Explicit, so the load fails whether or not the session runs ANSI mode.
    bad = F.concat(F.lit(f"cannot parse date ({fmt}): "), t)
    # The date stands here once: it is not parsed again to return what was tested.
    return F.coalesce(d, F.when(t.isNotNull(), F.raise_error(bad).cast("date")))


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole days ``later - earlier`` (SQL DATE - DATE)."""
    return F.datediff(F.col(later) if isinstance(later, str) else later,
                      F.col(earlier) if isinstance(earlier, str) else earlier)


def in_years(c: Column | str, years: Iterable[int]) -> Column:
    """``EXTRACT(YEAR FROM c) IN years``, written as date bounds when the set
    is contiguous so Parquet row groups outside it are skipped."""
    col = F.col(c) if isinstance(c, str) else c
    ys = sorted(set(int(y) for y in years))
    if not ys:
        return F.lit(False)
    if ys == list(range(ys[0], ys[-1] + 1)):
        lo = _dt.date(ys[0], 1, 1)
        hi = _dt.date(ys[-1] + 1, 1, 1)
        return (col >= F.lit(lo)) & (col < F.lit(hi))
    return F.year(col).isin(*ys)
