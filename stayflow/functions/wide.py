"""Projections of many computed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_small_methods(c: Column) -> Column:
    """``c`` itself, for one column of a projection of dozens.

    Whole-stage code puts a projection into one Java method, and HotSpot never
    compiles a method over 8,000 bytes: 81 computed columns then run in the
    bytecode interpreter, several times slower.  An operator with a higher-order
    function stays out of whole-stage code, and Spark splits its expressions over
    small methods.  No session setting is touched
    (``spark.sql.codegen.hugeMethodLimit=8000`` would do the same everywhere).
    """
    return F.transform(F.array(c), lambda x: x).getItem(0)
