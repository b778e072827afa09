"""Write claims-shaped tables out in the layouts of the source extracts.

Used to run the loaders on data derived from the given tables (a round trip
whose result must equal the derived table), and by anyone who needs to hand
an extract to another system.  All writes are Spark jobs into the folder the
caller names (by default a fresh folder under the shared checkpoint folder).
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import SOURCE_DATE_FORMAT
from ..functions.wide import in_small_methods
from ..schemas import BENEFICIARY_COLUMNS, CLAIM_COLUMNS, STATE_COLUMNS
from ..session import scratch_path


def _text(c: Column, dtype_name: str) -> Column:
    if dtype_name == "date":
        return F.date_format(c, SOURCE_DATE_FORMAT)
    return c.cast("string")


def to_extract_frame(df: DataFrame, layout, mapping: Mapping[str, Column]) -> DataFrame:
    """Project ``df`` onto an extract layout: every declared column, as text,
    from ``mapping`` (column name -> expression) or empty."""
    cols = []
    for name, dtype in layout:
        expr = mapping.get(name)
        cols.append(_text(expr, dtype.typeName()) if expr is not None else F.lit(None).cast("string"))
    cols[-1] = in_small_methods(cols[-1])
    return df.select(*[c.alias(name) for c, (name, _) in zip(cols, layout, strict=True)])


def write_csv_extract(df: DataFrame, path: str | None = None, files: int | None = None) -> str:
    """CSV with a header line per file; ``files`` output files (default: as
    partitioned).  Returns the folder."""
    path = path or scratch_path(df.sparkSession, "extract")
    out = df.repartition(files) if files else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_fixed_width(df: DataFrame, widths: Mapping[str, int], path: str | None = None) -> str:
    """Fixed-width text: each column right-padded to its width.  A value longer
    than its column fails the job."""
    path = path or scratch_path(df.sparkSession, "fixed")
    line = F.concat(*[_padded(c, w) for c, w in widths.items()])
    df.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def _padded(name: str, width: int) -> Column:
    v = F.coalesce(F.col(name).cast("string"), F.lit(""))
    bad = F.concat(F.lit(f"{name} does not fit into {width} characters: "), v)
    return F.when(F.length(v) > width, F.raise_error(bad).cast("string")).otherwise(F.rpad(v, width, " "))


def claims_extract(claims: DataFrame, mapping: Mapping[str, Column]) -> DataFrame:
    return to_extract_frame(claims, CLAIM_COLUMNS, mapping)


def beneficiary_extract(bene: DataFrame, mapping: Mapping[str, Column]) -> DataFrame:
    return to_extract_frame(bene, BENEFICIARY_COLUMNS, mapping)


def state_extract(state: DataFrame, mapping: Mapping[str, Column]) -> DataFrame:
    return to_extract_frame(state, STATE_COLUMNS, mapping)
