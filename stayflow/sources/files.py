"""File loaders: CSV extracts (by header name, never inferred) and
fixed-width code files.  Each returns a typed, lazy DataFrame."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import blank_to_null, parse_date
from ..functions.wide import in_small_methods
from ..schemas import BENEFICIARY_COLUMNS, CLAIM_COLUMNS, STATE_COLUMNS
from ..session import materialize

# Texts a fixed-width code file reader treats as missing
# (the default missing-value markers of pandas' text readers).
MISSING_MARKERS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                   "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                   "n/a", "nan", "null")


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _first_line(spark: SparkSession, path: str) -> str:
    """First line of a file through the Hadoop file system API (any scheme)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hp = jvm.org.apache.hadoop.fs.Path(path)
    stream = hp.getFileSystem(conf).open(hp)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
    finally:
        stream.close()
    return (line or "").lstrip("\ufeff").rstrip("\r")


def read_csv_text(spark: SparkSession, path: str | Sequence[str], by_header: bool = False) -> DataFrame:
    """All columns as text, bound by header name.

    A folder reads every ``*.csv`` file in it as one scan.  Spark maps the
    columns of all files by position from one header; with
    ``enforceSchema=false`` every file's header is checked against it on the
    executors, so a file with its columns in another order fails the load
    instead of being read shifted.

    ``by_header=True`` accepts such folders: files are grouped by their header
    line (the driver reads the first line of each file, so keep it for
    folders of a handful of files) and each group is one scan, combined by
    column name.
    """
    reader = (spark.read.option("header", True).option("inferSchema", False)
                   .option("enforceSchema", False).option("mode", "FAILFAST")
                   .option("pathGlobFilter", "*.csv"))
    if not by_header:
        return reader.csv(_paths(path))
    files = sorted(spark.read.option("pathGlobFilter", "*.csv").text(_paths(path)).inputFiles())
    if not files:
        raise FileNotFoundError(f"no *.csv files under {path}")
    groups: dict[str, list[str]] = {}
    for f in files:
        groups.setdefault(_first_line(spark, f), []).append(f)
    out = None
    for group in groups.values():
        df = reader.csv(group)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def typed(col: str, dtype: T.DataType, on_error: str = "fail") -> Column:
    """Cast one text column to its declared type (dates from yyyyMMdd)."""
    c = F.col(f"`{col}`")
    if isinstance(dtype, T.DateType):
        return parse_date(c, on_error=on_error).alias(col)
    if isinstance(dtype, T.StringType):
        return c.alias(col)
    v = blank_to_null(c)
    cast = v.try_cast(dtype)
    if on_error == "null":
        return cast.alias(col)
    bad = F.concat(F.lit(f"cannot read {col} as {dtype.simpleString()}: "), v)
    # The cast stands here once: it is not made again to return what was tested.
    return F.coalesce(cast, F.when(v.isNotNull(), F.raise_error(bad).cast(dtype))).alias(col)


def typed_projection(df: DataFrame, columns: Iterable[tuple[str, T.DataType]],
                     on_error: str = "fail") -> DataFrame:
    """Select the declared columns by name, cast; extra source columns are
    ignored, a missing declared column is an error."""
    columns = list(columns)
    missing = [n for n, _ in columns if n not in df.columns]
    if missing:
        raise ValueError(f"source lacks declared columns: {missing}")
    *head, last = [typed(n, t, on_error) for n, t in columns]
    return df.select(*head, in_small_methods(last).alias(columns[-1][0]))


@dataclass(frozen=True)
class Checked:
    """A load that keeps what does not fit: ``good`` rows in the declared types,
    and ``rejected``: one row for each value that is not of its type."""

    good: DataFrame
    rejected: DataFrame


CORRUPT = "_corrupt_record"


def load_checked(spark: SparkSession, path: str | Sequence[str], columns: Iterable[tuple[str, T.DataType]],
                 keys: Sequence[str] = ()) -> Checked:
    """Typed rows, and the values that kept others out.

    A row is good if each value fits its declared type (blank is NULL).  Of other
    rows ``rejected`` has file, the ``keys`` as text, column and value, for each
    value that does not fit; a line with too few or too many fields is one
    row there, column NULL and value the line.  The files are parsed once, into a
    staged table in the shared folder, from which both are read.
    """
    columns = list(columns)
    header = read_csv_text(spark, path).columns
    missing = [n for n, _ in columns if n not in header]
    if missing:
        raise ValueError(f"source lacks declared columns: {missing}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*header, CORRUPT)])
    # All fields are parsed (no column pruning), or short lines would go unseen.
    raw = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
                .option("pathGlobFilter", "*.csv").csv(_paths(path)))

    # Each value is typed once: the tests read what the first projection made.
    names = {n: f"__typed{k}" for k, (n, t) in enumerate(columns) if not isinstance(t, T.StringType)}
    parsed = raw.select(
        in_small_methods(F.col("_metadata.file_path")).alias("__file"), "*",
        *[typed(n, t, on_error="null").alias(names[n]) for n, t in columns if n in names])

    def misfit(name: str) -> Column:
        text = F.col(f"`{name}`")
        bad = (F.trim(text) != "") & F.col(names[name]).isNull()
        return F.when(bad, F.struct(F.lit(name).alias("column"), text.alias("value")))
    tests = [misfit(n) for n in names] or [F.lit(None).cast("struct<column:string,value:string>")]
    line = F.when(F.col(CORRUPT).isNotNull(), F.array(F.struct(F.lit(None).cast("string").alias("column"),
                                                               F.col(CORRUPT).alias("value"))))
    misfits = F.coalesce(line, F.filter(F.array(*tests), lambda m: m.isNotNull()))
    staged = materialize(parsed.select(
        "__file", misfits.alias("__misfits"),
        F.struct(*[F.col(f"`{k}`").alias(k) for k in keys] or [F.lit(None).cast("string").alias("none")]).alias("__keys"),
        *[F.col(f"`{names.get(n, n)}`").alias(n) for n, _ in columns]), "checked-load")
    good = staged.where(F.size("__misfits") == 0).select(*[f"`{n}`" for n, _ in columns])
    rejected = (staged.where(F.size("__misfits") > 0)
                      .select(F.col("__file").alias("file"), *[F.col(f"__keys.{k}").alias(k) for k in keys],
                              F.explode("__misfits").alias("m")).select("file", *keys, "m.column", "m.value"))
    return Checked(good, rejected)


def load_beneficiaries(spark: SparkSession, path: str | Sequence[str], on_error: str = "fail",
                       by_header: bool = False) -> DataFrame:
    return typed_projection(read_csv_text(spark, path, by_header), BENEFICIARY_COLUMNS, on_error)


def load_claims(spark: SparkSession, path: str | Sequence[str], on_error: str = "fail",
                by_header: bool = False) -> DataFrame:
    return typed_projection(read_csv_text(spark, path, by_header), CLAIM_COLUMNS, on_error)


def load_state(spark: SparkSession, path: str | Sequence[str], by_header: bool = False) -> DataFrame:
    return typed_projection(read_csv_text(spark, path, by_header), STATE_COLUMNS)


def _fixed_field(start: int, width: int | None, markers: Sequence[str]) -> Column:
    raw = F.substring(F.col("value"), start, width if width is not None else 1 << 20)
    t = F.trim(raw)
    return F.when(~t.isin(*markers), t)


def read_fixed_width(spark: SparkSession, path: str | Sequence[str],
                     fields: Sequence[tuple[str, int, int | None]],
                     markers: Sequence[str] = MISSING_MARKERS) -> DataFrame:
    """Fixed-width text: ``fields`` = (name, 1-based start, width).  Fields
    are trimmed; missing markers and short lines give NULL; blank lines are
    skipped.  Lines are split across tasks like any text file."""
    lines = spark.read.text(_paths(path)).where(F.trim(F.col("value")) != F.lit(""))
    return lines.select(*[_fixed_field(s, w, markers).alias(n) for n, s, w in fields])


def load_icd_crosswalk(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """ICD-9 -> ICD-10 general equivalence file: characters [0,5) and [5,14)."""
    return read_fixed_width(spark, path, [("icd9", 1, 5), ("icd10", 6, 9)])


def load_icd10_descriptions(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """ICD-10-CM code file: code in 7 characters, description in the next 180."""
    return read_fixed_width(spark, path, [("icd10_cm_code", 1, 7), ("description", 8, 180)])
