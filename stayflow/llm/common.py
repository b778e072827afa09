"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_folder, scratch_path

# Byte values of [\x20\x09-\x0D], the white space that separates words.  A
# word [^\x20\x09-\x0D]+ is what bytes.split() yields on UTF-8 text.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD_SQL = r"[^\x20\x09-\x0D]+"

# Rows of an Arrow batch that are Python objects at one time.
ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; any other column
    (whatever its name) is left behind at the scan."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.col(text_col).cast("string").alias("text"))


def map_rows(df: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """Apply a per-row helper in Arrow batches.

    ``make()`` runs once in each task and returns ``fn(*values) -> tuple`` with
    one value per column of ``schema``; ``df``'s columns are its arguments.
    """
    names = [c.split()[0] for c in schema.split(",")]
    kinds = [c.split()[1] for c in schema.split(",")]
    arrow = pa.schema([(n, ARROW[k]) for n, k in zip(names, kinds, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for rb in batches:
            for at in range(0, rb.num_rows, ROWS):
                part = rb.slice(at, ROWS)
                rows = [fn(*r) for r in zip(*(c.to_pylist() for c in part.columns), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(v), f.type) for v, f in zip(zip(*rows, strict=True), arrow, strict=True)],
                    schema=arrow)
    return df.mapInArrow(run, schema)


ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
         "binary": pa.binary(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()),
         "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """Rows of sorted batches by their first column, one row at a time."""
    rows = (r for rb in batches for at in range(0, rb.num_rows, ROWS)
            for r in zip(*(c.to_pylist() for c in rb.slice(at, ROWS).columns), strict=True))
    row = next(rows, None)
    while row is not None:
        key, ended = row[0], False

        def run():
            nonlocal row, ended
            while row is not None and row[0] == key:
                this = row
                row = next(rows, None)
                yield this
            ended = True
        mine = run()
        yield key, mine
        if not ended:
            for _ in mine:
                pass


def in_batches(rows: Iterable[tuple], schema: pa.Schema, most: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded length and size."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += sum(len(x) for x in r if isinstance(x, (str, list)))
        if len(held) >= 4 * ROWS or size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(zip(*held, strict=True), schema,
                                                                                        strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(zip(*held, strict=True), schema,
                                                                                    strict=True)], schema=schema)


def sampled(df: DataFrame, size: int, *keys: str) -> DataFrame:
    """At most ``size`` rows, the same in every run: those with the smallest
    hash of ``keys``.  A first cut by the hash leaves about four times as many
    to be ordered, however large the table is."""
    share = min(1.0, 4.0 * size / max(1, df.count()))
    h = F.xxhash64(*keys)
    cut = df.where(F.pmod(h, F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    return cut.orderBy(h, *keys).limit(size)


def store(df: DataFrame, name: str, **options: str) -> tuple[DataFrame, str]:
    """``df`` as a Parquet table of the shared folder, and its path: work that
    is read again, or that a lost executor must not bring back."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.parquet(path), path


def store_bucketed(df: DataFrame, name: str, buckets: int, key: str, **options: str) -> tuple[DataFrame, str]:
    """As ``store``, bucketed by ``key``: grouping by it needs no shuffle."""
    path = scratch_path(df.sparkSession, name)
    known = table_of(path)
    with shuffles_dropped(df.sparkSession):
        df.write.format("parquet").options(**options).bucketBy(buckets, key).option("path", path).saveAsTable(known)
    return df.sparkSession.table(known), path


def table_of(path: str) -> str:
    """Name that ``store_bucketed`` gives to the table of a folder."""
    return path.rsplit("/", 1)[-1].replace("-", "_")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside are deleted when it ends."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def drop_stored(spark: SparkSession, path: str) -> None:
    """Delete a table that ``store`` or ``store_bucketed`` wrote and nothing
    reads any more."""
    spark.sql(f"DROP TABLE IF EXISTS {table_of(path)}")
    drop_folder(spark, path)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
