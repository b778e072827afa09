"""Table maintenance: keyed upsert, key checks, row counts, reload, clustering."""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codes import any_of
from ..schemas import ClaimCols
from ..session import materialize, scratch_path


def as_declared(df: DataFrame, columns) -> DataFrame:
    """``df`` in a table's declared columns and types (list of (name, type))."""
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in columns])


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once or contain a NULL, with counts."""
    keys = list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .where((F.col("n_rows") > 1) | any_of(F.col(k).isNull() for k in keys)))


def checked_keys(df: DataFrame, keys: Sequence[str], what: str = "row") -> DataFrame:
    """``df`` unchanged, but the job fails on a NULL or duplicated key (as an
    INSERT into a keyed table would).

    One pass: a count per key over a window partitioned by the keys -- the
    same hash partitioning the upsert's anti join needs, so when that join is
    a shuffle join it reads this partitioning instead of shuffling again.
    """
    keys = list(keys)
    null_key = any_of(F.col(k).isNull() for k in keys)
    counted = df.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    msg = F.lit(f"duplicate or NULL key in {what}s: {keys}")
    ok = F.when(null_key | (F.col("__n") > 1), F.raise_error(msg).cast("boolean")).otherwise(F.lit(True))
    return counted.where(ok).drop("__n")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], check: bool = True) -> DataFrame:
    """INSERT OR REPLACE by key: rows of ``new`` replace rows of ``old`` with
    the same key; other rows of ``old`` stay.  Anti join + union, both sides
    shuffled once on the key (or ``new`` broadcast when AQE measures it small).
    """
    keys = list(keys)
    newc = new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in old.schema.fields])
    if check:
        newc = checked_keys(newc, keys)
    kept = old.join(newc.select(*keys), keys, "left_anti").select(*old.columns)
    return kept.unionByName(newc)


def upsert_table(path: str, new: DataFrame, keys: Sequence[str], out_path: str | None = None) -> str:
    """Upsert into a Parquet table; writes a new folder (never the one being
    read) and returns its path for the caller to swap in."""
    spark = new.sparkSession
    old = spark.read.parquet(path)
    target = out_path or scratch_path(spark, "upsert")
    upsert(old, new, keys).write.mode("overwrite").parquet(target)
    return target


def upsert_in_place(path: str, new: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    """Upsert into the Parquet table at ``path``, kept in one folder per value
    of the key column ``partition``; returns the table.

    Only partitions that ``new`` has rows of are rewritten, and read: their
    old rows are anti-joined with ``new``, the result is staged as a table of the
    shared folder, where duplicate or NULL keys fail the job, and then put in
    place by dynamic partition overwrite.  Writers stage their files and move them
    when all tasks are done, so a failed run leaves every partition as it was.
    The first call makes the table.
    """
    spark, keys = new.sparkSession, list(keys)
    if partition not in keys:
        raise ValueError(f"partition column {partition} is not among the keys {keys}")
    staged = materialize(checked_keys(new, keys), "upsert-new")
    if table_exists(spark, path):
        old = read_partitioned(spark, path, new.schema)
        hit = [r[0] for r in staged.select(partition).distinct().collect()]  # folders to rewrite
        touched = old.where(F.col(partition).isin(hit))
        staged = materialize(upsert(touched, staged.select(*old.columns), keys, check=False), "upsert-merged")
    (staged.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))
    return read_partitioned(spark, path, new.schema)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A partitioned Parquet table in its declared columns: the partition
    column in its place, its type not guessed from folder names."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Is there a folder with committed data at ``path``?"""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def counted_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Let ``write`` store ``df`` and return the number of rows it stored.

    The rows are counted on their way into the files (``observe``), in the tasks
    that write them, so nothing is scanned again and a task that runs twice counts
    once.  ``write`` must not shuffle.
    """
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n_rows")))
    return seen.get["n_rows"]


def write_counted(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Write each table as Parquet to its folder; one row per table
    (table_name, n_rows), counted by the write itself."""
    def to(path: str) -> Callable[[DataFrame], None]:
        return lambda df: df.write.mode("overwrite").parquet(path)
    spark = next(iter(tables.values()))[0].sparkSession
    return counts_frame(spark, {name: counted_write(df, to(path)) for name, (df, path) in tables.items()})


def counts_frame(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "table_name string, n_rows long")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: (table_name, n_rows)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reload_table(df: DataFrame, path: str) -> DataFrame:
    """Clear-and-reload: overwrite ``path`` with ``df`` and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def replace_view(name: str, df: DataFrame) -> None:
    """Create or replace the SQL view ``name``: recomputed on each read."""
    df.createOrReplaceTempView(name)


def clustered_claims(claims: DataFrame, c: ClaimCols = ClaimCols(), partitions: int | None = None) -> DataFrame:
    """Claims range-partitioned by person and sorted by (person, admission,
    claim) inside each partition: written this way, a person's stays sit
    together and in order.  Range partitioning samples the keys, so one
    heavy person is split across neighbouring partitions."""
    n = partitions or int(claims.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c.person).asc_nulls_last(), F.col(c.admit).asc_nulls_last(), F.col(c.claim).asc_nulls_last()]
    return claims.repartitionByRange(n, *order).sortWithinPartitions(*order)


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int,
                  sort_by: Sequence[str] | None = None, mode: str = "overwrite", path: str | None = None,
                  by_task: bool = False) -> DataFrame:
    """Save ``df`` as a catalog table bucketed by ``keys`` (and sorted within
    buckets), in the folder ``path`` if given; returns the table.  Windows, joins and
    aggregates on ``keys`` over such a table need no shuffle of it -- the claims table
    bucketed by person serves the previous-stay windows and the beneficiary join.
    ``by_task``: the rows are in their buckets already (``repartition(buckets,
    *keys)``), so that a bucket is one file; else each task writes its own file to
    each bucket that it meets."""
    ready = df if by_task or mode != "overwrite" else df.repartition(buckets, *keys)
    w = ready.write.mode(mode).bucketBy(buckets, *keys)
    if sort_by:
        w = w.sortBy(*sort_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return df.sparkSession.table(table)


def has_hot_key(df: DataFrame, key: str, rows: int) -> bool:
    """Does one value of ``key`` (NULL included) hold more than ``rows`` rows?"""
    return not df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows).isEmpty()


# ---------------------------------------------------------------------------
# Paging by key on a stored, sorted table.
# ---------------------------------------------------------------------------
def _key_struct(order: Sequence[str]) -> Column:
    """Sorts like ORDER BY k1 ASC NULLS LAST, k2 ASC NULLS LAST ..."""
    return F.struct(*[x for k in order for x in (F.col(k).isNull().alias(f"n_{k}"), F.col(k).alias(k))])


def store_sorted(df: DataFrame, path: str, order: Sequence[str], files: int | None = None,
                 row_group_bytes: int = 8 << 20) -> None:
    """Store ``df`` sorted by ``order`` (a key: no two rows alike), each file a
    range of it, and beside it an index: one row per file with its first key
    and row count.  Small row groups let a page skip the rest of its file."""
    spark = df.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(k).asc_nulls_last() for k in order]
    (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols).write.mode("overwrite")
       .option("parquet.block.size", row_group_bytes).parquet(f"{path.rstrip('/')}/rows"))
    stored = spark.read.parquet(f"{path.rstrip('/')}/rows")
    (stored.groupBy(F.input_file_name().alias("file")).agg(F.min(_key_struct(order)).alias("first"), F.count("*").alias("n"))
           .write.mode("overwrite").parquet(f"{path.rstrip('/')}/index"))


def _beyond(order: Sequence[str], key: Sequence, after: bool) -> Column:
    """Is a row's key after (or: before) ``key``, NULLs last?  The leading
    column's own bound stands in front, alone: Parquet skips row groups by it."""
    cond = F.lit(False)
    for k, v in reversed(list(zip(order, key, strict=True))):
        c, v = F.col(k), v if isinstance(v, Column) else F.lit(v)
        past = (c > v) | (c.isNull() & v.isNotNull()) if after else (c < v) | (v.isNull() & c.isNotNull())
        cond = F.coalesce(past, F.lit(False)) | (c.eqNullSafe(v) & cond)
    first, v = F.col(order[0]), key[0]
    if v is None:
        return cond & first.isNull() if after else cond
    return cond & ((first >= v) | first.isNull() if after else first <= v)


def page_after(spark: SparkSession, path: str, order: Sequence[str], after: Sequence | None = None, size: int = 10) -> DataFrame:
    """The ``size`` rows that follow the key ``after`` (None: the first rows) of
    a table that ``store_sorted`` wrote, in order.

    Nothing before the key is read, and nothing beyond the files that hold the
    page: the index bounds the key from above as well.  Each page costs the same,
    the thousandth like the first; ``feeds.page_of`` sorts all rows for each.
    """
    rows = spark.read.parquet(f"{path.rstrip('/')}/rows")
    cols = [F.col(k).asc_nulls_last() for k in order]
    later = spark.read.parquet(f"{path.rstrip('/')}/index").orderBy("first")
    if after is not None:
        later = later.where(_beyond([f"first.{k}" for k in order], after, True))
        rows = rows.where(_beyond(order, after, True))
    # Files that start after the key, until they alone could fill the page; the
    # file that holds the key comes before them.  ``size`` + 1 of them suffice.
    found, bound = 0, None
    for f in later.limit(size + 2).collect():
        if found >= size:
            bound = [f["first"][k] for k in order]
            break
        found += f["n"]
    if bound is not None:
        rows = rows.where(_beyond(order, bound, False))
    return rows.orderBy(*cols).limit(size)
