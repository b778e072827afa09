"""Incremental load of extract files with Structured Streaming.

The batch loaders read a whole folder each time (clear and reload).  When
new extract files keep arriving in a folder, ``ingest_claims`` appends only
the files it has not seen yet to a Parquet table: the file source remembers
processed files in the checkpoint, the Parquet sink commits each batch
atomically, so a restarted or retried run neither loses nor duplicates
files.  The checkpoint stays with the table it describes (by default in a
hidden folder inside it); one table must always be loaded with one checkpoint.  ``availableNow`` processes what is there and stops (a scheduled
job); without it the query keeps running.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schemas import BENEFICIARY_COLUMNS, CLAIM_COLUMNS
from ..sources.files import read_csv_text, typed_projection


def _text_schema(layout) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n, _ in layout])


def _header_schema(spark: SparkSession, folder: str, layout) -> T.StructType:
    try:
        names = read_csv_text(spark, folder).columns
    except AnalysisException:
        names = []
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names]) if names else _text_schema(layout)


def stream_extract(spark: SparkSession, folder: str, layout, on_error: str = "fail",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over the ``*.csv`` files of ``folder``, typed like
    the batch loader.  Columns are bound by the header of the files that are
    there (the layout's own, if there are none yet): other orders and extra
    columns are accepted, and every file is checked against that header
    (``enforceSchema=false``), so none is read by position."""
    r = (spark.readStream.schema(_header_schema(spark, folder, layout)).option("header", True)
              .option("enforceSchema", False).option("mode", "FAILFAST")
              .option("pathGlobFilter", "*.csv"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return typed_projection(r.csv(folder), layout, on_error)


def ingest(spark: SparkSession, folder: str, table_path: str, layout, *,
           checkpoint: str | None = None, available_now: bool = True,
           on_error: str = "fail") -> StreamingQuery:
    """Append the new files of ``folder`` to the Parquet table at ``table_path``."""
    checkpoint = checkpoint or f"{table_path.rstrip('/')}/_ingest_checkpoint"
    w = (stream_extract(spark, folder, layout, on_error).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(table_path)


def ingest_claims(spark: SparkSession, folder: str, table_path: str, **kw) -> StreamingQuery:
    return ingest(spark, folder, table_path, CLAIM_COLUMNS, **kw)


def ingest_beneficiaries(spark: SparkSession, folder: str, table_path: str, **kw) -> StreamingQuery:
    return ingest(spark, folder, table_path, BENEFICIARY_COLUMNS, **kw)
