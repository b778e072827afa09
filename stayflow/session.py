"""Spark session defaults and the shared folder used to cut lineage.

Nothing here starts a server: the UI is off and the driver binds to loopback
only when we build the session ourselves (tests, bench).  On a cluster the
session comes from the platform and only the ``stayflow.*`` settings and the
checkpoint folder are read from it.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows of one entity (person) above which its stay sequence is split across
# tasks instead of being sorted inside one task (see operators/sequence.py).
HOT_KEY_ROWS_CONF = "spark.stayflow.hotKeyRows"
HOT_KEY_ROWS_DEFAULT = 1_000_000


def build_session(master: str | None = None, app: str = "stayflow",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local/test session with the settings the library is tuned for."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Small results still spread over the cores; large shuffles are
        # coalesced by size as usual.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "16g",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def hot_key_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(HOT_KEY_ROWS_CONF, str(HOT_KEY_ROWS_DEFAULT)))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only a local session
    (tests, bench) without it gets a private folder; on a cluster an unset
    folder is an error rather than a machine-local fallback.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                           "(a machine-local folder would be lost with its executor)")
    local = tempfile.mkdtemp(prefix="stayflow-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(_drop_scratch, spark)
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def _drop_scratch(spark: SparkSession) -> None:
    """Delete this process's scratch folders at its end, if its session is
    still up (results read from them are gone with it)."""
    if spark.sparkContext._jsc is None:
        return
    for path in _SCRATCH:
        try:
            drop_folder(spark, path)
        except Exception:  # the JVM may be on its way down
            return


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts lineage so a lost executor only recomputes from the written table,
    and lets several queries read one result (the reference's CTAS tables).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def cluster_conf(input_bytes: float, executors: int, cores_per_executor: int,
                 executor_memory_bytes: float, row_bytes: int = 200,
                 shuffle_fraction: float = 0.5) -> dict[str, str]:
    """Settings sized for a cluster run (pass them at launch).

    * reduce partitions of about 256 MB: the claims shuffle carries roughly
      ``shuffle_fraction`` of the input; never fewer than three waves of tasks;
    * scan splits of 512 MB (Parquet row groups stay whole);
    * AQE coalesces toward 256 MB and splits skewed partitions above 1 GB;
    * broadcast up to 64 MB (dimensions, crosswalk after aggregation);
    * hot person above what a quarter of one task's memory holds.
    """
    mb = 1 << 20
    slots = max(1, executors * cores_per_executor)
    partitions = max(3 * slots, int(input_bytes * shuffle_fraction // (256 * mb)) + 1)
    per_task = executor_memory_bytes / max(1, cores_per_executor)
    hot_rows = max(100_000, int(per_task / (4 * row_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * mb),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * mb),
        "spark.sql.files.maxPartitionBytes": str(512 * mb),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * mb),
        HOT_KEY_ROWS_CONF: str(hot_rows),
    }
