"""Spark session helpers and lineage cutting.

Nothing here hides Spark: the builder is the ordinary one with the settings
the rest of the library assumes (UTC session time, AQE on, Arrow on, UI off).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 32_000_000  # decoded rows that the driver can take for a broadcast


def build_session(master: str | None = None, app: str = "docketline",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, use the cluster's own
    session and only make sure the settings below are present."""
    cpus = os.cpu_count() or 8
    builder = (
        SparkSession.builder
        .master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must name shared storage; it is only read here,
    and an unset one is an error, as a folder of the driver's machine would not
    be seen by the executors. Only where everything runs in one process
    (``local``, tests), a fresh folder under /tmp is set and removed at exit.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="docketline-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows of a small scan out to all cores, by ``keys``.

    A Parquet row group is read by one task, so a table with fewer full-size
    splits than there are cores leaves cores idle in the text work that follows.
    Larger scans are returned as they are: no exchange is added at scale.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df if size >= cores * split else df.repartition(cores, *keys)


def by_decoded_size(df: DataFrame) -> DataFrame:
    """Have Spark sort, not broadcast, a side of a join whose rows are large.

    Spark goes by the size of the Parquet files below, in which a column that
    repeats takes next to no room, but the driver gets the rows decoded. Their size
    is summed here, in a job over the columns of ``df``, which should be narrow. Up
    to ``BROADCAST_BYTES`` or Spark's own limit the choice is Spark's.
    """
    row = F.lit(16 + 16 * len(df.columns))
    for name, kind in df.dtypes:
        if kind == "string":
            row = row + F.coalesce(F.octet_length(name), F.lit(0))
    size = df.agg(F.sum(row)).first()[0] or 0
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df if size <= max(limit, BROADCAST_BYTES) else df.hint("merge")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that long texts don't fill a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have the file system drop ``path`` when the driver ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Used after expensive or non-repeatable steps (model scoring) so that a
    lost executor re-reads the written table instead of re-running them. The
    table lives as long as the driver.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    _delete_on_exit(spark, path)
    return spark.read.parquet(path)
