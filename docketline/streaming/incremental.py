"""Incremental runs with Structured Streaming.

* ``worklist_stream`` — the watcher's trigger: a file source over the
  work-list folder, polled every ``poll`` (default 60 s), each new file is a
  micro-batch.
* ``run_incremental`` — for each micro-batch: drop ids that already have
  finished output (stream–static ``left_anti`` against the ledger table),
  run the given batch job on the rest, then append the processed ids to the
  ledger in the same batch. Micro-batches run one after another, so runs
  never overlap, and a restarted query resumes from its checkpoint.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docketline.functions.text import py_strip
from docketline.session import ensure_checkpoint_dir

POLL = "60 seconds"


def worklist_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New work-list CSV files (header line, id in column 0) as a stream."""
    df = (spark.readStream.option("header", True).schema("ID string").csv(folder)
          .withColumn("ID", py_strip(F.col("ID"))))
    return df.where(F.col("ID").isNotNull() & (F.col("ID") != ""))


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path).select("ID")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "ID string")  # no ledger yet: nothing finished


def run_incremental(todo: DataFrame, ledger_path: str,
                    job: Callable[[DataFrame, int], None], *, poll: str = POLL,
                    checkpoint: str | None = None, once: bool = False) -> StreamingQuery:
    """Start the incremental runner; ``job(ids, batch_id)`` does the work."""
    spark = todo.sparkSession
    checkpoint = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "incremental")

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.join(_ledger(spark, ledger_path), "ID", "left_anti")
        ids = fresh.select("ID").distinct()
        if ids.isEmpty():
            return
        job(ids, batch_id)
        ids.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(ledger_path)

    writer = todo.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=poll)
    return writer.start()
