"""Writers for the pipeline's outputs.

Every output is one table partitioned by book (and run or batch where that
is the unit of re-execution); overwrite is dynamic per partition, so a
retried run replaces only its own partitions.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketline.operators.extract import display_names


# Consecutive sheet rows that one task writes: a book is spread over many.
SHEET_BLOCK = 1 << 16


def _writer(df: DataFrame, *parts: str):
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)


def write_courtbook_rows(rows: DataFrame, path: str, csv: bool = False) -> None:
    """Step 1 output, one folder per book (CSV with the sheet's column names
    when ``csv``; Parquet otherwise)."""
    if csv:
        out = display_names(rows).withColumn("court_book_id", F.col("Court Book ID"))
        _writer(out, "court_book_id").option("header", True).csv(path)
    else:
        _writer(rows, "court_book_id").parquet(path)


def write_parts(parts: DataFrame, path: str) -> None:
    """Step 2 output: one folder per book, the 50-row batch a column (Parquet:
    texts with line breaks and ids keep their values, unlike a CSV round trip)."""
    _writer(parts, "court_book_id").parquet(path)


def read_parts(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read part folders back with an explicit schema (partition values keep
    their types: a book id such as '007' stays a string). The book comes
    from the folder names; the file name is kept for lineage, and order
    comes from ``index``, never from how file names sort."""
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    return df.withColumn("file_name", F.col("_metadata.file_name"))


def write_sheet(sheet: DataFrame, path: str) -> None:
    """Step 3 output, one folder per book; rows are in order within each file."""
    block = F.floor(F.col("first_index") / F.lit(SHEET_BLOCK))
    ordered = sheet.repartition("court_book_id", block).sortWithinPartitions("court_book_id", "first_index")
    _writer(ordered, "court_book_id").parquet(path)


def write_payload(payload: DataFrame, path: str) -> None:
    """Payload JSON text, one object per line, one folder per book. (A JSON
    array per book would put a whole book into one row, so it is not built.)"""
    _writer(payload.select("court_book_id", F.col("payload").alias("value")), "court_book_id").text(path)


def write_delta(delta: DataFrame, path: str) -> None:
    """Write-back rows keyed (book, line id, run id); re-running a run
    replaces its own partition only."""
    _writer(delta, "run_id", "court_book_id").parquet(path)


def bucketed(df: DataFrame, keys: list[str], path: str, name: str, buckets: int | None = None) -> DataFrame:
    """Write a table in buckets of its keys and read it back. Joins and groupings
    on the keys then exchange the other side only, which is what a ledger far
    larger than a work list needs. ``buckets`` defaults to the session's shuffle
    partitions; fewer would have Spark exchange this side again."""
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, *keys).sortBy(*keys).mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def snapshot(df: DataFrame, path: str, run_id: str) -> DataFrame:
    """Keep the source rows of a run as they were before anything was merged into
    them, one folder a run, and read them back; the same run again replaces its own.
    Ids and books are data, not folder names, so '007', '' and null stay as they are."""
    if not run_id or "/" in run_id:
        raise ValueError(f"run id {run_id!r} can't name a folder")
    df.write.mode("overwrite").parquet(os.path.join(path, f"snapshot={run_id}"))
    return read_snapshot(df.sparkSession, path, run_id, df.schema)


def read_snapshot(spark: SparkSession, path: str, run_id: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(os.path.join(path, f"snapshot={run_id}"))


def archive(df: DataFrame, path: str, run_id: str) -> None:
    """Keep a run's outputs under (run_id, book) instead of zip files."""
    _writer(df.withColumn("run_id", F.lit(run_id)), "run_id", "court_book_id").parquet(path)
