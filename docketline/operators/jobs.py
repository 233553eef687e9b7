"""Submitted jobs: the work list as a table that keeps its history.

A submission is a row (id, time). Submitting never overwrites what was asked for
before, so repeated requests stay visible; what is to be done now follows from
the submissions and the finished books.

Defined results: null and blank ids are no jobs; an id finished at the time of its
last submission or later is done; of rows with the same place in a list, the least
id comes first; a submission or an end without a time counts as before all others;
empty tables give empty frames.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.operators.joins import unprocessed
from docketline.sources.readers import worklist_ids


class EmptyWorkList(ValueError):
    """There is nothing to run."""


def require_rows(worklist: DataFrame) -> DataFrame:
    """The work list itself, or an error if no row has an id. Looks at one row."""
    rows = worklist_ids(worklist)
    if rows.isEmpty():
        raise EmptyWorkList("the work list has no ids")
    return rows


def first_pending(worklist: DataFrame, finished: DataFrame | None, order: str, by: list[str], id_col: str = "ID") -> DataFrame:
    """(by, order, id): the first row of each list whose id isn't finished; with
    no ledger the first row. A least row a list is kept before anything is
    exchanged, so long lists cost one row a task."""
    rows = worklist_ids(worklist, id_col)
    if finished is not None:
        rows = unprocessed(rows, finished, id_col)
    least = rows.groupBy(*by).agg(F.min(F.struct(F.col(order), F.col(id_col))).alias("first_row"))
    return least.select(*by, F.col("first_row")[order].alias(order), F.col("first_row")[id_col].alias(id_col))


def submit(ids: DataFrame, path: str, run_id: str, submitted_at: str) -> DataFrame:
    """Write a run's submissions next to earlier ones; the same run again replaces
    only its own. Returns all submissions (ID, submitted_at, run_id)."""
    if not run_id or "/" in run_id:
        raise ValueError(f"run id {run_id!r} can't name a folder")
    rows = worklist_ids(ids).select("ID", F.lit(submitted_at).cast("timestamp").alias("submitted_at"), F.lit(run_id).alias("run"))
    rows.write.mode("overwrite").parquet(os.path.join(path, f"submission={run_id}"))
    return submissions(ids.sparkSession, path)


def submissions(spark, path: str) -> DataFrame:
    """All submissions below ``path``."""
    rows = spark.read.schema("ID string, submitted_at timestamp, run string").parquet(path)
    return rows.select("ID", "submitted_at", F.col("run").alias("run_id"))


def job_status(submitted: DataFrame, finished: DataFrame) -> DataFrame:
    """(ID, submissions, last_submitted, status) of every submitted id.

    done: finished at its last submission or later; again: finished before that
    only; pending: never finished. ``finished`` has (ID, finished_at), any number
    of rows an id. Both sides are aggregated before the join, so an id with a third of
    the rows is one row a task.
    """
    asked = worklist_ids(submitted).groupBy("ID").agg(F.count(F.lit(1)).alias("submissions"), F.max("submitted_at").alias("last_submitted"))
    ended = (worklist_ids(finished).groupBy("ID").agg(F.max("finished_at").alias("ended"))
             .select(F.col("ID").alias("f_id"), "ended", F.lit(True).alias("known")))
    status = (F.when(F.col("known").isNull(), "pending")
              .when(F.col("last_submitted").isNull() | F.coalesce(F.col("ended") >= F.col("last_submitted"), F.lit(False)), "done")
              .otherwise("again"))
    return (asked.join(ended, F.col("ID") == F.col("f_id"), "left")
            .select("ID", "submissions", "last_submitted", status.alias("status")))
