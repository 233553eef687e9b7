"""Run events as a table: what a stage did, counted while it ran.

Each stage's rows pass an ``Observation``, so its counts come out of the job that
writes it, without a second pass. Events are rows (run_id, seq, stage, event, at,
detail, metrics) appended as Parquet: a run has a start and an end for each of its
few stages, so a folder holds a few rows a run. ``QueryEvents`` does the same for
streaming queries, a row a micro-batch that had input.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

EVENTS = "run_id string, seq long, stage string, event string, at timestamp, detail string, metrics map<string, bigint>"


class RunLog:
    """Events of one run, appended below ``path`` (shared storage)."""

    def __init__(self, spark: SparkSession, path: str, run_id: str):
        self.spark, self.path, self.run_id, self._seq = spark, path, run_id, 0

    def event(self, stage: str, event: str, detail: str = "", metrics: dict[str, int] | None = None) -> None:
        at = dt.datetime.now(dt.timezone.utc)
        row = (self.run_id, self._seq, stage, event, at, detail, {k: int(v or 0) for k, v in (metrics or {}).items()})
        self.spark.createDataFrame([row], EVENTS).coalesce(1).write.mode("append").parquet(self.path)
        self._seq += 1

    def stage(self, name: str, df: DataFrame, write: Callable[[DataFrame], Any], counts: dict[str, Column] | None = None) -> Any:
        """Run ``write`` on ``df`` between a start and an end event; the end has the
        number of rows written and ``counts`` (conditions: rows for which each is
        true). A failure is an event too, and is raised."""
        seen = Observation()
        parts = [F.count(F.lit(1)).alias("rows")] + [F.count(F.when(c, 1)).alias(k) for k, c in (counts or {}).items()]
        self.event(name, "start")
        try:
            out = write(df.observe(seen, *parts))
            metrics = seen.get
        except Exception as e:
            self.event(name, "error", f"{type(e).__name__}: {e}"[:1000])
            raise
        self.event(name, "end", metrics=metrics)
        return out


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """All events, or an empty table where none were written."""
    try:
        return spark.read.schema(EVENTS).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], EVENTS)


class QueryEvents(StreamingQueryListener):
    """Starts, batches with input, and ends of streaming queries, as run events."""

    def __init__(self, log: RunLog):
        self.log, self._names = log, {}

    def onQueryStarted(self, event) -> None:
        self._names[event.id] = event.name or str(event.id)
        self.log.event(self._names[event.id], "start")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            observed = {k: v for row in p.observedMetrics.values() for k, v in row.asDict().items() if isinstance(v, int)}
            self.log.event(p.name or str(p.id), "batch", str(p.batchId), {"input_rows": p.numInputRows, **observed})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.log.event(self._names.get(event.id, str(event.id)), "error" if event.exception else "end", event.exception or "")
