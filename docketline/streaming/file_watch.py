"""A streaming source for files that change in place.

Spark's file source looks for new names and never reads a known one again. The
reference trigger is one file whose content is replaced, so here the source's
offset is the content itself: a map from path to the hash of what is there (null
for a missing file). A micro-batch holds the paths whose entry differs between its
start and its end, as observations; ``watch.change_stream`` keeps the last hash of
each path as state and decides what fires: the first observation is a silent
baseline, a missing file neither fires nor resets.

The offset is in the query's checkpoint, so a restart replays nothing, and a change
made while the query was down fires once when it is back. A lost task repeats its
rows from the offsets alone, without looking at the files again. Content that
changes and changes back between two polls is not seen, as with any polling.

The driver hashes the files block by block; meant for a handful of control files. Paths with
a scheme go through Arrow's file systems (file, s3, gs, hdfs); one it doesn't know
is an error when the query starts.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from docketline.sources.readers import read_worklist
from docketline.streaming.watch import change_stream

FORMAT = "watched_files"
POLL = "60 seconds"
BLOCK = 1 << 20


def content_hash(path: str) -> str | None:
    """MD5 of a file's content, or None if there is no file."""
    digest = hashlib.md5(usedforsecurity=False)
    try:
        if "://" in path:
            from pyarrow import fs
            system, inner = fs.FileSystem.from_uri(path)
            file = system.open_input_stream(inner)
        else:
            file = open(path, "rb")
        with file:
            while block := file.read(BLOCK):
                digest.update(block)
    except FileNotFoundError:
        return None
    return digest.hexdigest()


class _Observation(InputPartition):
    def __init__(self, rows: list[tuple[str, str | None]]):
        super().__init__(None)
        self.rows = rows


class WatchReader(DataSourceStreamReader):
    def __init__(self, paths: list[str]):
        self.paths = sorted(set(paths))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {p: content_hash(p) for p in self.paths}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        rows = [(p, h) for p, h in sorted(end.items()) if p not in start or start[p] != h]
        return [_Observation(rows)] if rows else []

    def read(self, partition: _Observation) -> Iterator[tuple]:
        yield from partition.rows


class WatchedFiles(DataSource):
    """Options: ``paths``, a JSON list."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, md5 string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return WatchReader(json.loads(self.options["paths"]))


def observations(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, md5, ts, event_id) of every observed change of content, in the shape
    of ``fixtures.watch``; the time is the micro-batch's, which a replay keeps."""
    spark.dataSource.register(WatchedFiles)
    seen = spark.readStream.format(FORMAT).option("paths", json.dumps(paths)).load()
    return seen.select("path", "md5", F.current_timestamp().alias("ts"), F.lit(0).cast("bigint").alias("event_id"))


def run_on_change(spark: SparkSession, paths: list[str], job: Callable[[DataFrame, int], None], checkpoint: str,
                  poll: str = POLL, once: bool = False) -> StreamingQuery:
    """Call ``job(ids, batch_id)`` with the work list (all its ids) whenever the
    content of one of the files changes. Batches run one after another; a batch
    whose job failed is run again on restart."""
    def each_batch(fired: DataFrame, batch_id: int) -> None:
        changed = sorted(r["path"] for r in fired.select("path").distinct().collect())  # at most the watched paths
        if changed:
            ids = read_worklist(spark, changed[0])
            for path in changed[1:]:
                ids = ids.unionByName(read_worklist(spark, path))
            job(ids.select("ID"), batch_id)

    writer = change_stream(observations(spark, paths)).writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=poll)).start()
