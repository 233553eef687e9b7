"""Write-back to the source system in one transaction a run.

A Spark data source whose tasks only *stage* rows with a client; what they staged
goes to the driver as commit messages, and one ``publish`` makes exactly the
attempts that Spark committed visible. A task that is lost between writing and
committing, a retried task or a speculative twin leaves staged rows that no publish
names. A failed job discards what its tasks reported. Publishing a run again
replaces that run's rows only.

``client`` is any object that pickles with ``stage(run_id, attempt, batches)``,
``publish(run_id, attempts)`` and ``discard(run_id, attempts)``. ``FolderClient``
keeps staged rows as Parquet files of a shared folder, and a run's list of files is
its publication; a client of a web application would stage into its own drafts.
"""

from __future__ import annotations

import base64
import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "write_back"
DELTA = "court_book_id string, line_id string, run_id string, entry_final string"


@dataclass
class Staged(WriterCommitMessage):
    attempt: str
    rows: int


class WriteBackWriter(DataSourceArrowWriter):
    def __init__(self, client: Any, run_id: str):
        self.client, self.run_id = client, run_id

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        attempt, rows = uuid.uuid4().hex, 0

        def counted() -> Iterator[pa.RecordBatch]:
            nonlocal rows
            for batch in iterator:
                rows += batch.num_rows
                if batch.num_rows:
                    yield batch
        self.client.stage(self.run_id, attempt, counted())
        return Staged(attempt, rows)

    def commit(self, messages: list[Staged | None]) -> None:
        self.client.publish(self.run_id, [m.attempt for m in messages if m is not None and m.rows])

    def abort(self, messages: list[Staged | None]) -> None:
        self.client.discard(self.run_id, [m.attempt for m in messages if m is not None])


class WriteBack(DataSource):
    """Options: ``client`` (pickled, base64) and ``run_id``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return DELTA

    def writer(self, schema, overwrite: bool) -> WriteBackWriter:
        return WriteBackWriter(cloudpickle.loads(base64.b64decode(self.options["client"])), self.options["run_id"])


def write_back(delta: DataFrame, client: Any, run_id: str) -> None:
    """Stage all rows of a run's delta, then publish them at once."""
    spark = delta.sparkSession
    spark.dataSource.register(WriteBack)
    shown = base64.b64encode(cloudpickle.dumps(client)).decode()
    delta.write.format(FORMAT).option("client", shown).option("run_id", run_id).mode("append").save()


class FolderClient:
    """Staged rows and publications as files below a folder that driver and
    executors share (a path, or a URI that Arrow's file systems know)."""

    def __init__(self, root: str):
        self.root = root if "://" in root else root.removeprefix("file:")

    def _fs(self):
        from pyarrow import fs
        return fs.FileSystem.from_uri(self.root) if "://" in self.root else (fs.LocalFileSystem(), os.path.abspath(self.root))

    def stage(self, run_id: str, attempt: str, batches: Iterator[pa.RecordBatch]) -> None:
        from pyarrow import parquet
        system, root = self._fs()
        writer = None
        for batch in batches:
            if writer is None:
                system.create_dir(f"{root}/rows", recursive=True)
                writer = parquet.ParquetWriter(f"{root}/rows/{attempt}.parquet", batch.schema, filesystem=system)
            writer.write_batch(batch)
        if writer is not None:
            writer.close()

    def publish(self, run_id: str, attempts: list[str]) -> None:
        system, root = self._fs()
        system.create_dir(f"{root}/runs", recursive=True)
        draft = f"{root}/runs/.{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as out:
            out.write(json.dumps({"run_id": run_id, "attempts": attempts}).encode())
        system.move(draft, f"{root}/runs/{run_id}.json")  # the run is there from here on

    def discard(self, run_id: str, attempts: list[str]) -> None:
        from pyarrow import fs
        system, root = self._fs()
        for a in attempts:
            if system.get_file_info(f"{root}/rows/{a}.parquet").type == fs.FileType.File:
                system.delete_file(f"{root}/rows/{a}.parquet")

    def published(self, spark: SparkSession) -> DataFrame:
        """The rows of all published runs."""
        from pyarrow import fs
        system, root = self._fs()
        runs = system.get_file_info(fs.FileSelector(f"{root}/runs", allow_not_found=True))
        files = []
        for info in runs:
            if info.base_name.endswith(".json"):
                with system.open_input_stream(info.path) as f:
                    files += [f"{self.root}/rows/{a}.parquet" for a in json.loads(f.read())["attempts"]]
        return spark.read.schema(DELTA).parquet(*files) if files else spark.createDataFrame([], DELTA)
