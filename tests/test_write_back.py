"""Write-back: exactly the committed attempts of a published run are there."""

import os
import sys
import tempfile

import pytest
from pyspark import cloudpickle

from docketline.write_back import FolderClient, Staged, WriteBackWriter, write_back


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't import tests


class Breaks(FolderClient):
    """Loses a task between writing and committing, while a mark file is there."""

    def stage(self, run_id, attempt, batches):
        super().stage(run_id, attempt, batches)
        from pyspark import TaskContext
        mark = os.path.join(self.root, "break")
        if TaskContext.get().partitionId() == 2 and os.path.exists(mark):
            raise RuntimeError("task lost after it wrote")


def rows(spark, run, n=100, text="x"):
    return spark.createDataFrame([("B", str(i), run, f"{text}{i}") for i in range(n)], "court_book_id string, line_id string, run_id string, entry_final string").repartition(5)


def keys(client, spark):
    return sorted((r.run_id, int(r.line_id), r.entry_final) for r in client.published(spark).collect())


def test_a_lost_task_leaves_neither_double_nor_missing_keys(spark):
    client = Breaks(tempfile.mkdtemp(prefix="wb-"))
    assert keys(client, spark) == []
    open(os.path.join(client.root, "break"), "w").close()
    with pytest.raises(Exception, match="task lost after it wrote"):
        write_back(rows(spark, "r1"), client, "r1")
    assert len(os.listdir(os.path.join(client.root, "rows"))) >= 1  # the lost attempt's rows stay staged,
    assert keys(client, spark) == []  # and nothing of the run is there
    os.remove(os.path.join(client.root, "break"))
    write_back(rows(spark, "r1"), client, "r1")
    assert keys(client, spark) == [("r1", i, f"x{i}") for i in range(100)]


def test_runs_replace_their_own_rows_only(spark):
    client = FolderClient(tempfile.mkdtemp(prefix="wb-"))
    write_back(rows(spark, "r1", 10), client, "r1")
    write_back(rows(spark, "r2", 7), client, "r2")
    write_back(rows(spark, "r1", 4, "y"), client, "r1")
    assert keys(client, spark) == [("r1", i, f"y{i}") for i in range(4)] + [("r2", i, f"x{i}") for i in range(7)]
    write_back(rows(spark, "r2", 0), client, "r2")
    assert keys(client, spark) == [("r1", i, f"y{i}") for i in range(4)]


def test_only_named_attempts_are_published(spark):
    client = FolderClient(tempfile.mkdtemp(prefix="wb-"))
    batch = rows(spark, "r", 3).toArrow().to_batches()
    writer = WriteBackWriter(client, "r")
    first, twin, lost = writer.write(iter(batch)), writer.write(iter(batch)), writer.write(iter(batch))
    writer.commit([first, None, Staged("empty", 0)])
    assert [k[1] for k in keys(client, spark)] == [0, 1, 2]
    writer.abort([twin, None])
    left = {f.removesuffix(".parquet") for f in os.listdir(os.path.join(client.root, "rows"))}
    assert left == {first.attempt, lost.attempt} and [k[1] for k in keys(client, spark)] == [0, 1, 2]
