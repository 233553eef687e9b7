"""Streaming forms equal their batch forms."""

import os
import tempfile
import time

import pytest
from conftest import SF01
from pyspark.sql import functions as F

from docketline.sources import fixtures as fx
from docketline.streaming.incremental import run_incremental, worklist_stream
from docketline.streaming.watch import change_stream, changes


def test_change_stream_equals_batch(spark):
    watch = fx.watch(spark, SF01)
    batch = {(r.path, r.event_id) for r in changes(watch).collect()}
    src = tempfile.mkdtemp(prefix="watch-src-")
    # land the snapshots as 4 files, one after another in version order, so
    # the stream sees several micro-batches in the order they happened
    ranged = watch.repartitionByRange(4, "ts", "event_id").withColumn("_part", F.spark_partition_id())
    ranged = ranged.cache()
    for i in range(4):
        ranged.where(F.col("_part") == i).drop("_part").coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = spark.readStream.schema(watch.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (change_stream(stream).writeStream.format("memory").queryName("fired_test")
         .outputMode("append").option("checkpointLocation", tempfile.mkdtemp(prefix="ck-")).start())
    q.processAllAvailable()
    q.stop()
    streamed = {(r.path, r.event_id) for r in spark.sql("SELECT * FROM fired_test").collect()}
    assert len(batch) == 7866
    assert streamed == batch


def test_incremental_skips_finished(spark):
    root = tempfile.mkdtemp(prefix="incr-")
    inbox, ledger = os.path.join(root, "in"), os.path.join(root, "ledger")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "a.csv"), "w") as f:
        f.write("ID\n 11 \n\n12\n")
    seen = []

    def job(ids, batch_id):
        seen.append(sorted(r.ID for r in ids.collect()))

    q = run_incremental(worklist_stream(spark, inbox), ledger, job, once=True,
                        checkpoint=os.path.join(root, "ck"))
    q.awaitTermination()
    with open(os.path.join(inbox, "b.csv"), "w") as f:
        f.write("ID\n12\n13\n")
    q = run_incremental(worklist_stream(spark, inbox), ledger, job, once=True,
                        checkpoint=os.path.join(root, "ck"))
    q.awaitTermination()
    assert seen == [["11", "12"], ["13"]]
    assert sorted(r.ID for r in spark.read.parquet(ledger).collect()) == ["11", "12", "13"]


@pytest.fixture
def rocksdb(spark):
    from docketline.streaming.late_watch import STATE_STORE
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    yield
    for k in STATE_STORE:
        spark.conf.unset(k)


def test_sse_stream_equals_batch(spark, rocksdb):
    from pyspark.sql import Window

    from docketline.operators.inference import sse_fold
    from docketline.streaming.responses import sse_fold_stream
    chunks = fx.chunks(spark, SF01)
    batch = {r.request_id: r.response for r in sse_fold(chunks).collect()}
    last = F.max("chunk_no").over(Window.partitionBy("request_id"))
    landed = chunks.withColumn("done", F.col("chunk_no") == last)
    src = tempfile.mkdtemp(prefix="sse-src-")
    ranged = landed.repartitionByRange(3, "chunk_no").withColumn("_p", F.spark_partition_id()).cache()
    for i in range(3):   # early chunks first, the done chunks come in later files
        ranged.where(F.col("_p") == i).drop("_p").coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (sse_fold_stream(stream).writeStream.format("memory").queryName("sse_test")
         .outputMode("append").option("checkpointLocation", tempfile.mkdtemp(prefix="ck-")).start())
    # With a processing-time timeout Spark runs a no-data batch after every
    # batch (to fire timeouts), so processAllAvailable() would never return:
    # wait for every request to be emitted, with a deadline instead.
    deadline = time.time() + 180
    try:
        while time.time() < deadline:
            assert q.exception() is None, q.exception()
            if spark.sql("SELECT count(*) FROM sse_test").first()[0] >= len(batch):
                break
            time.sleep(1)
    finally:
        q.stop()
    streamed = {r.request_id: r.response for r in spark.sql("SELECT * FROM sse_test").collect()}
    assert streamed == batch


def test_sse_gaps_order_and_marks(spark, rocksdb):
    """Chunks in any order; a gap or a cut stream is an error; late chunks are
    ignored until the mark expires, and state goes."""
    import json

    from docketline.streaming.responses import BROKEN_STREAM, sse_fold_stream
    src, ck = tempfile.mkdtemp(prefix="sse-src-"), tempfile.mkdtemp(prefix="ck-")
    schema = "request_id string, chunk_no bigint, line string, done boolean"
    got, files = [], []

    def land(*rows):
        rows = [(r, n, None if t is None else "data: " + json.dumps({"content": t}), d) for r, n, t, d in rows]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        files.append(len(rows))

    def wait(n, seconds=60):
        end = time.time() + seconds
        while time.time() < end and len(got) < n:
            assert q.exception() is None, q.exception()
            time.sleep(0.3)
        return sorted(got)

    land(("a", 2, "c", True), ("a", 0, " x", False), ("gap", 0, "g", False), ("gap", 3, "g", True), ("cut", 0, "part", False), ("none", 0, None, True))
    read = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (sse_fold_stream(read, timeout_ms=9_000, mark_ms=12_000).writeStream.foreachBatch(lambda df, i: got.extend(map(tuple, df.collect())))
         .option("checkpointLocation", ck).trigger(processingTime="1 second").start())
    try:
        from docketline.functions import text as T
        assert wait(1) == [("none", T.NO_CONTENT_RESPONSE)]
        land(("a", 1, "b", False), ("a", 1, "b", False))  # the gap closes; repeated
        assert ("a", "xbc") in wait(2)
        land(("a", 1, "late", True), ("none", 0, "late", True))  # ignored
        assert wait(4) == [("a", "xbc"), ("cut", BROKEN_STREAM), ("gap", "Error: Missing chunk 1"), ("none", T.NO_CONTENT_RESPONSE)]
        time.sleep(13)  # marks are gone: the id can be used again
        land(("a", 0, "new", True))
        assert ("a", "new") in wait(5)
        assert len(got) == 5
    finally:
        q.stop()
