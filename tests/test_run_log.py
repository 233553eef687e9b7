"""Run events: counts equal a recount, without a second pass; failures are kept."""

import os
import tempfile
import time

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from docketline.run_log import QueryEvents, RunLog, read_events
from docketline.sources import fixtures as fx


def test_counts_equal_a_recount_in_one_pass(spark):
    d = tempfile.mkdtemp(prefix="ev-")
    docs = fx.table(spark, SF001, "documents")
    passes = spark.sparkContext.accumulator(0)

    def once(batches):
        for b in batches:
            passes.add(b.num_rows)
            yield b

    log = RunLog(spark, os.path.join(d, "events"), "run-1")
    assert read_events(spark, log.path).count() == 0
    rows = docs.select("doc_id", "lang", "n_chars").mapInArrow(once, "doc_id long, lang string, n_chars long")
    log.stage("extract", rows, lambda df: df.write.parquet(os.path.join(d, "out")),
              {"english": F.col("lang") == "en", "long": F.col("n_chars") > 2000, "none": F.lit(None).cast("boolean")})
    end = read_events(spark, log.path).where("event = 'end'").first()
    back = spark.read.parquet(os.path.join(d, "out"))
    assert end.metrics == {"rows": back.count(), "english": back.where("lang = 'en'").count(), "long": back.where("n_chars > 2000").count(), "none": 0}
    assert passes.value == end.metrics["rows"] == docs.count()
    with pytest.raises(Exception):
        log.stage("bad", docs.select(F.raise_error(F.lit("no")).alias("x")), lambda df: df.write.parquet(os.path.join(d, "bad")))
    got = [(r.seq, r.stage, r.event, r.run_id) for r in read_events(spark, log.path).orderBy("seq").collect()]
    assert got == [(0, "extract", "start", "run-1"), (1, "extract", "end", "run-1"), (2, "bad", "start", "run-1"), (3, "bad", "error", "run-1")]


def test_streaming_batches_are_events(spark):
    d = tempfile.mkdtemp(prefix="ev-")
    log = RunLog(spark, os.path.join(d, "events"), "run-2")
    listener = QueryEvents(log)
    spark.streams.addListener(listener)
    try:
        spark.range(70).write.parquet(os.path.join(d, "in"))
        read = spark.readStream.schema("id long").parquet(os.path.join(d, "in"))
        q = (read.observe("seen", F.count(F.when(F.col("id") < 30, 1)).alias("small")).writeStream.queryName("work").format("noop")
             .option("checkpointLocation", os.path.join(d, "ck")).trigger(availableNow=True).start())
        assert q.awaitTermination(60)
        end = time.time() + 30
        while time.time() < end and read_events(spark, log.path).where("event = 'end'").isEmpty():
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    batch = read_events(spark, log.path).where("event = 'batch'").collect()
    assert [(b.stage, b.metrics["input_rows"], b.metrics["small"]) for b in batch] == [("work", 70, 30)]
