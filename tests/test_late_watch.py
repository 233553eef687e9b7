"""Snapshots in any order within the bound give the batch result."""

import os
import tempfile

import numpy as np
import pandas as pd
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from docketline.sources import fixtures as fx
from docketline.streaming.late_watch import STATE_STORE, late_change_stream, net_changes
from docketline.streaming.watch import changes

DAY = 86_400


def stream(spark, rows, batches, name, delay, ck=None, src=None):
    """Land ``rows`` (pandas, in arrival order) as files and run them through, a
    file a batch; returns the emitted rows."""
    src = src or tempfile.mkdtemp(prefix="lw-src-")
    schema = "path string, ts timestamp, event_id bigint, md5 string"
    start = len(os.listdir(src))
    for i, part in enumerate(np.array_split(np.arange(len(rows)), batches)):
        out = rows.iloc[part].copy()
        out["ts"] = out["ts"].astype("datetime64[us]")
        out.to_parquet(os.path.join(src, f"{start + i:03d}.parquet"), index=False)
        os.utime(os.path.join(src, f"{start + i:03d}.parquet"), (1_000_000 + start + i,) * 2)
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        read = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        got = []
        q = (late_change_stream(read, delay).writeStream.foreachBatch(lambda df, i: got.extend(df.collect()))
             .outputMode("append").option("checkpointLocation", ck or tempfile.mkdtemp(prefix="lw-ck-")).trigger(availableNow=True).start())
        assert q.awaitTermination(150)
        return got
    finally:
        for k in STATE_STORE:
            spark.conf.unset(k)


def net(spark, got):
    df = spark.createDataFrame([tuple(r) for r in got], "path string, ts timestamp, event_id bigint, md5 string, change int")
    return {(r.path, r.event_id) for r in net_changes(df).collect()}


@pytest.mark.parametrize("seed", [0, 1])
def test_any_arrival_order_within_the_bound(spark, seed):
    watch = fx.watch(spark, SF001).withColumn("md5", F.when(F.col("event_id") % 9 != 0, F.col("md5")))
    batch = {(r.path, r.event_id) for r in changes(watch).collect()}
    rows = watch.toPandas()
    rng = np.random.default_rng(seed)
    late = pd.to_timedelta(rng.uniform(0, 3 * DAY, len(rows)), unit="s")
    rows = rows.iloc[np.argsort((rows["ts"] + late).to_numpy())].reset_index(drop=True)
    got = stream(spark, rows, 6, f"late{seed}", "73 hours")
    assert net(spark, got) == batch and len(batch) > 500
    assert any(r.change < 0 for r in got)  # something was taken back


def test_corrections_restart_and_repeats(spark):
    t = pd.Timestamp("2024-01-01")

    def row(minute, md5, path="p"):
        return (path, t + pd.Timedelta(minutes=minute), minute, md5)

    cols = ["path", "ts", "event_id", "md5"]
    src, ck = tempfile.mkdtemp(prefix="lw-src-"), tempfile.mkdtemp(prefix="lw-ck-")
    said = []

    def send(*rows):
        got = stream(spark, pd.DataFrame(list(rows), columns=cols), 1, "fix", "1 hour", ck, src)
        said.extend(got)
        return sorted((r.path, r.event_id, r.change) for r in got)

    assert send(row(10, "A"), row(30, "B")) == [("p", 30, 1)]  # a restart lies between any two calls
    assert send(row(20, "B")) == [("p", 20, 1), ("p", 30, -1)]  # the late one fires, its successor no longer
    assert send(row(20, "B"), row(25, None)) == []  # repeated, and a missing file
    assert send(row(5, "B")) == [("p", 10, 1)]  # before the baseline
    assert send(row(300, "C"), row(300, "x", "q")) == [("p", 300, 1)]
    assert send(row(310, "B"), row(301, "x", "q")) == [("p", 310, 1)]  # what the watermark passed is folded, and still known
    assert net(spark, said) == {("p", 10), ("p", 20), ("p", 300), ("p", 310)}
