"""Submitted jobs, the first pending row, the empty work-list guard, all-string
sheets and the source snapshot of a run."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from docketline import sinks
from docketline.operators import inference, jobs
from docketline.plans.chronology import run_chronology
from docketline.sources import fixtures as fx
from docketline.sources import readers


def test_empty_work_list_is_an_error(spark):
    blank = spark.createDataFrame([(None,), ("  ",)], "ID string")
    for df in (blank, blank.limit(0)):
        with pytest.raises(jobs.EmptyWorkList):
            jobs.require_rows(df)
    assert [r.ID for r in jobs.require_rows(blank.union(spark.createDataFrame([(" 7 ",)], "ID string"))).collect()] == ["7"]


def test_header_only_file_is_an_empty_list(spark):
    d = tempfile.mkdtemp(prefix="wl-")
    with open(f"{d}/list.csv", "w") as f:
        f.write("ID\n")
    with pytest.raises(jobs.EmptyWorkList):
        jobs.require_rows(readers.read_worklist(spark, d))


def test_first_pending_equals_a_scan(spark):
    rng = random.Random(3)
    rows = [(f"l{rng.randrange(6)}", rng.randrange(40), rng.choice(["", None, " a", "b ", "c", "d", "e"])) for _ in range(200)]
    done = {"a", "c"}
    work = spark.createDataFrame(rows, "list_id string, line_no int, ID string")
    ledger = spark.createDataFrame([("a",), ("c",), ("c",), (None,)], "ID string")
    want = {}
    for name, line, id_ in sorted(((a, b, (c or "").strip()) for a, b, c in rows)):
        if id_ and id_ not in done:
            want.setdefault(name, (line, id_))
    got = {r.list_id: (r.line_no, r.ID) for r in jobs.first_pending(work, ledger, "line_no", ["list_id"]).collect()}
    assert got == want
    assert jobs.first_pending(work.limit(0), ledger, "line_no", ["list_id"]).count() == 0
    assert jobs.first_pending(work, None, "line_no", ["list_id"]).count() == len({a for a, _, c in rows if (c or "").strip()})


def test_submissions_keep_history_and_a_run_replaces_its_own(spark):
    path = tempfile.mkdtemp(prefix="sub-")
    ids = spark.createDataFrame([("007",), (" b ",), ("",), (None,)], "ID string")
    assert jobs.submit(ids, path, "r1", "2025-01-01 00:00:00").count() == 2
    both = jobs.submit(ids.limit(1), path, "r2", "2025-01-03 00:00:00")
    assert sorted((r.ID, r.run_id) for r in both.collect()) == [("007", "r1"), ("007", "r2"), ("b", "r1")]
    again = jobs.submit(ids.limit(1), path, "r2", "2025-01-03 00:00:00")
    assert again.count() == 3
    ended = spark.createDataFrame([("007", "2025-01-02 00:00:00"), ("x", None)], "ID string, t string")
    ended = ended.select("ID", F.col("t").cast("timestamp").alias("finished_at"))
    got = {r.ID: (r.submissions, r.status) for r in jobs.job_status(again, ended).collect()}
    assert got == {"007": (2, "again"), "b": (1, "pending")}
    later = ended.withColumn("finished_at", F.lit("2025-01-03 00:00:00").cast("timestamp"))
    assert {r.ID: r.status for r in jobs.job_status(again, later).collect()} == {"007": "done", "b": "pending"}
    with pytest.raises(ValueError):
        jobs.submit(ids, path, "a/b", "2025-01-01 00:00:00")


def test_a_missing_end_time_is_before_all(spark):
    asked = spark.createDataFrame([("a", "2025-01-01"), ("b", None)], "ID string, t string").select("ID", F.col("t").cast("timestamp").alias("submitted_at"))
    ended = spark.createDataFrame([("a", None), ("b", None)], "ID string, t string").select("ID", F.col("t").cast("timestamp").alias("finished_at"))
    assert {r.ID: r.status for r in jobs.job_status(asked, ended).collect()} == {"a": "again", "b": "done"}


def test_all_string_sheet(spark):
    df = spark.createDataFrame([("007", 1, True, ""), (None, None, False, "N/A")], "a string, b int, c boolean, d string")
    got = readers.as_strings(df)
    assert {t for _, t in got.dtypes} == {"string"}
    assert [tuple(r) for r in got.collect()] == [("007", "1", "True", None), (None, None, "False", "N/A")]


def test_snapshot_is_the_source_as_it_was(spark):
    path = tempfile.mkdtemp(prefix="snap-")
    entries = readers.parse_entries(fx.entry_json(spark, SF001))
    args = (entries, fx.items(spark, SF001), fx.prompts(spark, SF001))
    run = run_chronology(*args, scorer=inference.native_scorer(), run_id="r1", snapshot=path)
    plain = run_chronology(*args, scorer=inference.native_scorer(), run_id="r1")
    key = lambda df: sorted((r.court_book_id, r.payload) for r in df.select("court_book_id", "payload").collect())
    assert key(run.payload) == key(plain.payload)
    sinks.snapshot(entries.limit(3), path, "r2")
    kept = sinks.read_snapshot(spark, path, "r1", entries.schema)
    text = ["court_book_id", "line_id", "entry_final_html"]
    assert sorted(map(tuple, kept.select(*text).collect()), key=str) == sorted(map(tuple, entries.select(*text).collect()), key=str)
    assert sinks.read_snapshot(spark, path, "r2", entries.schema).count() == 3
