"""File readers on small landed files (scratch folders under /tmp)."""

import json
import os
import tempfile

from docketline.sources import readers


def _write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_worklist_csv(spark):
    d = tempfile.mkdtemp(prefix="wl-")
    _write(d, "list.csv", "whatever\n 101 \n\n102\n101\n   \n")
    ids = [r.ID for r in readers.read_worklist(spark, d).orderBy("line_no").collect()]
    assert ids == ["101", "102", "101"]


def test_prompts_csv_keeps_text(spark):
    d = tempfile.mkdtemp(prefix="pr-")
    _write(d, "p.csv", 'prompt_id,prompt_text\n3, Say "hi"\\n now\n1, x\n')
    rows = {r.prompt_id: r.prompt_text for r in readers.read_prompts(spark, d).collect()}
    assert rows == {3: ' Say "hi"\\n now', 1: " x"}


def test_entry_arrays_and_lines(spark):
    d = tempfile.mkdtemp(prefix="ea-")
    book = [{"id": 7, "courtBookId": "B", "handwritten": "false", "relevant": "Relevant",
             "entryDate": 1700000000000, "entryOriginal": "<p>a b</p>", "entryFinal": "<p>X</p>",
             "extra": {"k": [1, None]}},
            {"id": "8", "courtBookId": "B"}]
    _write(d, "B.json", json.dumps(book))
    arr = readers.read_entry_arrays(spark, d).orderBy("pos").collect()
    assert [(r.pos, r.line_id, r.court_book_id) for r in arr] == [(0, "7", "B"), (1, "8", "B")]
    assert arr[0].entry_date_ms == 1700000000000 and arr[1].entry_date_ms == 0
    d2 = tempfile.mkdtemp(prefix="el-")
    _write(d2, "B.jsonl", "\n".join(json.dumps(o) for o in book) + "\nnot json\n")
    lines = readers.read_entry_lines(spark, d2).collect()
    assert sorted(r.line_id for r in lines) == ["7", "8"]


def test_line_numbers_do_not_depend_on_splits(spark):
    """Ids of entries in JSON lines are the same for every split size."""
    from docketline.functions import text as T
    d = tempfile.mkdtemp(prefix="ln-")
    for name in "AB":
        _write(d, name + ".jsonl", "\n".join("" if i % 7 == 3 else json.dumps({"id": i, "courtBookId": name, "t": "é" * (i % 40)}) for i in range(120)))
    got = []
    for split in ("100", "700", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            e = readers.read_entry_lines(spark, d)
            got.append(sorted(e.select("court_book_id", "line_id", "pos", T.entry_uid("court_book_id", "line_id", "pos").alias("u")).collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got[0] == got[1] == got[2] and len(got[0]) == 2 * 103
    assert all(int(r.line_id) == r.pos for r in got[0])


def test_items_keep_only_complete(spark):
    d = tempfile.mkdtemp(prefix="it-")
    _write(d, "items.json", json.dumps([{"id": 1, "description": "a"}, {"id": 2},
                                        {"description": "c"}, {"id": 3, "description": None}]))
    rows = sorted((r.id, r.description) for r in readers.read_items(spark, d).collect())
    assert rows == [("1", "a"), ("3", None)]


def test_log_parse(spark):
    d = tempfile.mkdtemp(prefix="lg-")
    _write(d, "w.log", "[2025-04-17 15:13:06] Change detected. Launching script.\nbroken line\n")
    rows = readers.parse_log(readers.read_log(spark, d)).orderBy("line_no").collect()
    assert str(rows[0].ts) == "2025-04-17 15:13:06" and rows[0].message.startswith("Change")
    assert rows[1].ts is None


def test_chunks_files(spark):
    d = tempfile.mkdtemp(prefix="ch-")
    _write(d, "req1.txt", 'data: {"content":"a"}\r\ndata: [DONE]\ndata: {"content":" b"}\n')
    from docketline.operators.inference import sse_fold
    out = {r.request_id: r.response for r in sse_fold(readers.read_chunks(spark, d)).collect()}
    assert out == {"req1": "a b"}


def test_arrays_lose_nothing(spark):
    """Elements, quarantined rows and their sum; the book is the file's name."""
    d = tempfile.mkdtemp(prefix="ar-")
    _write(d, "77.json", json.dumps([{"id": i, "entryOriginal": "x" * 1000} for i in range(50)]))
    _write(d, "bad.json", '[{"id": 1}, 5, {"id": 2, "id": 3}, {"id": ')
    _write(d, "none.json", "oops")
    _write(d, "empty.json", " [ ] ")
    raw = readers.array_rows(spark, d)
    good, bad = readers.parse_entries(raw), readers.quarantine(raw)
    assert good.count() + bad.count() == raw.count() == 55
    rows = {(r.court_book_id, r.pos): r for r in good.collect()}
    assert {k[0] for k in rows} == {"77", "bad"} and rows[("bad", 2)].line_id == "3"  # the last of a repeated key
    assert sorted((r.court_book_id, r.pos, bool(r.reason)) for r in bad.collect()) == [("bad", 1, True), ("bad", 3, True), ("none", 0, True)]


def test_large_array_file(spark):
    d = tempfile.mkdtemp(prefix="big-")
    _write(d, "B.json", "[" + ",".join(json.dumps({"id": i, "entryOriginal": "y" * 100_000}) for i in range(1400)) + "]")
    assert readers.read_entry_arrays(spark, d).count() == 1400


def test_dates_out_of_range_are_invalid(spark):
    rows = [(i, json.dumps({"id": i, "entryDate": v})) for i, v in enumerate([10**18, -10**18, 10**30, None, "x", 1.5e12, 0, 253402300799999, 253402300800000])]
    got = readers.parse_entries(spark.createDataFrame(rows, "pos long, raw string")).orderBy("pos").collect()
    assert [r.entry_date_valid for r in got] == [False, False, False, False, False, True, True, True, False]


def test_job_over_raw_rows(spark):
    """Quarantine, the book from the request, answers of earlier runs, errors a
    row, and untouched entries."""
    from docketline.operators import inference
    from docketline.plans.chronology import run_chronology
    texts = ["first text.", "second text.", "third text.", "fourth text."]
    objects = [{"id": i, "handwritten": "false", "relevant": "Relevant", "entryOriginal": f"<p>{t}</p>"} for i, t in enumerate(texts)]
    objects.append({"id": 9, "k": "v"})
    raw = spark.createDataFrame([("77", i, json.dumps(o)) for i, o in enumerate(objects)] + [("77", 8, "{broken")], "court_book_id string, pos long, raw string")
    items = spark.createDataFrame([], "id string, description string, load_order long")
    prompts = spark.createDataFrame([(1, "P")], "prompt_id int, prompt_text string")

    def call(client, frame):
        if any("second" in t for t in frame["text"]):
            raise ValueError("no")
        return ["* seen " + t for t in frame["text"]]

    cached = spark.createDataFrame([("first text.", "* cached"), ("third text.", "Error: timeout")], "t string, raw_response string")
    from pyspark.sql import functions as F
    cached = cached.select(inference.request_hash(F.col("t"), F.lit("P")).alias("request_hash"), "raw_response")
    run = run_chronology(raw, items, prompts, scorer=inference.pandas_scorer(call), answered=cached)
    got = {r.line_id: (r.response, r.status) for r in run.parts.collect()}
    assert got["0"] == ("AI Summary\n* cached", "summary") and got["1"] == ("Error: Exception occurred", "error")
    assert got["2"][0] == "AI Summary\n* seen third text." and got["3"][0] == "AI Summary\n* seen fourth text."
    payload = {r.line_id: json.loads(r.payload) for r in run.payload.collect()}
    assert payload["9"] == objects[4] and "cached" in payload["0"]["entryFinal"]
    assert [(r.pos, r.reason) for r in run.quarantine.collect()] == [(8, "not a JSON object")]
    responses = spark.createDataFrame([("a", "* x"), ("b", "Error: y"), ("c", None), ("a", "* x")], "request_hash string, raw_response string")
    assert [r.request_hash for r in inference.cacheable(responses).collect()] == ["a"]
    assert sorted(r.request_hash for r in inference.retry_table(responses).collect()) == ["b", "c"]


def test_previous_value_with_more_columns(spark):
    from conftest import SF01
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from docketline.operators.ordered import previous_non_null
    ev = spark.read.parquet(f"{SF01}/events.parquet").withColumn("v", F.when(F.col("event_id") % 3 > 0, F.col("user_id")))
    got = previous_non_null(ev, "event_type", ["ts", "event_id"], "v", "prev", n_blocks=13)
    w = Window.partitionBy("event_type").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    want = ev.withColumn("prev", F.last("v", ignorenulls=True).over(w))
    assert got.select("event_id", "prev").exceptAll(want.select("event_id", "prev")).count() == 0 and got.count() == ev.count()


def test_writers_round_trip(spark):
    from docketline import sinks
    d = tempfile.mkdtemp(prefix="sk-")
    rows = spark.createDataFrame([(b, i, f"t{i}\nx,\"y\"") for b in ("007", "b c") for i in range(120)], "court_book_id string, first_index long, payload string")
    sinks.write_sheet(rows, f"{d}/sheet")
    back = spark.read.schema(rows.schema).parquet(f"{d}/sheet").select(*rows.columns)
    assert sorted(back.collect()) == sorted(rows.collect())
    sinks.write_payload(rows, f"{d}/payload")
    assert len(os.listdir(f"{d}/payload")) >= 2
    delta = rows.selectExpr("court_book_id", "'r1' as run_id", "payload")
    for _ in range(2):
        sinks.write_delta(delta, f"{d}/delta")
    assert spark.read.parquet(f"{d}/delta").count() == 240
    sinks.archive(rows, f"{d}/archive", "r1")
    assert spark.read.parquet(f"{d}/archive").where("run_id = 'r1'").count() == 240
    parts = rows.withColumnsRenamed({"first_index": "index"}).selectExpr("*", "index div 50 + 1 as batch_no")
    sinks.write_parts(parts, f"{d}/parts")
    back = sinks.read_parts(spark, f"{d}/parts", parts.schema)
    assert back.count() == 240 and {r[0] for r in back.select("court_book_id").distinct().collect()} == {"007", "b c"}


def test_checkpoint_folder_is_asked_for_on_a_cluster():
    import pytest

    from docketline.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
