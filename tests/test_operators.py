"""Operator semantics on small frames: routing, lookups, merge, recombine,
batching, ordered scans (FIXTURES.md §3 golden cases)."""

import json

from conftest import SF001
from pyspark.sql import functions as F

from docketline.operators import extract, inference, joins, payload, post
from docketline.operators.ordered import exclusive_running_sum, previous_non_null
from docketline.sources.readers import json_quarantine, parse_entries


def _entries(spark, objs):
    rows = [("b1", i, json.dumps(o)) for i, o in enumerate(objs)]
    return parse_entries(spark.createDataFrame(rows, "court_book_id string, pos long, raw string"))


def test_routing(spark):
    e = _entries(spark, [{"id": 1, "handwritten": " TRUE ", "relevant": ""},
                         {"id": 2, "handwritten": "false", "relevant": "Relevant "},
                         {"id": 3, "handwritten": "false", "relevant": "relevant"},
                         {"id": 4, "relevant": "Relevant"},
                         {"id": 5, "handwritten": True, "relevant": "x"}])
    out = {r.line_id: r.route for r in extract.route_entries(e).collect()}
    assert out == {"1": "bypass", "2": "summarise", "3": "drop", "4": "drop", "5": "bypass"}


def test_entry_dates_and_missing_keys(spark):
    e = _entries(spark, [{"id": "a"}, {"id": "b", "entryDate": None}, {"id": "c", "entryDate": "x"},
                         {"id": "d", "entryDate": 1700000000123}])
    out = {r.line_id: (r.entry_date_ms, r.entry_date_valid, r.book_item_id) for r in e.collect()}
    assert out == {"a": (0, True, "None"), "b": (None, False, "None"), "c": (None, False, "None"),
                   "d": (1700000000123, True, "None")}


def test_quarantine(spark):
    df = spark.createDataFrame([("{}",), ("[1]",), ("nope",), ("",)], "raw string")
    assert json_quarantine(df).count() == 3


def test_lookup_last_wins_and_null_kept(spark):
    items = spark.createDataFrame([("1", "a", 0), ("1", "b", 1), ("2", None, 0)],
                                  "id string, description string, load_order int")
    e = _entries(spark, [{"id": 1, "bookItemId": 1}, {"id": 2, "bookItemId": 2},
                         {"id": 3, "bookItemId": 9}])
    out = {r.line_id: r.book_item_description
           for r in extract.lookup_description(e, items).collect()}
    assert out == {"1": "b", "2": None, "3": "-"}


def test_prompt_default(spark):
    prompts = spark.createDataFrame([(1, "p1")], "prompt_id int, prompt_text string")
    rows = spark.createDataFrame([(1,), (9,), (None,)], "prompt_id int")
    out = sorted(r.prompt_text for r in inference.prompt_lookup(rows, prompts).collect())
    assert out == ["Default Prompt", "Default Prompt", "p1"]


def test_merge_back_even_empty(spark):
    e = spark.createDataFrame([("b", "1", "old1"), ("b", "2", "old2")],
                              "court_book_id string, line_id string, entry_final_html string")
    ext = spark.createDataFrame([("b", "1", "", 0)],
                                "court_book_id string, line_id string, response string, first_index long")
    out = {r.line_id: (r.entry_final_html, r.matched) for r in payload.merge_back(e, ext).collect()}
    assert out == {"1": ("", True), "2": ("old2", False)}


def test_recombine_order_and_text(spark):
    parts = spark.createDataFrame(
        [("b", "u", 10, "y"), ("b", "u", 2, None), ("b", "u", 1, "x"), ("b", "v", 5, None)],
        "court_book_id string, unique_id string, index long, response string")
    parts = parts.withColumn("line_id", F.lit("L"))
    out = {r.unique_id: r.response for r in
           post.recombine_parts(parts, firsts=("line_id",)).collect()}
    assert out == {"u": "\nx\ny", "v": "\n"}


def test_batches_of_50(spark):
    rows = spark.range(101).select(F.lit("b").alias("court_book_id"), F.col("id").alias("index"))
    rows = rows.withColumn("batch_no", (F.floor(F.col("index") / 50) + 1).cast("bigint"))
    m = {r.batch_no: r.n_rows for r in inference.batch_manifest(rows).collect()}
    assert m == {1: 50, 2: 50, 3: 1}


def test_running_sum_across_blocks(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("pos"),
                                  (F.col("id") % 3 + 1).alias("n"))
    got = exclusive_running_sum(df, "k", "pos", "n", "base", block_rows=64, materialize_as=None)
    got = {r.pos: r.base for r in got.collect()}
    acc, want = 0, {}
    for i in range(1000):
        want[i] = acc
        acc += i % 3 + 1
    assert got == want


def test_previous_non_null_hot_key(spark):
    vals = ["A", "B", None, "B", "A"]
    df = spark.createDataFrame([("p", i, v) for i, v in enumerate(vals)], "k string, v_ord int, h string")
    out = previous_non_null(df, "k", ["v_ord"], "h", "prev", "first", n_blocks=3).orderBy("v_ord").collect()
    assert [r.prev for r in out] == [None, "A", "B", "B", "B"]
    assert [r.first for r in out] == [True, False, False, False, False]


def test_change_detect_rule(spark):
    from docketline.streaming.watch import changes
    ts = "2024-01-01 00:00:0{}"
    seq = [("p", "A"), ("p", "B"), ("p", None), ("p", "B"), ("p", "A"), ("q", None), ("q", "A")]
    df = spark.createDataFrame([(k, ts.format(i), i, h) for i, (k, h) in enumerate(seq)],
                               "path string, ts string, event_id long, md5 string") \
        .withColumn("ts", F.to_timestamp("ts"))
    fired = sorted((r.path, r.event_id) for r in changes(df).collect())
    assert fired == [("p", 1), ("p", 4), ("q", 6)]


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert joins.missing_columns(df, {"a", "b"}) == {"b"}


def test_with_defaults_only_when_absent(spark):
    df = spark.createDataFrame([(None,)], "Handwritten string")
    out = joins.with_defaults(df, {"Handwritten": "false", "Book Item Description": "-"}).first()
    assert out["Handwritten"] is None and out["Book Item Description"] == "-"


def test_request_body_and_pandas_scorer(spark):
    reqs = spark.createDataFrame([("h1", "One. Two!", "p"), ("h2", "", "p")],
                                 "request_hash string, text string, prompt string")
    body = reqs.select(inference.request_body()).first()[0]
    assert json.loads(body) == {"text": "One. Two!", "prompt": "p"}
    native = {r.request_hash: r.raw_response for r in inference.native_scorer()(reqs).collect()}
    py = {r.request_hash: r.raw_response for r in
          inference.pandas_scorer(inference.pandas_sentence_bullets)(reqs).collect()}
    assert native == py == {"h1": "* One.\n* Two!", "h2": "* "}


def test_pandas_scorer_contains_errors(spark):
    def boom(client, frame):
        raise RuntimeError("down")
    reqs = spark.createDataFrame([("h1", "x", "p")], "request_hash string, text string, prompt string")
    out = inference.pandas_scorer(boom)(reqs).first()
    assert out.raw_response == "Error: Exception occurred"


def test_response_status_forms_agree(spark):
    """Status from the raw text (regex) equals status read off the
    extracted response (heading test), on every fixture response and on
    null, empty and error answers."""
    from pyspark.sql import functions as F

    from docketline.operators import inference
    from docketline.sources import fixtures as fx
    r = fx.responses(spark, SF001).select(F.col("response").alias("raw"))
    extra = spark.createDataFrame([(None,), ("",), ("Error: timeout",), ("* a",), ("no bullet",)],
                                  "raw string")
    r = r.unionByName(extra)
    for route in ("summarise", "bypass"):
        rt = F.lit(route)
        d = r.withColumn("resp", inference.final_response(F.col("raw")))
        bad = d.where(~inference.response_status(F.col("raw"), rt).eqNullSafe(
            inference.response_status(F.col("raw"), rt, F.col("resp"))))
        assert bad.count() == 0


def test_entry_texts_shared_pass_equals_per_column(spark):
    """entry_texts shares the raw-block pass of the original HTML with the
    final HTML when both are equal; the result must equal the plain rules
    applied to each column, for equal, different and NULL pairs."""
    from docketline.functions import text as T
    html = "<!-- c --><p>A <b>B</b></p><script>x='</p>'</script><p>tail &amp;lt;</p>"
    pairs = [(html, html), (html, "<p>OTHER</p>"), ("<p>x</p>", None), (None, html),
             (None, None), ("", ""), ("<p>  </p><p>UP</p>", "<p>  </p><p>UP</p>")]
    df = spark.createDataFrame(pairs, "entry_original_html string, entry_final_html string")
    got = extract.entry_texts(df).select(
        "entry_text", "entry_modified", "first_line", "entry_description").collect()
    want = df.select(
        T.html_to_text("entry_original_html").alias("entry_text"),
        T.html_to_text("entry_final_html").alias("entry_modified"),
        T.first_paragraph("entry_final_html").alias("first_line"),
        T.entry_description(T.first_paragraph("entry_final_html")).alias("entry_description"),
    ).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_running_sum_never_broadcasts_the_rows(spark):
    """Files of rows can be smaller than the decoded blocks; the rows, being more,
    still must not be sent to the driver."""
    df = spark.range(40_000).selectExpr("concat(repeat('k', 150), id % 400) AS k", "id div 400 AS pos", "1 AS n")
    out = exclusive_running_sum(df, "k", "pos", "n", "base", materialize_as="test-rows")
    rows = out.collect()
    assert len(rows) == 40_000 and all(r["base"] == r["pos"] for r in rows)
    assert "BuildLeft" not in out._jdf.queryExecution().executedPlan().toString()
