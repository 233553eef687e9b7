"""Registered queries: one per operator of the inventory, each reading the
driver's tables (or views Spark derives from them) under ``sf_dir``.

Every query returns plain columns (strings, integers, booleans) with the same
names as its SQL oracle in ``docketline.plans.oracle``; timestamps are
formatted as text so that both engines compare equal.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketline import sinks
from docketline.functions import text as T
from docketline.functions.html_exact import with_first_line
from docketline.operators import extract, inference, jobs, joins, payload, post
from docketline.operators.ordered import previous_non_null
from docketline.plans.chronology import land_entries, run_chronology
from docketline.run_log import RunLog, read_events
from docketline.session import _delete_on_exit, ensure_checkpoint_dir, spread
from docketline.sources import fixtures as fx
from docketline.sources import readers
from docketline.write_back import FolderClient, write_back

# --- fixed run parameters of the registered queries -------------------------
RUN_ID = "run-0"
RUN_TS = "2025-01-01 00:00:00"
SMALL_TOKEN_LIMIT = 300
LOG_TAIL_LINES = 20
# ----------------------------------------------------------------------------


def _entries(spark, sf):
    return readers.parse_entries(fx.entry_json(spark, sf))


def _rows(spark, sf, limit=T.TOKEN_LIMIT):
    return extract.courtbook_rows(land_entries(_entries(spark, sf)), fx.items(spark, sf),
                                  token_limit=limit, keep_internal=True)


def _run(spark, sf):
    return run_chronology(_entries(spark, sf), fx.items(spark, sf), fx.prompts(spark, sf),
                          scorer=inference.native_scorer(), run_id=RUN_ID, run_ts=RUN_TS)


def _fmt_parts(df: DataFrame) -> DataFrame:
    return df.withColumn("entry_date", T.py_datetime_str("entry_date")) \
        .withColumn("time_processed", F.date_format("time_processed", "yyyy-MM-dd HH:mm:ss"))


# --- text ---------------------------------------------------------------------

def q_token_estimate(spark, sf):
    d = fx.table(spark, sf, "documents")
    n = T.word_count("text")
    return d.select("doc_id", n.alias("n_words"), T.token_estimate(n).alias("tokens"),
                    T.part_count(T.token_estimate(n)).alias("n_parts"))


def _split(spark, sf, limit):
    r = _rows(spark, sf, limit).where(F.col("route") == extract.ROUTE_SUMMARISE)
    return r.select("court_book_id", "line_id", "part_no", "n_parts",
                    T.word_count("entry_original").alias("part_words"), "entry_original")


def q_split_parts(spark, sf):
    return _split(spark, sf, T.TOKEN_LIMIT)


def q_split_parts_300(spark, sf):
    return _split(spark, sf, SMALL_TOKEN_LIMIT)


def q_html_to_text(spark, sf):
    p = spread(fx.table(spark, sf, "pages").select("page_id", "html"), "page_id")
    return p.select("page_id", T.html_to_text("html").alias("text"))


def q_first_line(spark, sf):
    p = spread(fx.table(spark, sf, "pages").select("page_id", "html"), "page_id")
    return with_first_line(p, "html", "first_line").select(
        "page_id", "first_line", T.entry_description("first_line").alias("entry_description"))


def q_entry_description(spark, sf):
    e = _entries(spark, sf)
    fl = T.first_paragraph(F.coalesce(F.col("entry_final_html"), F.lit("")))
    return e.select("court_book_id", "line_id", fl.alias("first_line"),
                    T.entry_description(fl).alias("entry_description"))


def q_file_stem(spark, sf):
    p = fx.table(spark, sf, "pages")
    return p.select("page_id", T.file_stem("url").alias("stem"))


# --- entries, routing, lookups ---------------------------------------------------

def q_entries_explode(spark, sf):
    e = _entries(spark, sf)
    return e.select("court_book_id", "pos", "line_id", "book_item_id", "handwritten_raw",
                    "relevant_raw", "entry_date_ms", "entry_date_valid")


def q_entry_arrays(spark, sf):
    """Entries of JSON array files, read in splits."""
    raw = readers.array_rows(spark, fx.entry_array_files(spark, sf), book=F.col("court_book_id").cast("string"))
    return readers.parse_entries(raw).select("court_book_id", "pos", "line_id", "book_item_id", "handwritten_raw",
                                             "relevant_raw", "entry_date_ms", "entry_date_valid")


def q_array_recovery(spark, sf):
    """Entries that come back from array files with a fault in every tenth one."""
    raw = readers.array_rows(spark, fx.entry_array_files(spark, sf, spoiled=True), book=F.col("court_book_id").cast("string"))
    return readers.parse_entries(raw).select("court_book_id", "line_id", "book_item_id", F.sha2("entry_original_html", 256).alias("html_sha256"))


def q_entry_lines(spark, sf):
    """Ids of entries read from JSON lines, by line number in the file."""
    e = readers.read_entry_lines(spark, fx.entry_line_files(spark, sf))
    return e.select("court_book_id", "line_id", "pos", T.entry_uid("court_book_id", "line_id", "pos").alias("unique_id"))


def q_json_quarantine(spark, sf):
    c = fx.chunks(spark, sf).withColumn("body", F.regexp_replace("line", r"\Adata: ", ""))
    return readers.json_quarantine(c, "body").select("request_id", "chunk_no")


def q_normalize_flags(spark, sf):
    return extract.normalize_flags(_entries(spark, sf)).select(
        "court_book_id", "line_id", "handwritten", "relevant")


def q_route_entries(spark, sf):
    return extract.route_entries(_entries(spark, sf)).select("court_book_id", "line_id", "route")


def q_entry_date(spark, sf):
    e = _entries(spark, sf)
    return e.select("court_book_id", "line_id",
                    T.py_datetime_str(F.timestamp_millis("entry_date_ms")).alias("entry_date"),
                    "entry_date_valid")


def q_entry_uid(spark, sf):
    e = _entries(spark, sf)
    return e.select("court_book_id", "line_id",
                    T.entry_uid("court_book_id", "line_id", "pos").alias("unique_id"))


def q_last_wins(spark, sf):
    return joins.last_wins(fx.items(spark, sf), ["id"], "load_order", ["description"])


def q_lookup_description(spark, sf):
    e = _entries(spark, sf)
    table = joins.last_wins(fx.items(spark, sf), ["id"], "load_order", ["description"])
    t = table.select(F.col("id").alias("_lk"), "description", F.lit(True).alias("_hit"))
    j = e.join(t, e["book_item_id"] == t["_lk"], "left")
    return j.select("court_book_id", "line_id", "book_item_id",
                    F.when(F.col("_hit"), F.col("description")).otherwise(F.lit("-"))
                    .alias("book_item_description"),
                    F.coalesce(F.col("_hit"), F.lit(False)).alias("matched"))


def q_prompt_lookup(spark, sf):
    r = inference.prompt_lookup(_rows(spark, sf), fx.prompts(spark, sf))
    return r.select("court_book_id", "line_id", "part", F.col("prompt_id").cast("string").alias("prompt_id"),
                    "prompt_text")


def q_courtbook_rows(spark, sf):
    r = extract.courtbook_rows(land_entries(_entries(spark, sf)), fx.items(spark, sf))
    # Nullable ids are emitted as text so both engines type them alike.
    return r.withColumn("entry_date", T.py_datetime_str("entry_date")) \
        .withColumn("prompt_id", F.col("prompt_id").cast("string"))


def q_batch_manifest(spark, sf):
    r = _rows(spark, sf).withColumn(
        "batch_no", (F.floor(F.col("index") / inference.BATCH_ROWS) + 1).cast("bigint"))
    return inference.batch_manifest(r)


# --- inference boundary ---------------------------------------------------------

def q_request_table(spark, sf):
    r = inference.request_table(inference.prompt_lookup(_rows(spark, sf), fx.prompts(spark, sf)))
    return r.select("court_book_id", "line_id", "index", F.col("prompt_id").cast("string").alias("prompt_id"),
                    "request_hash")


def q_request_dedup(spark, sf):
    r = inference.request_table(inference.prompt_lookup(_rows(spark, sf), fx.prompts(spark, sf)))
    return inference.request_dedup(r).select("request_hash", "n_rows")


def q_sse_fold(spark, sf):
    return inference.sse_fold(fx.chunks(spark, sf))


def q_bullet_extract(spark, sf):
    r = fx.responses(spark, sf)
    return r.select("conv_id", "turn", T.extract_bullets("response").alias("response"))


def q_response_status(spark, sf):
    r = fx.responses(spark, sf)
    return r.select("conv_id", "turn", inference.response_status(
        F.col("response"), F.lit(extract.ROUTE_SUMMARISE)).alias("status"))


def q_clean_response(spark, sf):
    r = fx.responses(spark, sf)
    b = T.extract_bullets("response")
    return r.select("conv_id", "turn", T.clean_response(b).alias("cleaned"),
                    T.described_response(F.upper("role"), b).alias("described"))


def q_recombine_parts(spark, sf):
    r = fx.responses(spark, sf).withColumn("entry_role", F.col("role"))
    m = post.recombine_parts(r, key="conv_id", order="turn", firsts=("entry_role",), group_cols=())
    return m.select("conv_id", "entry_role", F.col("first_index").alias("first_turn"), "response")


def q_part_table(spark, sf):
    return _fmt_parts(_run(spark, sf).parts)


def q_parts_scan(spark, sf):
    """Part table written as one folder per book and batch, read back; book
    and batch come from the folder layout."""
    import os
    import uuid

    from docketline import sinks
    from docketline.session import ensure_checkpoint_dir
    path = os.path.join(ensure_checkpoint_dir(spark), "parts", uuid.uuid4().hex)
    parts = _fmt_parts(_run(spark, sf).parts)
    sinks.write_parts(parts, path)
    back = sinks.read_parts(spark, path, parts.schema)
    return back.groupBy("court_book_id", "batch_no").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("index").alias("first_index"),
        F.max("index").alias("last_index"), F.countDistinct("file_name").cast("bigint").alias("n_files_ok")) \
        .withColumn("n_files_ok", F.col("n_files_ok") >= 1)


def q_union_parts(spark, sf):
    parts = _run(spark, sf).parts
    return parts.groupBy("court_book_id", "status").agg(F.count(F.lit(1)).alias("n_rows"))


# --- post-processing and payload ------------------------------------------------

def q_chronology_sheet(spark, sf):
    return _run(spark, sf).sheet


def q_review_flag(spark, sf):
    s = post.with_review_flag(_run(spark, sf).sheet)
    return s.select("court_book_id", "line_id", "review_flag")


def q_column_width_profile(spark, sf):
    return post.column_width_profile(_run(spark, sf).sheet)


def q_format_html(spark, sf):
    return _run(spark, sf).extract


def q_merge_back(spark, sf):
    m = _run(spark, sf).merged
    return m.select("court_book_id", "line_id", "matched",
                    F.col("entry_final_html").alias("entry_final"))


def q_writeback_delta(spark, sf):
    return _run(spark, sf).delta


def _scratch(spark, name):
    path = os.path.join(ensure_checkpoint_dir(spark), "files", f"{name}-{uuid.uuid4().hex}")
    _delete_on_exit(spark, path)
    return path


def q_write_back_runs(spark, sf):
    """The delta staged by tasks, published at once, and read back."""
    client = FolderClient(_scratch(spark, "write-back"))
    write_back(_run(spark, sf).delta, client, RUN_ID)
    return client.published(spark)


def q_run_events(spark, sf):
    """Counts that a stage reports from the job that writes it."""
    log = RunLog(spark, _scratch(spark, "events"), RUN_ID)
    routed = extract.route_entries(land_entries(_entries(spark, sf)))
    counts = {k: F.col("route") == k for k in ("bypass", "summarise", "drop")}
    log.stage("route", routed, lambda df: df.write.parquet(_scratch(spark, "routed")), counts)
    ended = read_events(spark, log.path).where("event = 'end'")
    return ended.select("run_id", "stage", F.explode("metrics").alias("metric", "value"))


def q_chronology_payload(spark, sf):
    return _run(spark, sf).payload


# --- work list and ledger ----------------------------------------------------------

def q_worklist_scan(spark, sf):
    return readers.worklist_ids(fx.worklist(spark, sf))


def q_incremental_anti(spark, sf):
    return joins.unprocessed(readers.worklist_ids(fx.worklist(spark, sf)), fx.ledger(spark, sf))


def q_incremental_bucketed(spark, sf):
    """``incremental_anti`` against a ledger kept in buckets of its ids."""
    name = f"ledger_{uuid.uuid4().hex}"
    ledger = sinks.bucketed(fx.ledger(spark, sf).select("ID"), ["ID"], _scratch(spark, "ledger"), name)
    return joins.unprocessed(readers.worklist_ids(fx.worklist(spark, sf)), ledger)


def q_incremental_semi(spark, sf):
    return joins.already_processed(readers.worklist_ids(fx.worklist(spark, sf)), fx.ledger(spark, sf))


def q_worklist_except(spark, sf):
    todo = readers.worklist_ids(fx.worklist(spark, sf)).select("ID")
    return todo.subtract(fx.ledger(spark, sf).select("ID"))


# --- change detection, logs ----------------------------------------------------------

def q_first_pending(spark, sf):
    return jobs.first_pending(fx.dated_worklists(spark, sf), fx.ledger(spark, sf), "line_no", ["list_id"])


def q_job_status(spark, sf):
    status = jobs.job_status(fx.submitted(spark, sf), fx.finished_at(spark, sf))
    return status.withColumn("last_submitted", F.date_format("last_submitted", "yyyy-MM-dd HH:mm:ss"))


def q_sheet_strings(spark, sf):
    """The written sheet, read back with every cell as text."""
    sheet, path = _run(spark, sf).sheet, _scratch(spark, "sheet")
    sinks.write_sheet(sheet, path)
    return readers.as_strings(sinks.read_parts(spark, path, sheet.schema).drop("file_name"))


def q_change_detect(spark, sf):
    from docketline.streaming.watch import changes
    w = fx.watch(spark, sf)
    return changes(w).select("path", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
                             "md5")


def q_resubmit_reject(spark, sf):
    ev = fx.table(spark, sf, "events").select(
        F.col("event_type").alias("queue"), "ts", "event_id",
        F.col("user_id").cast("string").alias("ID"))
    p = previous_non_null(ev, "queue", ["ts", "event_id"], "ID", "prev_id")
    return p.select("queue", "event_id", "ID",
                    F.coalesce(F.col("ID") != F.col("prev_id"), F.lit(True)).alias("accepted"))


def q_log_parse(spark, sf):
    p = readers.parse_log(fx.runlog(spark, sf))
    return p.select("line_no", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "message")


def q_log_tail(spark, sf):
    return fx.runlog(spark, sf).orderBy(F.desc("line_no")).limit(LOG_TAIL_LINES).orderBy("line_no")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
