"""Views of the driver's test tables in the shapes the pipeline reads.

Each view is derived by Spark from the given tables, so its size grows with
them. The matching DuckDB forms live in ``docketline.plans.oracle``.

| view | built from |
| --- | --- |
| entry_json | documents ⟕ labels, one JSON object per entry (source shape) |
| items | part ∪ supplier as (id, description) with a load order (last wins) |
| prompts | benchmark as (prompt_id, prompt_text) |
| responses | conversation turns; assistant turns get '* ' after each line break |
| chunks | conversations as event-stream lines; non-assistant turns are not JSON |
| watch | events as (path, version, content) snapshots |
| worklist / ledger | order and customer keys as requested and finished books |
| runlog | events as '[ts] message' log lines |
| entry_array_files / entry_line_files | entry_json written as JSON array files or JSON lines, a file a book and range of ids |
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketline.functions.text import html_paragraphs
from docketline.session import _delete_on_exit, ensure_checkpoint_dir, spread

# --- fixed values of the fixture mapping ------------------------------------
ENTRY_EPOCH_MS = 1_700_000_000_000      # entryDate of doc 0
ENTRY_STEP_MS = 3_600_000                # one hour per doc id
ITEM_ID_FACTOR = 3                       # bookItemId = doc_id * 3
FILE_IDS = 2000                          # a file of a book holds ids of a range of this length
SPOILED = (10, 3)                        # ids with this remainder lose a quote in spoiled files
# ----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entry_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source entries as JSON text, one row per entry: (court_book_id, pos,
    raw). Unlabelled documents have no flags and no entryDate keys (absent,
    not null), like entries the source system never classified."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang", "n_chars"), "doc_id")
    labels = table(spark, sf_dir, "labels")
    e = docs.join(labels, "doc_id", "left")
    html = html_paragraphs(F.col("text"))
    obj = F.struct(
        F.col("doc_id").alias("id"),
        F.col("source").alias("courtBookId"),
        (F.col("doc_id") * ITEM_ID_FACTOR).alias("bookItemId"),
        F.when(F.col("toxic") == 1, F.lit(" TRUE ")).when(F.col("toxic") == 0, F.lit("false"))
        .alias("handwritten"),
        F.when(F.col("quality") == 1, F.lit("Relevant")).when(F.col("quality") == 0, F.lit("relevant"))
        .alias("relevant"),
        F.when(F.col("quality").isNotNull(),
               F.lit(ENTRY_EPOCH_MS) + F.col("doc_id") * F.lit(ENTRY_STEP_MS)).alias("entryDate"),
        html.alias("entryOriginal"),
        html.alias("entryFinal"),
        F.col("lang"),
        F.col("n_chars").alias("nChars"),
    )
    return e.select(F.col("source").alias("court_book_id"), F.col("doc_id").alias("pos"),
                    F.to_json(obj).alias("raw"))


def _book_files(entries: DataFrame, value, name: str) -> str:
    """Write a text file a (book, range of ids), lines in the order of ids, below
    the checkpoint folder. ``value`` makes a line from ``raw``, ``first`` and ``last``."""
    piece = F.floor(F.col("pos") / FILE_IDS)
    mine = Window.partitionBy("court_book_id", "piece").orderBy("pos")
    d = entries.withColumn("piece", piece).withColumns({
        "first": F.row_number().over(mine) == 1, "last": F.lead("pos").over(mine).isNull()})
    spark = entries.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "files", f"{name}-{uuid.uuid4().hex}")
    # the window's exchange is pruned where a line needs neither mark; a file must come from one task
    d = d.repartition("court_book_id", "piece").sortWithinPartitions("court_book_id", "piece", "pos").select("court_book_id", "piece", value.alias("value"))
    d.write.partitionBy("court_book_id", "piece").text(path)
    _delete_on_exit(spark, path)
    return path


def entry_array_files(spark: SparkSession, sf_dir: str, spoiled: bool = False) -> str:
    """Folder of JSON array files, the source system's shape. ``spoiled``: some
    entries lack their first quote, which turns round all that is string and all
    that isn't in the rest of the file."""
    raw = F.col("raw")
    if spoiled:
        raw = F.when(F.col("pos") % SPOILED[0] == SPOILED[1], F.regexp_replace(raw, r'\A\{"', "{")).otherwise(raw)
    line = F.concat(F.when(F.col("first"), "[").otherwise(","), raw, F.when(F.col("last"), "]").otherwise(""))
    return _book_files(entry_json(spark, sf_dir), line, "entry-arrays")


def entry_line_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder of files with one JSON object a line."""
    return _book_files(entry_json(spark, sf_dir), F.col("raw"), "entry-lines")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Book items (id, description, load_order); supplier rows load after
    part rows, so for shared ids the supplier name wins."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("description"),
        F.lit(0).alias("batch"), F.col("p_partkey").alias("seq"))
    supp = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("description"),
        F.lit(1).alias("batch"), F.col("s_suppkey").alias("seq"))
    return part.unionByName(supp).select(
        "id", "description", F.struct("batch", "seq").alias("load_order"))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("int").alias("prompt_id"), F.col("text").alias("prompt_text"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw model answers, one per turn: assistant turns have '* ' after each
    line break (bullet lists), other turns are plain prose."""
    conv = table(spark, sf_dir, "conversations")
    return conv.select(
        "conv_id", "turn", "role",
        F.when(F.col("role") == "assistant",
               F.replace(F.col("text"), F.lit("\n"), F.lit("\n* ")))
        .otherwise(F.col("text")).alias("response"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-stream lines (request_id, chunk_no, line). Assistant turns are
    JSON ``{"content": …}``; other turns are sent as bare text (not JSON)."""
    conv = table(spark, sf_dir, "conversations")
    body = F.when(F.col("role") == "assistant",
                  F.to_json(F.struct(F.col("text").alias("content")))).otherwise(F.col("text"))
    return conv.select(F.col("conv_id").cast("string").alias("request_id"),
                       F.col("turn").alias("chunk_no"),
                       F.concat(F.lit("data: "), body).alias("line"))


def watch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File snapshots: path = user, version = (ts, event_id), content hash."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").cast("string").alias("path"), "ts", "event_id",
                     F.md5(F.col("event_type")).alias("md5"))


def worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested books, one line per order (duplicates kept), raw text."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("line_no"), F.col("o_custkey").cast("string").alias("ID"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books with finished output: customers of the BUILDING segment."""
    return table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING") \
        .select(F.col("c_custkey").cast("string").alias("ID"))


def dated_worklists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work lists, one a day, of the requested books."""
    return table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("list_id"),
                                                 F.col("o_orderkey").alias("line_no"), F.col("o_custkey").cast("string").alias("ID"))


def submitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions of books: every order, at its date."""
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("ID"), F.col("o_orderdate").alias("submitted_at"))


def finished_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of books: orders with status F, at their date."""
    done = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return done.select(F.col("o_custkey").cast("string").alias("ID"), F.col("o_orderdate").alias("finished_at"))


def runlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("line_no"),
        F.concat(F.lit("["), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("] "),
                 F.col("event_type"), F.lit(" "), F.col("props")).alias("line"))
