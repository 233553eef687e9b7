"""Step 2: courtbook rows → model requests → responses → part table.

The model call is an inference boundary: rows are turned into a request
table, identical requests are sent once (``request_dedup``), and a pluggable
scorer turns (text, prompt) into a raw response. Bypass rows never reach the
scorer: they are split off with a filter and unioned back, because
``when(bypass, lit).otherwise(udf(...))`` still runs the UDF on every row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketline.functions import text as T
from docketline.operators.extract import ROUTE_BYPASS, ROUTE_SUMMARISE
from docketline.operators.joins import last_wins, lookup
from docketline.session import materialize

BATCH_ROWS = 50          # rows per output batch and per client session
STATUS_HANDWRITTEN = "handwritten"
STATUS_ERROR = "error"
STATUS_INCONCLUSIVE = "inconclusive"
STATUS_SUMMARY = "summary"
NO_RESPONSE = "Error: No response received"
EXCEPTION_RESPONSE = "Error: Exception occurred"

PART_COLUMNS = ["unique_id", "line_id", "source_doc", "part_no", "entry_date",
                "entry_description", "entry_original", "response", "handwritten",
                "time_processed"]


def prompt_lookup(rows: DataFrame, prompts: DataFrame, order: str | None = None) -> DataFrame:
    """``prompt_text`` by ``prompt_id``; last row wins per id; no match (or a
    NULL id) gives 'Default Prompt'."""
    p = prompts
    if order is None:
        p = p.withColumn("_ord", F.monotonically_increasing_id())
        order = "_ord"
    table = last_wins(p, ["prompt_id"], order, ["prompt_text"])
    return lookup(rows, table, "prompt_id", "prompt_id", "prompt_text", "prompt_text",
                  F.lit(T.DEFAULT_PROMPT))


def request_hash(text, prompt) -> Column:
    """Content hash of a request; length-prefixed so (a, bc) ≠ (ab, c)."""
    p = F.coalesce(F.col(prompt) if isinstance(prompt, str) else prompt, F.lit(""))
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.sha2(F.concat(F.length(p).cast("string"), F.lit(":"), p, t), 256)


def request_table(rows: DataFrame) -> DataFrame:
    """Rows that need the model, one request each."""
    return (rows.where(F.col("route") == ROUTE_SUMMARISE)
            .withColumn("request_hash", request_hash("entry_original", "prompt_text")))


def request_body(text="text", prompt="prompt") -> Column:
    """JSON body of a model request: {"text": …, "prompt": …}."""
    t = F.col(text) if isinstance(text, str) else text
    p = F.col(prompt) if isinstance(prompt, str) else prompt
    return F.to_json(F.struct(t.alias("text"), p.alias("prompt")))


def request_dedup(requests: DataFrame, answered: DataFrame | None = None) -> DataFrame:
    """One request per distinct hash, minus hashes already answered (a cache
    of earlier responses). Partial aggregation keeps a hot hash cheap."""
    distinct = requests.groupBy("request_hash").agg(
        F.any_value("entry_original").alias("text"),
        F.any_value("prompt_text").alias("prompt"),
        F.count(F.lit(1)).alias("n_rows"))
    if answered is not None:
        distinct = distinct.join(answered.select("request_hash").distinct(),
                                 "request_hash", "left_anti")
    return distinct


# --- scorers ----------------------------------------------------------------

def sentence_bullets(text: Column, prompt: Column) -> Column:
    """Deterministic stand-in model: every sentence of the text becomes one
    '* ' bullet line. Used by tests and benchmarks (no network)."""
    body = T.py_strip(F.coalesce(text, F.lit("")))
    return F.concat(F.lit("* "),
                    F.regexp_replace(body, r"([.!?])" + T.WS + "+", "$1\n* "))


def native_scorer(fn: Callable[[Column, Column], Column] = sentence_bullets):
    """Scorer from a Column expression (stays in the JVM)."""
    def score(requests: DataFrame) -> DataFrame:
        return requests.select("request_hash", fn(F.col("text"), F.col("prompt")).alias("raw_response"))
    return score


def pandas_scorer(call: Callable[[object, pd.DataFrame], pd.Series],
                  client_factory: Callable[[], object] = lambda: None,
                  batch_rows: int = BATCH_ROWS):
    """Scorer around a remote model client, run with ``mapInPandas``.

    ``call(client, frame[text, prompt])`` returns the raw responses. A new
    client is made for every ``batch_rows`` rows (session renewal). When a call
    fails, its rows are sent one by one, and only those that fail again get the
    'Error: Exception occurred' response. Concurrency = number of partitions of the input.
    """
    def one(client: object, row: pd.DataFrame) -> str | None:
        try:
            return pd.Series(call(client, row[["text", "prompt"]])).iloc[0]
        except Exception:  # the row's answer says so
            return EXCEPTION_RESPONSE

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), batch_rows):
                chunk = pdf.iloc[start:start + batch_rows]
                client = client_factory()
                try:
                    out = pd.Series(call(client, chunk[["text", "prompt"]]), index=chunk.index)
                except Exception:  # find the rows at fault; the others keep their answers
                    out = pd.Series([one(client, chunk.iloc[[i]]) for i in range(len(chunk))], index=chunk.index)
                yield pd.DataFrame({"request_hash": chunk["request_hash"].values,
                                    "raw_response": out.astype(object).values})

    def score(requests: DataFrame) -> DataFrame:
        return requests.select("request_hash", "text", "prompt").mapInPandas(
            run, "request_hash string, raw_response string")
    return score


def pandas_sentence_bullets(client, frame: pd.DataFrame) -> pd.Series:
    """The stand-in model as a Python call (to exercise the pandas path)."""
    import re
    out = []
    for text in frame["text"]:
        body = (text or "").strip()
        out.append("* " + re.sub(r"([.!?])\s+", "\\1\n* ", body))
    return pd.Series(out)


# --- responses ----------------------------------------------------------------

def response_status(raw: Column, route: Column, extracted: Column | None = None) -> Column:
    """Kind of a response, decided on the raw text before bullet extraction.

    ``extracted``: the response's ``final_response`` when it is computed
    anyway; it starts with the summary heading exactly when the raw text has
    a bullet, which saves a second regex scan of every response."""
    if extracted is None:
        has_bullet = F.size(F.regexp_extract_all(F.coalesce(raw, F.lit("")),
                                                 F.lit(T.BULLETS_RX), 0)) > 0
    else:
        has_bullet = extracted.startswith(T.SUMMARY_HEADING + "\n")
    return (F.when(route == ROUTE_BYPASS, F.lit(STATUS_HANDWRITTEN))
            .when(raw.isNull() | (raw == "") | raw.startswith("Error"), F.lit(STATUS_ERROR))
            .when(has_bullet, F.lit(STATUS_SUMMARY))
            .otherwise(F.lit(STATUS_INCONCLUSIVE)))


def final_response(raw: Column) -> Column:
    """What the part table stores: bullets of the raw response, or the
    no-response error."""
    return (F.when(raw.isNull() | (raw == ""), F.lit(NO_RESPONSE)).when(raw == EXCEPTION_RESPONSE, raw)
            .otherwise(T.extract_bullets(raw)))


def cacheable(responses: DataFrame) -> DataFrame:
    """The responses that may answer later runs: no errors, one a request."""
    return (responses.where(F.coalesce(F.length("raw_response"), F.lit(0)) > 0)
            .where(~F.col("raw_response").startswith("Error")).dropDuplicates(["request_hash"]))


def retry_table(responses: DataFrame) -> DataFrame:
    """The requests to send again: those with an error or no response."""
    good = cacheable(responses).select("request_hash")
    return responses.join(good, "request_hash", "left_anti").select("request_hash", "raw_response")


def part_table(rows: DataFrame, prompts: DataFrame, scorer: Callable[[DataFrame], DataFrame],
               run_ts: str = "1970-01-01 00:00:00", answered: DataFrame | None = None,
               cache_responses: bool = True) -> DataFrame:
    """Step 2 output: one row per courtbook row with the model's response.

    ``rows`` are courtbook rows with ``route`` (``courtbook_rows(...,
    keep_internal=True)``). Responses are materialised (``cache_responses``)
    so that a lost executor does not send the same requests again.
    ``answered`` (request_hash, raw_response): responses of earlier runs; their
    requests are not sent, and they answer the rows here. Errors among them
    don't count.
    """
    if answered is not None:
        answered = cacheable(answered)
    rows = prompt_lookup(rows, prompts)
    reqs = request_table(rows)
    responses = scorer(request_dedup(reqs, answered))
    if cache_responses:
        responses = materialize(responses, "responses")
    if answered is not None:
        responses = responses.select("request_hash", "raw_response").unionByName(answered.select("request_hash", "raw_response"))
    scored = (reqs.join(responses, "request_hash", "left")
              .withColumn("response", final_response(F.col("raw_response")))
              .withColumn("status", response_status(F.col("raw_response"), F.col("route"),
                                                    F.col("response")))
              .drop("raw_response", "request_hash"))
    bypass = (rows.where(F.col("route") == ROUTE_BYPASS)
              .withColumn("status", F.lit(STATUS_HANDWRITTEN))
              .withColumn("response", F.lit(T.HANDWRITTEN_RESPONSE)))
    out = scored.unionByName(bypass)
    return out.select(
        "court_book_id", "index",
        (F.floor(F.col("index") / BATCH_ROWS) + 1).cast("bigint").alias("batch_no"),
        "unique_id", "line_id",
        F.col("book_item_description").alias("source_doc"),
        F.col("part").alias("part_no"), "entry_date", "entry_description",
        "entry_original", "response", "handwritten",
        F.to_timestamp(F.lit(run_ts)).alias("time_processed"), "status")


def batch_manifest(rows: DataFrame) -> DataFrame:
    """Per book and 50-row batch: 1-based first/last record, rows, and the
    book's totals (rows, batches)."""
    per_batch = rows.groupBy("court_book_id", "batch_no").agg(
        (F.min("index") + 1).alias("first_record"), (F.max("index") + 1).alias("last_record"),
        F.count(F.lit(1)).alias("n_rows"))
    # book totals from the batch table (one row per 50 rows), not from a
    # second pass over the rows, which would read every part text again
    total = F.sum("n_rows").cast("bigint")
    per_book = per_batch.groupBy("court_book_id").agg(
        total.alias("total_records"),
        F.ceil(total / F.lit(BATCH_ROWS)).cast("bigint").alias("n_batches"))
    return per_batch.join(per_book, "court_book_id")


def sse_fold(chunks: DataFrame) -> DataFrame:
    """Event-stream lines → one response per request: the ``content`` of the
    JSON lines concatenated in chunk order and stripped; lines without
    content are skipped; nothing usable gives the no-content error."""
    c = chunks.withColumn("_content", T.sse_content("line"))
    folded = c.groupBy("request_id").agg(
        F.expr("listagg(_content, '') WITHIN GROUP (ORDER BY chunk_no)").alias("_text"))
    return folded.select(
        "request_id",
        F.when(F.coalesce(F.col("_text"), F.lit("")) == "", F.lit(T.NO_CONTENT_RESPONSE))
        .otherwise(T.py_strip("_text")).alias("response"))
