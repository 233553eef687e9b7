"""The chronology job end to end: entries → courtbook rows → part table →
chronology sheet → payload. Each stage is a DataFrame; the caller decides
which ones to write (see ``docketline.sinks``)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline import sinks
from docketline.operators import extract, inference, payload, post
from docketline.session import materialize
from docketline.sources import readers


@dataclass
class ChronologyRun:
    rows: DataFrame        # step 1: courtbook rows (with route)
    parts: DataFrame       # step 2: part table
    sheet: DataFrame       # step 3: chronology sheet
    extract: DataFrame     # step 4: (book, line id, HTML response)
    merged: DataFrame      # step 4: source entries with entryFinal replaced
    payload: DataFrame     # step 4: payload JSON per entry
    delta: DataFrame       # step 5: write-back rows
    quarantine: DataFrame | None = None  # raw rows that are no entries, with a reason


def land_entries(entries: DataFrame) -> DataFrame:
    """Write the typed entries once (raw JSON → typed Parquet table).

    Every later step filters and projects them; on the landed table those
    filters reach the Parquet scan, whereas on the JSON form Catalyst pushes
    them through the parse and parses each entry again per predicate. Step 1
    and the payload merge also share this one parse.
    """
    return materialize(entries, "entries")


def land_raw(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Land raw JSON rows once; typed entries and, with a reason, the rows that
    are none. The two together are the input."""
    raw = materialize(raw, "raw-entries")
    return readers.parse_entries(raw), materialize(readers.quarantine(raw), "quarantine")


def run_chronology(entries: DataFrame, items: DataFrame, prompts: DataFrame, *,
                   scorer, run_id: str = "run-0", run_ts: str = "1970-01-01 00:00:00",
                   token_limit: int = extract.T.TOKEN_LIMIT,
                   answered: DataFrame | None = None, snapshot: str | None = None) -> ChronologyRun:
    """``snapshot``: a folder that keeps the source rows of every run as they were
    before the merge; all steps then read this run's copy, so nothing is written twice."""
    bad = None
    if "entry_date_ms" not in entries.columns:  # raw rows (pos, raw[, court_book_id, error])
        entries, bad = land_raw(entries)
    entries = sinks.snapshot(entries, snapshot, run_id) if snapshot else land_entries(entries)
    rows = extract.courtbook_rows(entries, items, token_limit=token_limit, keep_internal=True)
    parts = inference.part_table(rows, prompts, scorer=scorer, run_ts=run_ts, answered=answered)
    sheet = post.chronology_sheet(parts)
    ext = payload.response_extract(sheet)
    merged = payload.merge_back(entries, ext)
    # payload and delta replace the final text or leave it in ``raw``: their join doesn't carry it
    replaced = payload.merge_back(entries.withColumn("entry_final_html", F.lit(None).cast("string")), ext)
    return ChronologyRun(rows=rows, parts=parts, sheet=sheet, extract=ext, merged=merged,
                         payload=payload.payload_json(replaced),
                         delta=payload.writeback_delta(replaced, run_id), quarantine=bad)
