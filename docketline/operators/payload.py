"""Step 4/5: chronology sheet → HTML responses → merged payload → write-back.

The merge is a keyed update join of the source entries (one row per entry)
with one response per (book, line id). Both sides are large, so this is a
shuffle join on (book, line id): line ids spread a hot book evenly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.functions import text as T
from docketline.operators.joins import last_wins, update_join


def response_extract(sheet: DataFrame) -> DataFrame:
    """(book, line id, HTML response) per sheet row, with its sheet order."""
    return sheet.select("court_book_id", "line_id",
                        T.format_html("response", "source_doc").alias("response"),
                        "first_index")


def merge_back(entries: DataFrame, extract: DataFrame) -> DataFrame:
    """Source entries with ``entry_final_html`` replaced by the last response
    of their line id (even an empty one); unmatched entries unchanged."""
    latest = last_wins(extract, ["court_book_id", "line_id"], "first_index", ["response"])
    return update_join(entries, latest, ["court_book_id", "line_id"], "entry_final_html", "response")


def payload_json(merged: DataFrame) -> DataFrame:
    """The source object with ``entryFinal`` replaced, as JSON text.

    Every other key of the source object passes through unchanged (values
    kept as VARIANT); the replaced key moves to the end of the object. Entries
    without a response keep ``entryFinal`` as it was, absent included.
    """
    fields = F.from_json("raw", "map<string,variant>")
    kept = F.map_filter(fields, lambda k, v: k != "entryFinal")
    final = F.create_map(F.lit("entryFinal"), F.col("entry_final_html").cast("variant"))
    new = F.when(F.col("matched"), F.map_concat(kept, final)).otherwise(fields)
    return merged.select("court_book_id", "line_id", F.to_json(new).alias("payload"))


def writeback_delta(merged: DataFrame, run_id: str) -> DataFrame:
    """Rows to send back: matched entries keyed (book, line id, run id).
    Writing it with ``partitionBy('run_id')`` in overwrite mode makes a
    retried run replace its own rows only."""
    return merged.where(F.col("matched")).select(
        "court_book_id", "line_id", F.lit(run_id).alias("run_id"),
        F.col("entry_final_html").alias("entry_final"))
