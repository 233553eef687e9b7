"""Step 3: part table → chronology sheet (one row per source entry)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.functions import text as T

SHEET_COLUMNS = ["source_doc", "entry_date", "entry_original", "response",
                 "handwritten", "time_processed", "line_id"]
# Sheet headers in column order A..G and the two fixed widths.
SHEET_DISPLAY = ["Source Doc", "EntryDate", "EntryOriginal", "Response",
                 "Handwritten", "TimeProcessed", "LineID"]
FIXED_WIDTHS = {"C": 30, "D": 100}
WIDTH_PAD = 2


def clean_parts(parts: DataFrame) -> DataFrame:
    """Response := description line + cleaned response."""
    return parts.withColumn("response", T.described_response("entry_description", "response"))


def _first_non_null(col: str, order: str = "index") -> F.Column:
    return F.expr(f"min_by({col}, {order}) FILTER (WHERE {col} IS NOT NULL)").alias(col)


def recombine_parts(parts: DataFrame, key: str = "unique_id", order: str = "index",
                    firsts: tuple[str, ...] = ("entry_date", "source_doc", "entry_original",
                                               "handwritten", "time_processed", "line_id"),
                    group_cols: tuple[str, ...] = ("court_book_id",)) -> DataFrame:
    """Merge the parts of each entry: first non-null value of each field in
    part order, and the stripped non-null responses joined by line breaks
    behind one leading line break.

    Groups are one entry's parts (bounded by its text size); the aggregate
    shuffles on (book, key), which hot books do not skew.
    """
    stripped = parts.withColumn("_resp", T.py_strip("response"))
    agg = stripped.groupBy(*group_cols, key).agg(
        *[_first_non_null(c, order) for c in firsts],
        F.expr(f"listagg(_resp, '\\n') WITHIN GROUP (ORDER BY {order})").alias("_joined"),
        F.min(order).alias("first_index"))
    return agg.withColumn(
        "response",
        F.concat(F.lit("\n"), F.regexp_replace(F.coalesce(F.col("_joined"), F.lit("")), r"\A\n+", "")),
    ).drop("_joined")


def chronology_sheet(parts: DataFrame) -> DataFrame:
    """The 7 sheet columns per entry (plus the book and the entry's first
    row index for ordering); dates as Python prints them."""
    merged = recombine_parts(clean_parts(parts))
    return merged.select(
        "court_book_id", "first_index", "source_doc",
        T.py_datetime_str("entry_date").alias("entry_date"), "entry_original", "response",
        "handwritten", F.date_format("time_processed", "yyyy-MM-dd HH:mm:ss").alias("time_processed"),
        "line_id")


def with_review_flag(sheet: DataFrame) -> DataFrame:
    return sheet.withColumn("review_flag", T.review_flag("response"))


def column_width_profile(sheet: DataFrame) -> DataFrame:
    """Per book and sheet column: longest cell text (header included) + 2;
    columns C and D have fixed widths."""
    letters = [chr(ord("A") + i) for i in range(len(SHEET_COLUMNS))]
    aggs = [F.max(F.length(F.col(c).cast("string"))).alias(f"_m{i}")
            for i, c in enumerate(SHEET_COLUMNS)]
    per_book = sheet.groupBy("court_book_id").agg(*aggs)
    stack = ", ".join(f"'{letters[i]}', '{SHEET_DISPLAY[i]}', _m{i}" for i in range(len(letters)))
    long = per_book.selectExpr(
        "court_book_id", f"stack({len(letters)}, {stack}) AS (column_letter, column_name, max_len)")
    fixed = F.lit(None).cast("int")
    for letter, width in FIXED_WIDTHS.items():
        fixed = F.when(F.col("column_letter") == letter, F.lit(width)).otherwise(fixed)
    width = F.greatest(F.length("column_name"), F.coalesce(F.col("max_len"), F.lit(0))) + WIDTH_PAD
    return long.select("court_book_id", "column_letter", "column_name",
                       F.coalesce(fixed, width).cast("bigint").alias("width"))
