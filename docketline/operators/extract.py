"""Step 1: source entries → courtbook rows (one row per entry part).

Plan shape: filter dropped entries first (before any text work), one
size-checked broadcast lookup of item descriptions, native text expressions,
a skew-safe running index per book, then ``posexplode`` of the parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.functions import text as T
from docketline.operators.joins import last_wins, lookup
from docketline.operators.ordered import DEFAULT_BLOCK_ROWS, exclusive_running_sum

ROUTE_BYPASS = "bypass"
ROUTE_SUMMARISE = "summarise"
ROUTE_DROP = "drop"
RELEVANT = "Relevant"

COURTBOOK_COLUMNS = [
    "index", "unique_id", "part", "first_line", "handwritten", "relevant",
    "court_book_id", "book_item_id", "line_id", "book_item_description",
    "entry_date", "prompt_id", "entry_original", "entry_modified",
    "token_count", "entry_description",
]
# Output names of the courtbook sheet, in the same order.
COURTBOOK_DISPLAY = [
    "Index", "Unique ID", "Part", "First Line", "Handwritten", "Relevant",
    "Court Book ID", "Book Item ID", "Line ID", "Book Item Description",
    "Entry Date", "PromptID", "Entry_Original", "Entry_Modified",
    "Token Count", "Entry Description",
]


def normalize_flags(entries: DataFrame) -> DataFrame:
    """handwritten: stripped, lower-cased; relevant: stripped; absent → ''."""
    return entries.withColumns({
        "handwritten": F.lower(T.py_strip(F.coalesce(F.col("handwritten_raw"), F.lit("")))),
        "relevant": T.py_strip(F.coalesce(F.col("relevant_raw"), F.lit(""))),
    })


def route_column() -> F.Column:
    """'true' → bypass whatever relevant says; 'false' + exactly 'Relevant'
    → summarise; everything else is dropped."""
    hw, rel = F.col("handwritten"), F.col("relevant")
    return (F.when(hw == "true", F.lit(ROUTE_BYPASS))
            .when((hw == "false") & (rel == RELEVANT), F.lit(ROUTE_SUMMARISE))
            .otherwise(F.lit(ROUTE_DROP)))


def route_entries(entries: DataFrame) -> DataFrame:
    return normalize_flags(entries).withColumn("route", route_column())


def lookup_description(df: DataFrame, items: DataFrame) -> DataFrame:
    """Item description by ``book_item_id``: last item wins per id, '-' when
    the id is unknown, NULL when the item's description is null."""
    table = last_wins(items, ["id"], "load_order", ["description"])
    return lookup(df, table, "book_item_id", "id", "description",
                  "book_item_description", F.lit("-"))


def entry_texts(df: DataFrame) -> DataFrame:
    """Text columns of an entry: cleaned original/final text, first line,
    description, word count and token estimate."""
    # The final HTML is usually the original one: then its text and its
    # paragraph marks come from the original's one raw-block pass (a NULL
    # pair is not equal and takes the general branch).
    same = F.col("entry_final_html") == F.col("entry_original_html")
    raw_free = F.col("_orig_raw_free")
    return (df
            .withColumn("_orig_raw_free", T.without_raw_blocks("entry_original_html"))
            .withColumn("entry_text", T.html_to_text("entry_original_html", raw_free))
            .withColumn("entry_modified", F.when(same, F.col("entry_text"))
                        .otherwise(T.html_to_text("entry_final_html")))
            .withColumn("_pm", F.when(same, T.paragraph_marked(None, raw_free))
                        .otherwise(T.paragraph_marked("entry_final_html")))
            .drop("_orig_raw_free")
            .withColumn("first_line", T.first_paragraph("_pm", marked=True))
            .withColumn("entry_description", T.entry_description("first_line"))
            .withColumn("_words", T.words("entry_text"))
            .withColumn("n_words", F.size("_words").cast("bigint"))
            .withColumn("tokens", T.token_estimate("n_words")))


_STEP1_KEEP = ["court_book_id", "pos", "line_id", "book_item_id", "handwritten", "relevant",
               "route", "book_item_description", "entry_date_ms", "entry_date_valid",
               "entry_modified", "first_line", "entry_description", "tokens", "n_parts",
               "_parts", "unique_id", "_exact_html"]


def _exact_first_lines(e: DataFrame) -> DataFrame:
    """Recompute the first line with the exact HTML path for the rows that
    need it. ``e`` is read from the materialised step-1 table, so the split
    re-reads Parquet (the flagged branch is pruned by the null filter) rather
    than recomputing the source."""
    from docketline.functions.html_exact import first_line_exact
    from docketline.session import small_batches
    small_batches(e.sparkSession)
    flagged = F.col("_exact_html").isNotNull()
    plain = e.where(~flagged)
    exact = (e.where(flagged)
             .withColumn("first_line", first_line_exact(F.col("_exact_html")))
             .withColumn("entry_description", T.entry_description("first_line")))
    return plain.unionByName(exact).drop("_exact_html")


def courtbook_rows(entries: DataFrame, items: DataFrame, token_limit: int = T.TOKEN_LIMIT,
                   block_rows: int = DEFAULT_BLOCK_ROWS, keep_internal: bool = False) -> DataFrame:
    """Step 1 output: one row per entry part with a 0-based running ``index``
    per book (source order, then part order)."""
    e = route_entries(entries).where(F.col("route") != ROUTE_DROP)
    e = lookup_description(e, items)
    e = entry_texts(e)
    bypass = F.col("route") == ROUTE_BYPASS
    html = F.coalesce(F.col("entry_final_html"), F.lit(""))
    needs_exact = ~T.paragraphs_alternate("_pm", marked=True)
    e = (e
         .withColumn("n_parts", F.when(bypass, F.lit(1).cast("bigint"))
                     .otherwise(T.part_count("tokens", token_limit)))
         .withColumn("_parts", F.when(bypass, F.array("entry_text"))
                     .otherwise(T.split_words("_words", "n_parts")))
         .withColumn("unique_id", T.entry_uid("court_book_id", "line_id", "pos"))
         # HTML is kept only for rows whose first line needs the exact path
         .withColumn("_exact_html", F.when(needs_exact, html)))
    e = e.select(*_STEP1_KEEP)
    e = exclusive_running_sum(e, "court_book_id", "pos", "n_parts", "_base", block_rows)
    e = _exact_first_lines(e)
    rows = e.select("*", F.posexplode("_parts").alias("part_idx", "entry_original"))
    rows = rows.withColumns({
        "index": F.col("_base") + F.col("part_idx"),
        "part_no": (F.col("part_idx") + 1).cast("bigint"),
        "part": F.concat(F.lit("Part "), (F.col("part_idx") + 1).cast("string"),
                         F.lit("/"), F.col("n_parts").cast("string")),
        "entry_date": F.timestamp_millis(F.col("entry_date_ms")),  # bounded by the reader
        "prompt_id": F.when(bypass, F.lit(None).cast("int")).otherwise(F.lit(1)),
        "token_count": F.when(bypass, F.lit(0).cast("bigint")).otherwise(F.col("tokens")),
    })
    cols = COURTBOOK_COLUMNS + (["route", "pos", "part_no", "n_parts", "entry_date_valid"]
                                if keep_internal else [])
    return rows.select(*cols)


def display_names(df: DataFrame) -> DataFrame:
    """Rename to the sheet's column names (for CSV/Excel-style sinks)."""
    return df.withColumnsRenamed(dict(zip(COURTBOOK_COLUMNS, COURTBOOK_DISPLAY)))
