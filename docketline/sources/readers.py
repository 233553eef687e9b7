"""Readers for the pipeline's inputs.

Everything is read with an explicit schema; JSON entries are parsed to
VARIANT so that unknown keys survive to the payload and "absent" can be told
apart from "null".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketline.functions.text import py_strip
from docketline.session import materialize
from docketline.sources.array_splits import array_rows

ENTRY_COLUMNS = ["court_book_id", "pos", "line_id", "book_item_id", "handwritten_raw",
                 "relevant_raw", "entry_date_ms", "entry_date_valid",
                 "entry_original_html", "entry_final_html", "raw"]


# Epoch milliseconds of the years 1 to 9999; other numbers are invalid dates.
DATE_RANGE_MS = (-62_135_596_800_000, 253_402_300_799_999)


def read_worklist(spark: SparkSession, path: str) -> DataFrame:
    """Work list CSV: first line is a header (name not checked), column 0 is
    the book id; blank ids dropped, duplicates kept, file order kept."""
    df = (spark.read.option("header", True).option("enforceSchema", True)
          .schema("ID string").csv(path))
    return worklist_ids(df.withColumn("line_no", F.monotonically_increasing_id()))


def worklist_ids(df: DataFrame, col: str = "ID") -> DataFrame:
    """Strip ids and drop blank ones (S1)."""
    ids = py_strip(F.col(col))
    return df.withColumn(col, ids).where(F.col(col).isNotNull() & (F.col(col) != ""))


def as_strings(df: DataFrame) -> DataFrame:
    """A sheet's cells as text: every column a string, booleans as Python prints
    them, empty cells null (a sheet has no empty text)."""
    def cell(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        text = F.initcap(c.cast("string")) if kind == "boolean" else c.cast("string")
        return F.nullif(text, F.lit("")).alias(name)

    return df.select(*[cell(name, kind) for name, kind in df.dtypes])


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """Prompt table CSV (prompt_id, prompt_text). No quoting or escaping: the
    text keeps its leading blank and literal backslash sequences."""
    return (spark.read.option("header", True).option("quote", "\u0000")
            .option("escape", "\u0000").option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .schema("prompt_id int, prompt_text string").csv(path))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value): the lines of text files, numbered from 0 in each
    file. The lines are written once with the number each has in its task; a count
    of the lines of each split gives the rest, so numbers don't depend on how the
    files are split."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("n"), "value")
    lines = materialize(lines, "lines")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "block").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("rows")).select(
        F.col("file").alias("s_file"), F.col("block").alias("s_block"), "first", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    joined = lines.join(splits, (F.col("file") == F.col("s_file")) & (F.col("block") == F.col("s_block")))
    return joined.select("file", (F.col("n") - F.col("first") + F.col("before")).alias("line_no"), "value")


def read_entry_lines(spark: SparkSession, path: str) -> DataFrame:
    """Landed entries, one JSON object per line (splittable), with the book
    id in the object. Position = line number in its file, from 0, whatever the
    split size."""
    return parse_entries(numbered_lines(spark, path).select(F.col("line_no").alias("pos"), F.col("value").alias("raw")))


def read_entry_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Landed API responses, one JSON array per file (the source system's
    shape), read in splits, as typed entries; ``quarantine`` has what is no object."""
    return parse_entries(array_rows(spark, path))


def quarantine(df: DataFrame) -> DataFrame:
    """Rows of (…, raw[, error]) that ``parse_entries`` leaves out, with a
    reason; the entries and these rows together are the input."""
    bad = json_quarantine(df)
    why = F.when(F.coalesce(F.length("raw"), F.lit(0)) > 20_000_000, "longer than the JSON parser takes").otherwise("not a JSON object")
    if "error" in df.columns:
        return bad.withColumn("reason", F.coalesce("error", why)).drop("error")
    return bad.withColumn("reason", why)


def parse_entries(df: DataFrame) -> DataFrame:
    """(pos, raw JSON object[, court_book_id]) → typed entries.

    Rules of the source reader: flags are strings (JSON booleans become
    'true'/'false'); a missing flag is ''; a missing ``bookItemId`` is the text
    'None'; a missing ``entryDate`` is 0 while a null or non-numeric one is
    invalid. Rows whose ``raw`` is not a JSON object go to ``json_quarantine``.

    The JSON text is parsed once into a VARIANT column and every field is
    read from that column. Non-objects are dropped by a generator (``inline``
    of a one-row array, or of none) rather than by a ``where``: Catalyst
    pushes a filter below the projection that parses, which would parse
    every entry a second time just for the test.
    """
    parsed = df.withColumn("_v", F.try_parse_json("raw"))
    is_object = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    v = F.col("_v")

    def s(path):
        return F.try_variant_get(v, path, "string")

    date_v = F.try_variant_get(v, "$.entryDate", "variant")
    date_type = F.schema_of_variant(date_v)
    numeric = date_type.rlike(r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$")
    number = F.try_variant_get(date_v, "$", "bigint")
    date_ms = (F.when(date_v.isNull(), F.lit(0).cast("bigint"))
               .when(numeric & number.between(*DATE_RANGE_MS), number))
    book = s("$.courtBookId")
    if "court_book_id" in df.columns:  # the request's or file's id comes first
        book = F.coalesce(F.col("court_book_id"), book)
    fields = F.struct(
        book.alias("court_book_id"),
        F.col("pos").cast("bigint").alias("pos"),
        s("$.id").alias("line_id"),
        F.coalesce(s("$.bookItemId"), F.lit("None")).alias("book_item_id"),
        s("$.handwritten").alias("handwritten_raw"),
        s("$.relevant").alias("relevant_raw"),
        date_ms.alias("entry_date_ms"),
        s("$.entryOriginal").alias("entry_original_html"),
        s("$.entryFinal").alias("entry_final_html"),
        F.col("raw"),
    )
    typed = parsed.select(F.inline(F.when(is_object, F.array(fields))))
    return typed.withColumn("entry_date_valid", F.col("entry_date_ms").isNotNull()) \
        .select(*ENTRY_COLUMNS)


def json_quarantine(df: DataFrame, col: str = "raw") -> DataFrame:
    """Rows whose text is not a JSON object (bad JSON, empty, scalar)."""
    v = F.try_parse_json(col)
    bad = v.isNull() | ~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    return df.where(bad)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Book items JSON (array per file or one object per line). Items missing
    the ``id`` or ``description`` key are ignored; a null description is kept."""
    txt = array_rows(spark, path)
    elems = txt.select(F.col("pos").alias("seq"), F.try_parse_json("raw").alias("v"))
    keys = F.map_keys(F.try_variant_get("v", "$", "map<string,variant>"))
    return elems.where(F.array_contains(keys, "id") & F.array_contains(keys, "description")) \
        .select(F.try_variant_get("v", "$.id", "string").alias("id"),
                F.try_variant_get("v", "$.description", "string").alias("description"),
                F.struct(F.lit(0).alias("batch"), F.col("seq")).alias("load_order"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Text log with '[yyyy-MM-dd HH:mm:ss] message' lines."""
    return spark.read.text(path).select(
        F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))


def parse_log(df: DataFrame) -> DataFrame:
    ts = F.regexp_extract("line", r"^\[([^\]]*)\] ", 1)
    return df.select(
        "line_no",
        F.try_to_timestamp(ts, F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"),
        F.regexp_extract("line", r"^\[[^\]]*\] (.*)$", 1).alias("message"))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Landed event-stream text, one file per request; chunk = line number."""
    files = spark.read.option("wholetext", True).text(path).select(
        F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1).alias("request_id"),
        F.posexplode(F.split("value", "\r?\n")).alias("chunk_no", "line"))
    return files.where(F.col("line") != "")
