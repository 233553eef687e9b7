"""Line dedup by site-relative frequency.

Every row is a page of its host. A line (trimmed of blanks, tabs and carriage
returns) is boilerplate on a host when it stands on at least ``min_pages`` pages
and on more than ``ratio`` of the host's pages; all its occurrences on that host
go. Only built-in functions are used.

Scale: what is shuffled is (host, 64-bit hash of the line), once a page and
summed before the shuffle, never a text. The boilerplate lines of a host are at
most (lines on an average page of it) / ratio, so they fit one row a host; that
table is written first, so Spark knows its size when it picks the join and
broadcasts it only below its own byte threshold. Above that, hosts are spread
by a salt, so a host with a third of all pages does not meet in one task.
A hash is compared within one host only: with 10^9 lines on a host and 500
boilerplate lines, a false match has a chance of about 3 in 10^8.

Defined results: a null host is a host of its own; null texts stay null and
count as pages without lines; blank lines are neither counted nor dropped;
repeated rows are separate pages; a page whose lines all go keeps its row with
an empty text; an empty table gives an empty table. Columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import fresh, materialize

RATIO = 0.05
MIN_PAGES = 3
SALTS = 16
#: What a line is trimmed of.
BLANKS = " \t\r\x0b\x0c"


def _line(x: Column) -> Column:
    return F.btrim(x, F.lit(BLANKS))


def _hashes(text: Column) -> Column:
    """Distinct hashes of the lines with something on them."""
    lines = F.filter(F.split(text, "\n"), lambda x: _line(x) != "")
    return F.array_distinct(F.transform(lines, lambda x: F.xxhash64(_line(x))))


def boilerplate(pages: DataFrame, host_col: str, text_col: str, ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines): the hashes of each host's boilerplate lines."""
    host, text = F.col(f"`{host_col}`").cast("string"), F.col(f"`{text_col}`").cast("string")
    totals = pages.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("total"))
    counts = (pages.select(host.alias("host"), F.explode(_hashes(text)).alias("line"))
              .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= min_pages))
    t = totals.select(F.col("host").alias("h"), "total")
    common = counts.join(t, counts["host"].eqNullSafe(t["h"])).where(F.col("n") > F.lit(ratio) * F.col("total"))
    return common.groupBy("host").agg(F.collect_set("line").alias("lines"))


def drop_boilerplate(pages: DataFrame, host_col: str, text_col: str = "text", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, counts: tuple[str, str] | None = None) -> DataFrame:
    """``pages`` with boilerplate lines removed from ``text_col``; ``counts``
    names two more columns, for the number of lines and of dropped lines."""
    table = materialize(boilerplate(pages, host_col, text_col, ratio, min_pages), "boilerplate")
    lines, salt = fresh(pages, "boilerplate_lines"), fresh(pages, "boilerplate_salt")
    host = F.coalesce(F.concat(F.lit("h"), F.col(f"`{host_col}`").cast("string")), F.lit(""))
    key, key2 = fresh(pages, "boilerplate_host"), fresh(pages, "boilerplate_key")
    known = (table.select(F.coalesce(F.concat(F.lit("h"), F.col("host")), F.lit("")).alias(key2),
                          F.col("lines").alias(lines),
                          F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(salt + "2")))
    plain = [F.col(f"`{c}`") for c, t in pages.dtypes if c != host_col and "map<" not in t and t != "variant"]
    spread = F.pmod(F.xxhash64(*plain or [F.lit(0)]), F.lit(SALTS))
    df = pages.withColumn(key, host).withColumn(salt, spread.cast("int"))
    df = df.join(known, (df[key] == known[key2]) & (df[salt] == known[salt + "2"]), "left")
    text = F.col(f"`{text_col}`")
    kept = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(F.col(lines), F.xxhash64(_line(x))))
    kept = F.when(F.col(lines).isNull() | text.isNull(), F.split(text, "\n")).otherwise(kept)
    arr = fresh(pages, "kept_lines")
    df = df.withColumn(arr, kept)
    out = [F.array_join(F.col(arr), "\n").alias(c) if c == text_col else F.col(f"`{c}`") for c in pages.columns]
    if counts:
        n = F.coalesce(F.size(F.split(text, "\n")), F.lit(0))
        n = F.when(text.isNull(), 0).otherwise(n).cast("long")
        kept_n = F.when(text.isNull(), 0).otherwise(F.size(arr)).cast("long")
        out += [n.alias(counts[0]), (n - kept_n).alias(counts[1])]
    return df.select(*out)
