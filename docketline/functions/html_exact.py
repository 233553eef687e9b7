"""Exact first paragraph with the standard library's ``html.parser``.

The native Column rule in ``text.py`` covers paragraphs that open and close in
turn. Documents with open or nested ``<p>``, whose end a pattern cannot see, take
this path, an Arrow-batched pandas UDF over those rows only (a few in a hundred
of ordinary pages, 109 of the 250 test pages).

Tree rules (those of a tree builder on ``html.parser``): an end tag closes
the most recent open element of that name and everything opened after it;
an end tag with no open element of that name is ignored; void elements never
open; text inside ``<script>``/``<style>`` and comments is not text.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docketline.functions import text as T
from docketline.session import small_batches

# --- fixed values: elements without content, and raw-text elements ---------
VOID_ELEMENTS = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input",
                           "keygen", "link", "menuitem", "meta", "param", "source",
                           "track", "wbr", "basefont", "bgsound", "command", "frame",
                           "image", "isindex", "nextid", "spacer"})
RAW_TEXT_ELEMENTS = frozenset({"script", "style"})
# ----------------------------------------------------------------------------


class _Done(Exception):
    """The first non-empty paragraph has ended."""


class _FirstParagraph(HTMLParser):
    """Collects the text of the first non-empty <p> element, and stops behind it.

    Text belongs to every open paragraph, so the one that wins is the outermost
    that is open when the first text inside any paragraph comes; those before it
    closed empty. Elements are counted by name, so each tag costs what it opens or
    closes, and a document is read in linear time however it is nested."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.count: dict[str, int] = {}
        self.open_p: list[int] = []       # places in the stack
        self.winner: int | None = None    # place in the stack
        self.text: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in VOID_ELEMENTS:
            return
        if tag == "p":
            self.open_p.append(len(self.stack))
        self.stack.append(tag)
        self.count[tag] = self.count.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        pass  # an empty element

    def handle_endtag(self, tag):
        if not self.count.get(tag):
            return
        while True:
            closed = self.stack.pop()
            self.count[closed] -= 1
            if closed == "p":
                self.open_p.pop()
            if closed == tag:
                break
        if self.winner is not None and len(self.stack) <= self.winner:
            raise _Done

    def handle_data(self, data):
        if not self.open_p or self.stack[-1] in RAW_TEXT_ELEMENTS:
            return
        s = data.strip()
        if s:
            if self.winner is None:
                self.winner = self.open_p[0]
            self.text.append(s)


def first_paragraph(doc: str | None) -> str | None:
    """The whole text of the first non-empty <p>, None if there is none."""
    parser = _FirstParagraph()
    try:
        if doc:
            parser.feed(doc)
            parser.close()
    except _Done:
        pass
    return "".join(parser.text) if parser.text else None


@F.pandas_udf(StringType())
def first_paragraph_exact(docs: pd.Series) -> pd.Series:
    """``first_paragraph`` of each document."""
    return docs.map(first_paragraph)


def first_line_exact(html: Column) -> Column:
    return T.cut_line(first_paragraph_exact(html))


def with_first_line(df: DataFrame, src: str, out: str) -> DataFrame:
    """Add ``out`` = first line of HTML column ``src``: the native rule where
    paragraphs open and close in turn, the exact path for the other rows. These
    go to Python in batches bounded in bytes, however long the documents are."""
    small_batches(df.sparkSession)
    simple = T.paragraphs_alternate(F.col(src))
    native = df.where(simple).withColumn(out, T.first_paragraph(src))
    slow = df.where(~simple).withColumn(out, first_line_exact(F.col(src)))
    return native.unionByName(slow)
