"""HTML rules: character references against the standard library, native text
and first lines against a tree walk, and inputs that would exhaust a recursive
matcher."""

import html
import random
from html.entities import html5

import pytest
from conftest import SF01, one_col
from html_tree import walk
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketline.functions import text as T
from docketline.functions.html_exact import first_line_exact, first_paragraph, with_first_line
from docketline.sources import fixtures as fx


def test_references_as_the_standard_library_decodes_them(spark):
    rng = random.Random(1)
    names = list(html5)
    texts = ["caf&eacute; &#8217;x&rsquo;", "&#0; &#x80; &#xD800; &#x110000; &#13; &#1; &#xfdd0; &#128512;", "x&", "&",
             "&notit; &notin; &not &amp;lt; &ampx &;&&amp", "&#99999999999999; &#x; &#; &#xg", "&NotEqualTilde; &aacute", "", "&#65279;a&#xfeff",
             *[f"&{n} &{n}x" for n in names]]
    pieces = ["&", ";", "#", "x41", "12", "a", " "]
    for _ in range(800):
        texts.append("".join(rng.choice([rng.choice(pieces), "&" + rng.choice(names), f"&#{rng.randrange(70000)}", f"&#x{rng.randrange(70000):x}"])
                             for _ in range(12)))
    got = one_col(spark, texts, T.decode_entities)
    assert [(t, g) for t, g in zip(texts, got) if g != html.unescape(t)] == []


def test_native_text_is_that_of_the_tree_on_pages(spark):
    rows = fx.table(spark, SF01, "pages").select("html", T.html_to_text("html").alias("t")).collect()
    assert len(rows) == 250
    assert all(r.t == html.unescape(" ".join(walk(r.html).nodes)) for r in rows)


@pytest.mark.parametrize("doc,line", [
    ("<p> </p><p>Hello <b>World</b></p>", "HelloWorld"), ("<div><p>a<p>b</p>c</div><p>z</p>", "abc"), (None, "-"), ("", "-"), ("no paragraph", "-"),
    ("<div><p>open</div>tail<p>next</p>", "open"), ("<p>" + "x" * 80 + "</p>", "x" * 80), ("<p>" + "x" * 81 + "</p>", "x" * 80 + "..."),
    ("<p>caf&eacute; &#8217;</p>", "café ’"), ("<script><p>no</p></script><p>yes</p>", "yes"),
])
def test_first_line_golden(spark, doc, line):
    df = spark.createDataFrame([(doc,)], "h string")
    assert df.select(first_line_exact(F.col("h"))).first()[0] == line
    assert with_first_line(df.withColumn("h", F.coalesce("h", F.lit(""))), "h", "x").first()["x"] == line


def test_registered_first_lines_are_the_trees(spark):
    from docketline.plans.queries import QUERIES
    got = {r.page_id: r.first_line for r in QUERIES["first_line"](spark, SF01).collect()}
    pages = fx.table(spark, SF01, "pages").select("page_id", "html").collect()
    for p in pages:
        full = next(filter(None, map("".join, walk(p.html).paragraphs)), "-")
        assert got[p.page_id] == (full if len(full) <= 80 else full[:80] + "...")
    assert len(got) == len(pages) == 250


def test_step_one_decodes_what_the_model_reads(spark):
    from docketline.operators.extract import entry_texts
    df = spark.createDataFrame([("<p>caf&eacute; &#8217;s &rsquo;x&rsquo;</p>",)] * 2, "entry_original_html string")
    r = entry_texts(df.withColumn("entry_final_html", F.col("entry_original_html"))).first()
    assert r.entry_text == r.entry_modified == r.first_line == "café ’s ’x’"


def test_long_malformed_texts(spark):
    n = 1_000_000
    texts = ["<p>a <b " + "x" * n, "<p " + 'a="b" ' * 20_000 + ">t</p>", "-" * n + " x", "<p>" + "&" * 10_000, "<" * 10_000]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    rows = df.select(T.html_to_text("x").alias("t"), T.first_paragraph("x").alias("l"), T.format_html("x", F.lit("a.b")).alias("f")).collect()
    assert len(rows[0].t) == n + 5 and rows[1].t == rows[1].l == "t" and "<li>x</li>" in rows[2].f


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "<br>", "<p/>", "<script>", "</script>", "x", "y ", " ", "<li>", "</ul>", "&amp;"]), max_size=30))
def test_first_paragraph_is_that_of_the_tree(parts):
    doc = "".join(parts)
    assert first_paragraph(doc) == next(("".join(t) for t in walk(doc).paragraphs if any(t)), None)


def test_deep_nesting_is_linear():
    import time
    start = time.time()
    assert first_paragraph("<p>" * 100_000 + "x" + "<p>y" * 100_000) == "x" + "y" * 100_000
    assert first_paragraph("".join(f"<a{i}>" for i in range(50_000)) + "</zz>" * 50_000 + "<p>t") == "t"
    assert first_paragraph("<p>" * 100_000 + "</p>" * 100_000 + "<p>end</p><p>no") == "end"
    assert time.time() - start < 20


def test_batches_of_the_exact_path_are_bounded_in_bytes(spark, monkeypatch):
    """A worker holds a few MB of documents, whatever the session's batch size."""
    import pandas as pd
    from pyspark.sql.types import StringType

    from docketline.functions import html_exact

    @F.pandas_udf(StringType())
    def held(docs: pd.Series) -> pd.Series:
        return pd.Series([str(docs.str.len().sum())] * len(docs))

    monkeypatch.setattr(html_exact, "first_paragraph_exact", held)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
    docs = spark.range(0, 400, 1, 1).select(F.concat(F.lit("<p><p>"), F.repeat(F.lit("x"), 50_000)).alias("html"))
    most = max(int(r["line"]) for r in with_first_line(docs, "html", "line").collect())
    assert 0 < most <= 5_000_000


def test_text_is_worked_out_up_to_the_first_paragraph(spark):
    docs = ["<p> </p><p><b></b></p><p>one <i>two</i></p><p>three</p>", "<p></p>", "none", "", None, "<p>" + "y" * 81 + "</p>"]
    assert one_col(spark, docs, T.first_paragraph) == ["onetwo", "-", "-", "-", "-", "y" * 80 + "..."]
    plan = spark.createDataFrame([("",)], "x string").select(T.first_paragraph("x"))._jdf.queryExecution().analyzed().toString()
    assert "aggregate(" in plan and "filter(" not in plan
