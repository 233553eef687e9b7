"""Text rules: golden inputs and outputs written by hand, and properties that
every result must have, on random strings of the characters that matter."""

import random

import pytest
from conftest import one_col
from pyspark.sql import functions as F

from docketline.functions import text as T

PIECES = ["a", "B", "é", "Ü", "ǅ", "1", ".", "-", "*", "•", "→", " ", "  ", "\t", "\n", "\r", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u3000",
          "XML", "AI Summary", "â€¢", "x.y", "/", "\\", "..", "MRI"]
BULLETS = "*-•→"


@pytest.fixture(scope="module")
def strings():
    rng = random.Random(7)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(400)]


@pytest.mark.parametrize("response,out", [
    ("* a\n* b", "AI Summary\n* a\n\n* b"),
    ("intro\n  - one\nplain\n• two", "AI Summary\n\n  - one\n\n• two"),
    ("no list", "Inconclusive Response"), ("", "Inconclusive Response"), (None, "Inconclusive Response"),
    ("*no blank", "Inconclusive Response"), ("→→ x", "AI Summary\n→→ x"),
])
def test_bullets_golden(spark, response, out):
    assert one_col(spark, [response], T.extract_bullets) == [out]


@pytest.mark.parametrize("response,out", [
    ("AI Summary\n* a\n\n- b", "AI Summary\n\t* a\n\t* b"), ("x\n   •• y  ", "x\n\t* y"), ("a\nhas XML here\nb", "a\n\tb"), ("", ""),
    ("â€¢ z", "* z"), ("\n\n", ""),
])
def test_clean_golden(spark, response, out):
    assert one_col(spark, [response], T.clean_response) == [out]


def test_clean_drops_lines_by_prefix(spark):
    assert one_col(spark, ["keep\nTool: x\nend"], lambda c: T.clean_response(c, drop_prefixes=("Tool",))) == ["keep\n\tend"]


@pytest.mark.parametrize("response,source,out", [
    ("* a\n- b", r"C:\d\file.v1.docx", r"<header><h2>C:\d\file.v1</h2></header><ul><li>a</li><li>b</li></ul>"),
    ("AI Summary\n\t* only", "f.pdf", "<header><h2>f</h2></header><ul><li>only</li></ul>"),
    ("AI Summary", "f.pdf", ""), ("", "f.pdf", ""), ("- \n**", "f.pdf", ""), ("a < b", None, "<header><h2></h2></header><ul><li>a < b</li></ul>"),
])
def test_html_golden(spark, response, source, out):
    df = spark.createDataFrame([(response, source)], "r string, s string")
    assert df.select(T.format_html("r", "s")).first()[0] == out


def test_bullet_properties(spark, strings):
    for s, out in zip(strings, one_col(spark, strings, T.extract_bullets)):
        if out == "Inconclusive Response":
            assert not any(line.lstrip()[:1] in BULLETS and line.lstrip().lstrip(BULLETS)[:1].isspace() for line in s.split("\n") if line.strip())
            continue
        head, _, rest = out.partition("\n")
        assert head == "AI Summary"
        lines = [x for x in rest.split("\n") if x.strip()]
        assert any(x.lstrip()[:1] in BULLETS for x in lines)
        at = 0
        for x in lines:  # kept lines come from the response, in its order
            at = s.index(x, at)


def test_clean_properties(spark, strings):
    once = one_col(spark, strings, T.clean_response)
    for s, out in zip(strings, once):
        assert "XML" not in out and "â€¢" not in out and out == out.strip()
        lines = out.split("\n") if out else []
        assert all(x.strip() for x in lines) and all(x.startswith("\t") for x in lines[1:])
    again = one_col(spark, once, T.clean_response)
    assert [x.replace("\t", "") for x in again] == [x.replace("\t", "") for x in one_col(spark, again, T.clean_response)]


def test_html_properties(spark, strings):
    for out in one_col(spark, strings, lambda c: T.format_html(c, F.lit("doc.pdf"))):
        if not out:
            continue
        assert out.startswith("<header><h2>doc</h2></header><ul><li>") and out.endswith("</li></ul>")
        items = out.removeprefix("<header><h2>doc</h2></header><ul><li>").removesuffix("</li></ul>").split("</li><li>")
        assert all(x.strip() and x[0] not in BULLETS and "AI Summary" not in x for x in items)


@pytest.mark.parametrize("rule,method", [(T.py_strip, str.strip), (T.words, str.split), (T.is_upper, str.isupper)])
def test_rules_named_after_string_methods(spark, strings, rule, method):
    more = ["Aª", "ªº", "Aʰ", "ⅷA", "ⅧA", "Ⓐ", "ⓐ", "ǅ", "A1", "1"]
    assert one_col(spark, strings + more, rule) == [method(s) for s in strings + more]


def test_token_rounding(spark):
    """Half-even rounding of n * 1.3 for the first 200,000 word counts."""
    got = [r.t for r in spark.range(0, 200_000).select(T.token_estimate("id").alias("t")).collect()]
    assert got == [round(n * 1.3) for n in range(200_000)]


def test_parts_rejoin_to_text(spark):
    """Joining the parts of an entry with one blank gives the whitespace-
    normalised text; part word counts add up to the entry's word count."""
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["w", "x.", "é", "a\tb"]) for _ in range(rnd.randint(0, 3000))) for _ in range(40)]
    df = spark.createDataFrame([(t, n) for t in texts for n in (1, 2, 3, 7)], "t string, n int")
    for r in df.select("t", "n", T.split_words(T.words("t"), F.col("n")).alias("p")).collect():
        assert " ".join(r.p) == " ".join(r.t.split())
        assert sum(len(x.split()) for x in r.p) == len(r.t.split())
        assert len(r.p) == r.n
