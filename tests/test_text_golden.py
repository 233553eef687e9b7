"""Golden cases of the text rules (FIXTURES.md §3)."""

from conftest import one_col
from pyspark.sql import functions as F

from docketline.functions import text as T


def test_token_estimate_half_even(spark):
    out = one_col(spark, [5, 15, 25, 0, 2692, 2693], T.token_estimate, "x bigint")
    assert out == [6, 20, 32, 0, 3500, 3501]


def test_part_count(spark):
    out = one_col(spark, [0, 3500, 3501, 7001], T.part_count, "x bigint")
    assert out == [1, 1, 2, 3]


def test_split_words(spark):
    df = spark.createDataFrame([("a b c d e f g", 3), ("", 1), (" ".join(["w"] * 2693), 2)],
                               "t string, n int")
    out = df.select(T.split_words(T.words("t"), F.col("n")).alias("p")).collect()
    assert out[0].p == ["a b", "c d", "e f g"]
    assert out[1].p == [""]
    assert [len(x.split()) for x in out[2].p] == [1346, 1347]


def test_html_to_text(spark):
    out = one_col(spark, ["<p>A <b>b</b></p><p> c </p>", "x &amp;lt; y", None, "",
                          "<script>var t='</p>';</script><p>k</p><!-- c -->z"],
                  T.html_to_text)
    assert out == ["A b c", "x < y", "", "", "k z"]


def test_first_paragraph(spark):
    long = "x" * 81
    out = one_col(spark, ["<p> </p><p>Hello <b>World</b></p>", f"<p>{'y' * 80}</p>",
                          f"<p>{long}</p>", None, "no paragraph"], T.first_paragraph)
    assert out == ["HelloWorld", "y" * 80, "x" * 80 + "...", "-", "-"]


def test_is_upper(spark):
    out = one_col(spark, ["MRI REPORT 2", "123", "-", "Mri"], T.is_upper)
    assert out == [True, False, False, False]


def test_epoch_millis(spark):
    df = spark.createDataFrame([(1700000000123,)], "ms bigint")
    r = df.select(F.date_format(T.epoch_millis_to_ts("ms"), "yyyy-MM-dd HH:mm:ss.SSS")).first()[0]
    assert r == "2023-11-14 22:13:20.123"


def test_extract_bullets(spark):
    out = one_col(spark, ["intro\n\n  - x\n • y\n1. z", "1. a\n2. b", "*nospace", "**bold** x",
                          "*\n next"], T.extract_bullets)
    assert out == ["AI Summary\n\n\n  - x\n\n • y", "Inconclusive Response", "Inconclusive Response",
                   "Inconclusive Response", "AI Summary\n*\n next"]


def test_clean_response(spark):
    out = one_col(spark, ["AI Summary\n* a\n\n* b",
                          "x\n - y\nBrewChat z\n BrewChat q\n<XML>\nâ€¢ k\n",
                          "** handwritten **"], T.clean_response)
    assert out == ["AI Summary\n\t* a\n\t* b", "x\n\t* y\n\tBrewChat q\n\t* k", "** handwritten **"]


def test_format_html(spark):
    df = spark.createDataFrame([
        ("-\nAI Summary\n\t* Pain 2019.\n\t* Surgery.", "report.v2.pdf"),
        ("MRI REPORT\n** handwritten **", "scan.pdf"),
        ("AI SUMMARY: X", "a.pdf"),
        ("-\nAI Summary", "a.pdf"), (None, "a.pdf"), ("   ", "a.pdf")], "r string, s string")
    out = [r[0] for r in df.select(T.format_html("r", "s")).collect()]
    assert out == [
        "<header><h2>report.v2</h2></header><ul><li>Pain 2019.</li><li>Surgery.</li></ul>",
        "<header><h2>scan</h2></header><ul><li>MRI REPORT</li><li>handwritten **</li></ul>",
        "<header><h2>a</h2></header><ul><li>AI SUMMARY: X</li></ul>", "", "", ""]


def test_file_stem(spark):
    out = one_col(spark, ["report.v2.pdf", ".env", "archive", "a.b/c", "a..b", "report."], T.file_stem)
    assert out == ["report.v2", ".env", "archive", "a.b/c", "a.", "report"]


def test_review_flag(spark):
    out = one_col(spark, ["Inconclusive ... HANDWRITTEN", "** handwritten **", "fine"], T.review_flag)
    assert out == ["red", "yellow", None]


def test_sse_fold(spark):
    from docketline.operators.inference import sse_fold
    lines = ['data: {"content":"a"}', "data: [DONE]", 'data: {"x":1}', 'data: {"content":" b"}']
    df = spark.createDataFrame([("r1", i, x) for i, x in enumerate(lines)] + [("r2", 0, "data: [DONE]")],
                               "request_id string, chunk_no int, line string")
    out = {r.request_id: r.response for r in sse_fold(df).collect()}
    assert out == {"r1": "a b", "r2": "Error: No content extracted"}
