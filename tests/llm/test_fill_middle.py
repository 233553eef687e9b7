"""Fill-in-the-middle: cuts against a plain tokenisation, exact round trip."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketline.llm import fill_middle as fm

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def expected(doc, text):
    """(n, form, prefix chars, middle chars, output) by listing the units."""
    text = text or ""
    digits = hashlib.sha256(f"1:{'null' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i:i + 8], 16) for i in (0, 8, 16, 24))
    units = UNIT.findall(text)
    n = len(units)
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_transform_and_restore(spark):
    texts = [None, "", "a", "Word word", "é ü   x\x00y", "no <P> here", "a<S", "<P", "x<", "<<<P", "1234", "\n\n", "日本語 text 😀😀", "a" * 100_000,
             "word, " * 40_000, "😀" * 5_000, "tail é"]
    rows = [(i, t) for i in range(60) for t in texts] + [(None, "no id é"), (3, "again again"), (3, "again again")]
    df = spark.createDataFrame([(*r, "kept") for r in rows], "doc_id long, text string, output string").repartition(5)
    out = fm.transform(df).withColumn("back", fm.restore(F.col("fim.output"), F.col("fim.form"))).collect()
    assert len(out) == len(rows)
    forms = set()
    for r in out:
        f = r["fim"]
        assert tuple(f) == expected(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "") and r["output"] == "kept"
        forms.add(f["form"])
    assert forms == {"plain", "psm", "spm"}
    assert fm.transform(df.limit(0)).count() == 0


def test_other_marks_and_rates(spark):
    df = spark.createDataFrame([(i, "one two <P> three") for i in range(50)], "doc_id long, text string")
    marks = ("<|pre|>", "<|suf|>", "<|mid|>")
    out = fm.transform(df, plain_percent=0, spm_percent=100, marks=marks).select(
        "fim.*", fm.restore(F.col("fim.output"), F.col("fim.form"), marks).alias("back")).collect()
    assert {r["form"] for r in out} == {"spm"} and {r["back"] for r in out} == {"one two <P> three"}
    with pytest.raises(ValueError):
        fm.transform(df, marks=("<a<", "<b>", "<c>"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aZ9 é< 😀", max_size=40), min_size=1, max_size=8))
def test_ranks_are_counts(texts):
    blobs = [t.encode() for t in texts]
    ends = np.cumsum([len(b) for b in blobs])
    starts = np.concatenate(([0], ends[:-1]))
    raw = np.frombuffer(b"".join(blobs), np.uint8)
    kinds = fm.classes(raw, starts)
    matrix = fm.WaveletMatrix(kinds, 2)
    at = np.arange(len(raw) + 1)
    for c in range(4):
        assert matrix.rank(c, at).tolist() == [int((kinds[:i] == c).sum()) for i in at]
    b = fm.Boundaries(raw, starts)
    assert (b.units(ends) - b.units(starts)).tolist() == [len(UNIT.findall(t)) for t in texts]
    for k in range(4):
        cuts = b.after(starts, ends, np.minimum(k, b.units(ends) - b.units(starts)))
        assert [blob[:c - s].decode() for blob, s, c in zip(blobs, starts, cuts)] == ["".join(UNIT.findall(t)[:k]) for t in texts]


def test_wavelet_matrix_of_more_levels():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 13, 1000).astype(np.uint8)
    m = fm.WaveletMatrix(symbols, 4)
    at = np.array([0, 1, 63, 64, 65, 500, 1000])
    for c in range(16):
        assert m.rank(c, at).tolist() == [int((symbols[:i] == c).sum()) for i in at]
