"""Registration, SQL oracles, and cases every operator must take."""

import pytest
from conftest import SF001, SF01
from oracle_compare import compare, duck

import __spark_entry__ as entry
import corpus_pipeline
from docketline.llm import decontaminate, line_frequency, packing, pii_bootstrap, repetition, rule_ensemble, signature_tree, url_filter, warc
from docketline.llm import masked_lm
from docketline.llm.queries import ORACLE, QUERIES, tokenizer_file


def test_one_query_an_operator():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    r = compare(spark, duck(SF01), name, QUERIES[name], ORACLE[name], SF01)
    assert r["hash_ok"], r


LONG = "word " * 30_000 + "x" * 50_000
ROWS = [(1, None, "s"), (2, "", "s"), (3, " \n\t \n", None), (4, LONG, "s"), (5, "same text here\nsame text here", "s"),
        (5, "same text here\nsame text here", "s"), (None, "a text without an id", None), (7, "é ü \u2028 x\x00y", "t")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, clashing columns."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return df.selectExpr("*", "1 as n_words", "'x' as scan", "2 as stats", "3 as measures", "4 as boilerplate_lines", "5 as leader_id", "6 as hits")


def bench(spark, rows=((1, "same text here"), (2, None), (None, "without an id"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def labels(spark, rows=((1, 0), (2, 0), (4, 1), (5, 1), (7, 1), (7, None))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int")


FILTERS = {
    "decontaminate": lambda s, d: decontaminate.decontaminate(d, bench(s)),
    "decontaminate spans": lambda s, d: decontaminate.decontaminate(d, bench(s), mode="spans"),
    "decontaminate no items": lambda s, d: decontaminate.decontaminate(d, bench(s).limit(0)),
    "lines": lambda s, d: line_frequency.drop_boilerplate(d, "source"),
    "repetition": lambda s, d: repetition.repetition_filter(d),
    "quality": lambda s, d: rule_ensemble.quality_filter(d, labels(s)),
    "near copies": lambda s, d: signature_tree.drop_near_copies(d),
}
TABLES = {
    "packing": lambda s, d: packing.pack(d, tokenizer_file()),
    "components": lambda s, d: signature_tree.link_components(d),
    "scores": lambda s, d: masked_lm.score(d, rounds=1),
    "pii": lambda s, d: pii_bootstrap.extract(d),
    "quality table": lambda s, d: rule_ensemble.score_table(d, labels(s)),
}


@pytest.mark.parametrize("name", sorted(FILTERS))
def test_filters_take_odd_rows(spark, odd, name):
    out = FILTERS[name](spark, odd)
    assert out.columns == odd.columns
    kept = {r["doc_id"] for r in out.collect()}
    assert kept <= {r[0] for r in ROWS}
    assert FILTERS[name](spark, odd.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(TABLES))
def test_tables_take_odd_rows(spark, odd, name):
    rows = TABLES[name](spark, odd).collect()
    if name != "packing":
        assert len(rows) == len(ROWS)
    assert TABLES[name](spark, odd.limit(0)).count() == 0


def test_odd_rows_have_defined_results(spark, odd):
    kept = decontaminate.decontaminate(odd, bench(spark)).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"]) == [1, 2, 3, 4, 7]  # the hit ones, and the one without id, go
    spans = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(odd, bench(spark), mode="spans").collect()}
    assert spans[5] == "" and spans[None] == "a text " and spans[1] is None and spans[4] == LONG
    comp = [(r["id"], r["n"], r["component"]) for r in signature_tree.link_components(odd).collect()]
    assert {c for c in comp if c[0] in (1, 2, 3)} == {(1, 0, 1), (2, 0, 2), (3, 0, 3)}
    assert comp.count((5, 2, 5)) == 2
    assert sorted(r["doc_id"] or 0 for r in signature_tree.drop_near_copies(odd).collect()) == [0, 1, 2, 3, 4, 5, 7]
    lm = {r["id"]: r for r in masked_lm.score(odd, rounds=1).collect()}
    assert lm[1]["n_tokens"] == 0 and lm[1]["mean_log_prob"] is None and lm[5]["n_tokens"] == 6


def test_url_filter_takes_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://a.net"), (4, "http://a.net/"), (5, "x://" + "h" * 50_000 + "/p?q")]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as judged_", "2 as url_parts")
    out = url_filter.judge(df).collect()
    by = {(r["page_id"], r["url"]): r["judged"] for r in out}
    assert by[(1, None)]["host"] == "" and by[(3, "no scheme")]["path"] == ""
    assert by[(4, "http://a.net")]["rule"] is None and by[(4, "http://a.net/")]["rule"] == "net/"
    assert url_filter.judge(df.limit(0)).count() == 0


def test_warc_takes_odd_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "a b\r\nX: y", "é"), (3, "again", "é"), (None, "n", "é"), (9, "v", "é" * 100_000)]
    index = warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = sorted((r["record_type"], r["record_id"], r["refers_to"] or "") for r in index.collect())
    assert got == [("response", "urn:page:2", ""), ("response", "urn:page:3", ""), ("response", "urn:page:3", ""), ("response", "urn:page:9", ""),
                   ("revisit", "urn:page:1", "urn:page:2"), ("revisit", "urn:page:null", "urn:page:3")]
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    first = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = warc.materialize(stage(spark, docs, SF01), "test-stage")
        if k < 4:
            assert docs.columns == first.columns
            assert 0.8 * before.count() < docs.count() <= before.count()
        if name == "n-gram Jaccard join":
            again = signature_tree.link_components(docs)
            assert again.where("id != component").count() == 0
            groups = signature_tree.link_components(before).where("n > 0").select("component").distinct().count()
            assert docs.count() == groups + before.where("length(trim(text)) = 0 or text is null").count()
        if name == "benchmark decontamination":
            assert decontaminate.scan(docs, spark.read.parquet(f"{SF01}/benchmark.parquet")).where("scan.n_hit > 0").count() == 0
    assert docs.selectExpr("sum(length)").first()[0] > 0


def test_queries_cover_whole_tables(spark):
    n = spark.read.parquet(f"{SF001}/documents.parquet").count()
    for name in ("op2_quality_rules", "op6_repetition", "op10_pii_bootstrap", "op3_masked_lm"):
        assert QUERIES[name](spark, SF001).count() == n
