"""Physical plan checks: lookups are broadcast, no Python evaluation in the
native pipeline, no single-partition exchange, filters and column pruning
reach the Parquet scan."""

from conftest import SF01

from docketline.plans.queries import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_is_broadcast(spark):
    p = plan(QUERIES["lookup_description"](spark, SF01))
    assert "BroadcastHashJoin" in p


def _python_nodes(p: str) -> list[tuple[str, str]]:
    """(Python node line, its subtree down to the first scan) per Python node."""
    lines = p.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "EvalPython" in line:
            depth = line.index("+-")
            below = []
            for nxt in lines[i + 1:]:
                if "+-" in nxt and nxt.index("+-") <= depth:
                    break
                below.append(nxt)
                if "FileScan" in nxt:
                    break
            out.append((line, "\n".join(below)))
    return out


def test_pipeline_has_no_python_and_no_single_partition(spark):
    """No row-at-a-time Python anywhere; the one Arrow UDF allowed is the
    exact first-paragraph path, and only on the rows routed to it (a
    null filter on the routed HTML sits right below it)."""
    for name in ("courtbook_rows", "chronology_payload", "change_detect", "resubmit_reject"):
        p = plan(QUERIES[name](spark, SF01))
        assert "BatchEvalPython" not in p, name
        for node, below in _python_nodes(p):
            assert "ArrowEvalPython [first_paragraph_exact(" in node, (name, node)
            assert "Filter" in below and "isnotnull(_exact_html" in below, (name, below)
        assert "SinglePartition" not in p, name


def test_filter_pushed_to_scan(spark):
    p = plan(QUERIES["incremental_anti"](spark, SF01))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)]" in p


def test_column_pruning(spark):
    p = plan(QUERIES["token_estimate"](spark, SF01))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_entries_parsed_once(spark):
    """The JSON object test must not be pushed below the parse as a second
    parse (a ``where`` on the parsed VARIANT would be)."""
    from docketline.sources import fixtures as fx
    from docketline.sources.readers import parse_entries
    p = plan(parse_entries(fx.entry_json(spark, SF01)))
    assert p.count("parseJson") == 1, p


def test_part_table_scans_each_response_once(spark):
    """Status and bullets of a response come from one regexp_extract_all."""
    p = plan(QUERIES["part_table"](spark, SF01))
    assert p.count("regexp_extract_all") == 1, p


def test_only_small_scans_are_dealt_out(spark):
    """A scan with fewer full-size splits than cores gets an exchange, a larger one doesn't."""
    p = plan(QUERIES["html_to_text"](spark, SF01))
    assert "REPARTITION_BY_NUM" in p and "ReadSchema: struct<page_id:bigint,html:string>" in p
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert "Exchange" not in plan(QUERIES["html_to_text"](spark, SF01))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_payload_join_carries_no_second_text(spark):
    """The entry's final text is in ``raw`` or replaced: it isn't exchanged beside it."""
    from docketline.plans.queries import _run
    run = _run(spark, SF01)
    for df in (run.payload, run.delta):
        plan = df._jdf.queryExecution().executedPlan().toString()
        read = [x for x in plan.split("ReadSchema: ")[1:] if x.startswith("struct<court_book_id:string,line_id:string")]
        assert read and not any("entry_final_html" in x.partition(">")[0] for x in read)
