"""DuckDB oracle SQL for the registered queries.

Each query is written from the base tables with CTEs that restate the
fixture views and pipeline stages in SQL, so the oracle does not share any
Spark code path; only the text-rule constants (patterns, word lists) are
shared through ``docketline.plans.sqlexpr``.
"""

from __future__ import annotations

from docketline.functions import text as T
from docketline.plans import queries as Q
from docketline.plans import sqlexpr as S
from docketline.sources import fixtures as fx

# --- views ------------------------------------------------------------------

ENTRIES = f"""
entries AS (
  SELECT d.source AS court_book_id, d.doc_id AS pos, CAST(d.doc_id AS VARCHAR) AS line_id,
         CAST(d.doc_id * {fx.ITEM_ID_FACTOR} AS VARCHAR) AS book_item_id,
         CASE l.toxic WHEN 1 THEN ' TRUE ' WHEN 0 THEN 'false' END AS handwritten_raw,
         CASE l.quality WHEN 1 THEN 'Relevant' WHEN 0 THEN 'relevant' END AS relevant_raw,
         CAST(CASE WHEN l.quality IS NOT NULL
              THEN {fx.ENTRY_EPOCH_MS} + d.doc_id * {fx.ENTRY_STEP_MS} ELSE 0 END AS BIGINT) AS entry_date_ms,
         TRUE AS entry_date_valid,
         {S.html_paragraphs('d.text')} AS entry_original_html,
         {S.html_paragraphs('d.text')} AS entry_final_html,
         d.lang, d.n_chars, l.quality IS NOT NULL AS labelled
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
),
entries_n AS (
  SELECT *, lower({S.strip("coalesce(handwritten_raw, '')")}) AS handwritten,
         {S.strip("coalesce(relevant_raw, '')")} AS relevant
  FROM entries
),
entries_r AS (
  SELECT *, CASE WHEN handwritten = 'true' THEN 'bypass'
                 WHEN handwritten = 'false' AND relevant = 'Relevant' THEN 'summarise'
                 ELSE 'drop' END AS route
  FROM entries_n
)"""

ITEMS = """
items_all AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS description, 0 AS batch, p_partkey AS seq FROM part
  UNION ALL
  SELECT CAST(s_suppkey AS VARCHAR), s_name, 1, s_suppkey FROM supplier
),
items_last AS (
  SELECT id, description FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY batch DESC, seq DESC) AS rn FROM items_all)
  WHERE rn = 1
)"""


def rows_cte(limit: int = T.TOKEN_LIMIT) -> str:
    return f"""
e2 AS (
  SELECT e.*, CASE WHEN it.id IS NOT NULL THEN it.description ELSE '-' END AS book_item_description,
         {S.html_to_text('e.entry_original_html')} AS entry_text,
         {S.html_to_text('e.entry_final_html')} AS entry_modified,
         {S.first_paragraph("coalesce(e.entry_final_html, '')")} AS first_line
  FROM entries_r e LEFT JOIN items_last it ON e.book_item_id = it.id
  WHERE e.route <> 'drop'
),
e3 AS (SELECT *, {S.words('entry_text')} AS w, {S.entry_description('first_line')} AS entry_description FROM e2),
e4 AS (SELECT *, CAST(len(w) AS BIGINT) AS n_words, {S.token_estimate('len(w)')} AS tokens FROM e3),
e5 AS (SELECT *, CAST(CASE WHEN route = 'bypass' THEN 1 ELSE {S.part_count('tokens', limit)} END AS BIGINT) AS n_parts
       FROM e4),
e6 AS (SELECT *, CAST(coalesce(sum(n_parts) OVER (PARTITION BY court_book_id ORDER BY pos
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS base FROM e5),
e7 AS (SELECT *, unnest(range(n_parts)) AS part_idx FROM e6),
rows AS (
  SELECT CAST(base + part_idx AS BIGINT) AS "index",
         {S.entry_uid('court_book_id', 'line_id', 'pos')} AS unique_id,
         'Part ' || CAST(part_idx + 1 AS VARCHAR) || '/' || CAST(n_parts AS VARCHAR) AS part,
         first_line, handwritten, relevant, court_book_id, book_item_id, line_id,
         book_item_description, {S.py_datetime_str('epoch_ms(entry_date_ms)')} AS entry_date,
         CAST(CASE WHEN route = 'bypass' THEN NULL ELSE 1 END AS INTEGER) AS prompt_id,
         CASE WHEN route = 'bypass' THEN entry_text ELSE {S.part_text('w', 'n_parts', 'part_idx')} END
           AS entry_original,
         entry_modified,
         CAST(CASE WHEN route = 'bypass' THEN 0 ELSE tokens END AS BIGINT) AS token_count,
         entry_description, route, pos, CAST(part_idx + 1 AS BIGINT) AS part_no, n_parts
  FROM e7
)"""


PROMPTED = f"""
prompts AS (SELECT CAST(item_id AS INTEGER) AS prompt_id, text AS prompt_text FROM benchmark),
prompted AS (
  SELECT r.*, CASE WHEN p.prompt_id IS NOT NULL THEN p.prompt_text ELSE {S.lit(T.DEFAULT_PROMPT)} END AS prompt_text
  FROM rows r LEFT JOIN prompts p ON r.prompt_id = p.prompt_id
),
requests AS (
  SELECT *, sha256(CAST(length(coalesce(prompt_text, '')) AS VARCHAR) || ':' || coalesce(prompt_text, '')
                   || coalesce(entry_original, '')) AS request_hash
  FROM prompted WHERE route = 'summarise'
)"""


def sentence_bullets(x: str) -> str:
    return (f"('* ' || regexp_replace({S.strip(f'coalesce({x}, {chr(39)}{chr(39)})')}, "
            f"{S.rx('([.!?])' + T.WS + '+')}, '\\1' || chr(10) || '* ', 'g'))")


PARTS = f"""
scored AS (
  SELECT *, CASE WHEN route = 'summarise' THEN {sentence_bullets('entry_original')} END AS raw_response
  FROM prompted
),
parts AS (
  SELECT court_book_id, "index", CAST(floor("index" / 50) + 1 AS BIGINT) AS batch_no, unique_id, line_id,
         book_item_description AS source_doc, part AS part_no, entry_date, entry_description, entry_original,
         CASE WHEN route = 'bypass' THEN {S.lit(T.HANDWRITTEN_RESPONSE)}
              WHEN raw_response IS NULL OR raw_response = '' THEN 'Error: No response received'
              ELSE {S.extract_bullets('raw_response')} END AS response,
         handwritten, '{Q.RUN_TS}' AS time_processed,
         CASE WHEN route = 'bypass' THEN 'handwritten'
              WHEN raw_response IS NULL OR raw_response = '' OR starts_with(raw_response, 'Error') THEN 'error'
              WHEN len(regexp_extract_all(raw_response, {S.rx(T.BULLETS_RX)})) > 0 THEN 'summary'
              ELSE 'inconclusive' END AS status
  FROM scored
)"""

SHEET = f"""
cparts AS (SELECT *, {S.strip(S.described_response('entry_description', 'response'))} AS sresp FROM parts),
sheet AS (
  SELECT court_book_id, min("index") AS first_index,
         arg_min(source_doc, "index") FILTER (WHERE source_doc IS NOT NULL) AS source_doc,
         arg_min(entry_date, "index") FILTER (WHERE entry_date IS NOT NULL) AS entry_date,
         arg_min(entry_original, "index") FILTER (WHERE entry_original IS NOT NULL) AS entry_original,
         chr(10) || regexp_replace(coalesce(string_agg(sresp, chr(10) ORDER BY "index"), ''), '\\A\\n+', '')
           AS response,
         arg_min(handwritten, "index") FILTER (WHERE handwritten IS NOT NULL) AS handwritten,
         arg_min(time_processed, "index") FILTER (WHERE time_processed IS NOT NULL) AS time_processed,
         arg_min(line_id, "index") FILTER (WHERE line_id IS NOT NULL) AS line_id
  FROM cparts GROUP BY court_book_id, unique_id
)"""

EXTRACT = f"""
extract AS (
  SELECT court_book_id, line_id, {S.format_html('response', 'source_doc')} AS response, first_index FROM sheet
),
latest AS (
  SELECT court_book_id, line_id, response FROM (
    SELECT *, row_number() OVER (PARTITION BY court_book_id, line_id ORDER BY first_index DESC) AS rn
    FROM extract) WHERE rn = 1
),
merged AS (
  SELECT e.*, l.line_id IS NOT NULL AS matched,
         CASE WHEN l.line_id IS NOT NULL THEN l.response ELSE e.entry_final_html END AS entry_final
  FROM entries e LEFT JOIN latest l ON e.court_book_id = l.court_book_id AND e.line_id = l.line_id
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


PIPE = (ENTRIES, ITEMS, rows_cte(), PROMPTED)

RESPONSES = """
responses AS (
  SELECT conv_id, turn, role,
         CASE WHEN role = 'assistant' THEN replace(text, chr(10), chr(10) || '* ') ELSE text END AS response
  FROM conversations
)"""

CHUNKS = """
chunks AS (
  SELECT CAST(conv_id AS VARCHAR) AS request_id, turn AS chunk_no,
         'data: ' || CASE WHEN role = 'assistant' THEN json_object('content', text)::VARCHAR ELSE text END AS line
  FROM conversations
)"""

WORK = """
worklist AS (SELECT o_orderkey AS line_no, CAST(o_custkey AS VARCHAR) AS ID FROM orders),
ledger AS (SELECT CAST(c_custkey AS VARCHAR) AS ID FROM customer WHERE c_mktsegment = 'BUILDING')"""


def _split_sql(limit: int) -> str:
    return with_(ENTRIES, ITEMS, rows_cte(limit)) + f"""
SELECT court_book_id, line_id, part_no, n_parts, CAST(len({S.words('entry_original')}) AS BIGINT) AS part_words,
       entry_original
FROM rows WHERE route = 'summarise'"""


ORACLE: dict[str, str] = {
    "token_estimate": f"""
SELECT doc_id, CAST(len({S.words('text')}) AS BIGINT) AS n_words,
       {S.token_estimate(f"len({S.words('text')})")} AS tokens,
       {S.part_count(S.token_estimate(f"len({S.words('text')})"))} AS n_parts
FROM documents""",
    "split_parts": _split_sql(T.TOKEN_LIMIT),
    "split_parts_300": _split_sql(Q.SMALL_TOKEN_LIMIT),
    "html_to_text": f"SELECT page_id, {S.html_to_text('html')} AS text FROM pages",
    "entry_description": with_(ENTRIES) + f"""
SELECT court_book_id, line_id, {S.first_paragraph("coalesce(entry_final_html, '')")} AS first_line,
       {S.entry_description(S.first_paragraph("coalesce(entry_final_html, '')"))} AS entry_description
FROM entries""",
    "file_stem": f"SELECT page_id, {S.file_stem('url')} AS stem FROM pages",
    "entries_explode": with_(ENTRIES) + """
SELECT court_book_id, pos, line_id, book_item_id, handwritten_raw, relevant_raw, entry_date_ms, entry_date_valid
FROM entries""",
    "entry_arrays": with_(ENTRIES) + f"""
SELECT court_book_id, row_number() OVER (PARTITION BY court_book_id, pos // {fx.FILE_IDS} ORDER BY pos) - 1 AS pos, line_id, book_item_id,
       handwritten_raw, relevant_raw, entry_date_ms, entry_date_valid
FROM entries""",
    "array_recovery": with_(ENTRIES) + f"""
SELECT court_book_id, line_id, book_item_id, sha256(entry_original_html) AS html_sha256
FROM entries WHERE pos % {fx.SPOILED[0]} <> {fx.SPOILED[1]}""",
    "entry_lines": with_(ENTRIES) + f"""
, numbered AS (SELECT court_book_id, line_id, row_number() OVER (PARTITION BY court_book_id, pos // {fx.FILE_IDS} ORDER BY pos) - 1 AS pos FROM entries)
SELECT court_book_id, line_id, pos, {S.entry_uid('court_book_id', 'line_id', 'pos')} AS unique_id FROM numbered""",
    "json_quarantine": with_(CHUNKS) + f"""
SELECT request_id, chunk_no FROM chunks
WHERE NOT {S.is_json_object("regexp_replace(line, '^data: ', '')")}""",
    "normalize_flags": with_(ENTRIES) + "\nSELECT court_book_id, line_id, handwritten, relevant FROM entries_n",
    "route_entries": with_(ENTRIES) + "\nSELECT court_book_id, line_id, route FROM entries_r",
    "entry_date": with_(ENTRIES) + f"""
SELECT court_book_id, line_id, {S.py_datetime_str('epoch_ms(entry_date_ms)')} AS entry_date, entry_date_valid
FROM entries""",
    "entry_uid": with_(ENTRIES) + f"""
SELECT court_book_id, line_id, {S.entry_uid('court_book_id', 'line_id', 'pos')} AS unique_id FROM entries""",
    "last_wins": with_(ITEMS) + "\nSELECT id, description FROM items_last",
    "lookup_description": with_(ENTRIES, ITEMS) + """
SELECT e.court_book_id, e.line_id, e.book_item_id,
       CASE WHEN it.id IS NOT NULL THEN it.description ELSE '-' END AS book_item_description,
       it.id IS NOT NULL AS matched
FROM entries e LEFT JOIN items_last it ON e.book_item_id = it.id""",
    "prompt_lookup": with_(*PIPE) + "\nSELECT court_book_id, line_id, part, CAST(prompt_id AS VARCHAR) AS prompt_id, prompt_text FROM prompted",
    "courtbook_rows": with_(ENTRIES, ITEMS, rows_cte()) + """
SELECT "index", unique_id, part, first_line, handwritten, relevant, court_book_id, book_item_id, line_id,
       book_item_description, entry_date, CAST(prompt_id AS VARCHAR) AS prompt_id, entry_original, entry_modified, token_count,
       entry_description
FROM rows""",
    "batch_manifest": with_(ENTRIES, ITEMS, rows_cte()) + """,
b AS (SELECT *, CAST(floor("index" / 50) + 1 AS BIGINT) AS batch_no FROM rows),
per_batch AS (SELECT court_book_id, batch_no, min("index") + 1 AS first_record, max("index") + 1 AS last_record,
                     count(*) AS n_rows FROM b GROUP BY 1, 2),
per_book AS (SELECT court_book_id, count(*) AS total_records, CAST(ceil(count(*) / 50.0) AS BIGINT) AS n_batches
             FROM b GROUP BY 1)
SELECT p.court_book_id, batch_no, first_record, last_record, n_rows, total_records, n_batches
FROM per_batch p JOIN per_book k ON p.court_book_id = k.court_book_id""",
    "request_table": with_(*PIPE) + '\nSELECT court_book_id, line_id, "index", CAST(prompt_id AS VARCHAR) AS prompt_id, request_hash FROM requests',
    "request_dedup": with_(*PIPE) + "\nSELECT request_hash, count(*) AS n_rows FROM requests GROUP BY 1",
    "sse_fold": with_(CHUNKS) + f""",
c AS (SELECT request_id, chunk_no, {S.sse_content('line')} AS content FROM chunks),
f AS (SELECT request_id, string_agg(content, '' ORDER BY chunk_no) AS txt FROM c GROUP BY 1)
SELECT request_id, CASE WHEN coalesce(txt, '') = '' THEN {S.lit(T.NO_CONTENT_RESPONSE)}
                        ELSE {S.strip('txt')} END AS response
FROM f""",
    "bullet_extract": with_(RESPONSES) + f"\nSELECT conv_id, turn, {S.extract_bullets('response')} AS response FROM responses",
    "response_status": with_(RESPONSES) + f"""
SELECT conv_id, turn,
       CASE WHEN response IS NULL OR response = '' OR starts_with(response, 'Error') THEN 'error'
            WHEN len(regexp_extract_all(response, {S.rx(T.BULLETS_RX)})) > 0 THEN 'summary'
            ELSE 'inconclusive' END AS status
FROM responses""",
    "clean_response": with_(RESPONSES) + f"""
SELECT conv_id, turn, {S.clean_response(S.extract_bullets('response'))} AS cleaned,
       {S.described_response('upper(role)', S.extract_bullets('response'))} AS described
FROM responses""",
    "recombine_parts": with_(RESPONSES) + f"""
SELECT conv_id, arg_min(role, turn) FILTER (WHERE role IS NOT NULL) AS entry_role, min(turn) AS first_turn,
       chr(10) || regexp_replace(coalesce(string_agg({S.strip('response')}, chr(10) ORDER BY turn), ''),
                                 '\\A\\n+', '') AS response
FROM responses GROUP BY conv_id""",
    "part_table": with_(*PIPE, PARTS) + "\nSELECT * FROM parts",
    "parts_scan": with_(*PIPE, PARTS) + """
SELECT court_book_id, batch_no, count(*) AS n_rows, min("index") AS first_index, max("index") AS last_index,
       TRUE AS n_files_ok
FROM parts GROUP BY 1, 2""",
    "union_parts": with_(*PIPE, PARTS) + "\nSELECT court_book_id, status, count(*) AS n_rows FROM parts GROUP BY 1, 2",
    "chronology_sheet": with_(*PIPE, PARTS, SHEET) + "\nSELECT * FROM sheet",
    "review_flag": with_(*PIPE, PARTS, SHEET) + f"\nSELECT court_book_id, line_id, {S.review_flag('response')} AS review_flag FROM sheet",
    "format_html": with_(*PIPE, PARTS, SHEET, EXTRACT) + "\nSELECT * FROM extract",
    "merge_back": with_(*PIPE, PARTS, SHEET, EXTRACT) + "\nSELECT court_book_id, line_id, matched, entry_final FROM merged",
    "writeback_delta": with_(*PIPE, PARTS, SHEET, EXTRACT) + f"""
SELECT court_book_id, line_id, '{Q.RUN_ID}' AS run_id, entry_final FROM merged WHERE matched""",
    "write_back_runs": with_(*PIPE, PARTS, SHEET, EXTRACT) + f"""
SELECT court_book_id, line_id, '{Q.RUN_ID}' AS run_id, entry_final FROM merged WHERE matched""",
    "run_events": with_(ENTRIES) + f"""
SELECT '{Q.RUN_ID}' AS run_id, 'route' AS stage, metric, value FROM (
  SELECT 'rows' AS metric, count(*) AS value FROM entries_r
  UNION ALL SELECT m.metric, count(*) FILTER (WHERE route = m.metric) FROM entries_r, (VALUES ('bypass'), ('summarise'), ('drop')) m(metric) GROUP BY m.metric)""",
    "column_width_profile": with_(*PIPE, PARTS, SHEET) + ",\nprof AS (\n" + "\n  UNION ALL\n".join(
        f"  SELECT court_book_id, '{chr(65 + i)}' AS column_letter, '{disp}' AS column_name, "
        f"max(length({col})) AS max_len FROM sheet GROUP BY court_book_id"
        for i, (col, disp) in enumerate(zip(
            ["source_doc", "entry_date", "entry_original", "response", "handwritten", "time_processed",
             "line_id"],
            ["Source Doc", "EntryDate", "EntryOriginal", "Response", "Handwritten", "TimeProcessed",
             "LineID"]))) + """)
SELECT court_book_id, column_letter, column_name,
       CAST(CASE column_letter WHEN 'C' THEN 30 WHEN 'D' THEN 100
            ELSE greatest(length(column_name), coalesce(max_len, 0)) + 2 END AS BIGINT) AS width
FROM prof""",
    "chronology_payload": with_(*PIPE, PARTS, SHEET, EXTRACT) + """
SELECT court_book_id, line_id,
       '{"id":' || line_id || ',"courtBookId":' || to_json(court_book_id)
       || ',"bookItemId":' || book_item_id
       || CASE WHEN handwritten_raw IS NOT NULL THEN ',"handwritten":' || to_json(handwritten_raw) ELSE '' END
       || CASE WHEN relevant_raw IS NOT NULL THEN ',"relevant":' || to_json(relevant_raw) ELSE '' END
       || CASE WHEN labelled THEN ',"entryDate":' || CAST(entry_date_ms AS VARCHAR) ELSE '' END
       || ',"entryOriginal":' || to_json(entry_original_html)
       || CASE WHEN NOT matched AND entry_final_html IS NOT NULL THEN ',"entryFinal":' || to_json(entry_final_html) ELSE '' END
       || CASE WHEN lang IS NOT NULL THEN ',"lang":' || to_json(lang) ELSE '' END
       || CASE WHEN n_chars IS NOT NULL THEN ',"nChars":' || CAST(n_chars AS VARCHAR) ELSE '' END
       || CASE WHEN matched THEN ',"entryFinal":' || coalesce(to_json(entry_final), 'null') ELSE '' END || '}' AS payload
FROM merged""",
    "worklist_scan": with_(WORK) + "\nSELECT line_no, ID FROM worklist WHERE ID IS NOT NULL AND ID <> ''",
    "incremental_anti": with_(WORK) + "\nSELECT line_no, ID FROM worklist WHERE ID NOT IN (SELECT ID FROM ledger)",
    "incremental_bucketed": with_(WORK) + "\nSELECT line_no, ID FROM worklist WHERE ID NOT IN (SELECT ID FROM ledger)",
    "incremental_semi": with_(WORK) + "\nSELECT line_no, ID FROM worklist WHERE ID IN (SELECT ID FROM ledger)",
    "worklist_except": with_(WORK) + "\nSELECT ID FROM worklist EXCEPT SELECT ID FROM ledger",
    "first_pending": with_(WORK) + """
, dated AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS list_id, o_orderkey AS line_no, CAST(o_custkey AS VARCHAR) AS ID FROM orders)
SELECT list_id, line_no, ID FROM dated WHERE ID NOT IN (SELECT ID FROM ledger)
QUALIFY row_number() OVER (PARTITION BY list_id ORDER BY line_no, ID) = 1""",
    "job_status": """
WITH asked AS (SELECT CAST(o_custkey AS VARCHAR) AS ID, count(*) AS submissions, max(o_orderdate) AS last FROM orders GROUP BY 1),
ended AS (SELECT CAST(o_custkey AS VARCHAR) AS ID, max(o_orderdate) AS ended FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT ID, submissions, strftime(last, '%Y-%m-%d %H:%M:%S') AS last_submitted,
       CASE WHEN ended IS NULL THEN 'pending' WHEN ended >= last THEN 'done' ELSE 'again' END AS status
FROM asked LEFT JOIN ended USING (ID)""",
    "sheet_strings": with_(*PIPE, PARTS, SHEET) + """
SELECT nullif(CAST(COLUMNS(*) AS VARCHAR), '') FROM sheet""",
    "change_detect": """
WITH w AS (SELECT CAST(user_id AS VARCHAR) AS path, ts, event_id, md5(event_type) AS md5 FROM events),
p AS (SELECT *, last_value(md5 IGNORE NULLS) OVER (PARTITION BY path ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
             row_number() OVER (PARTITION BY path ORDER BY ts, event_id) AS rn FROM w)
SELECT path, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, md5 FROM p
WHERE rn > 1 AND md5 IS NOT NULL AND (prev IS NULL OR md5 <> prev)""",
    "resubmit_reject": """
WITH s AS (SELECT event_type AS queue, ts, event_id, CAST(user_id AS VARCHAR) AS ID FROM events),
p AS (SELECT *, last_value(ID IGNORE NULLS) OVER (PARTITION BY queue ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_id FROM s)
SELECT queue, event_id, ID, coalesce(ID <> prev_id, TRUE) AS accepted FROM p""",
    "log_parse": """
SELECT event_id AS line_no, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type || ' ' || props AS message
FROM events""",
    "log_tail": f"""
SELECT event_id AS line_no, '[' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '] ' || event_type || ' ' || props AS line
FROM events ORDER BY event_id DESC LIMIT {Q.LOG_TAIL_LINES}""",
}
