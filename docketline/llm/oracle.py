"""DuckDB SQL for the queries that SQL can express on whole tables."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A-Z lower-cased, then the words of the decontamination contract.
_BENCH_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_JOIN_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+')"

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, max(page_id) AS last_id FROM p GROUP BY h)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
  list_aggregate([list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(p.h, (g * 5 + 1)::BIGINT, 5))::INTEGER // k) % 32 + 1)::BIGINT, 1) for k in [32768, 1024, 32, 1]],
    'string_agg', '') for g in range(0, 8)], 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last_id THEN NULL ELSE last_id END AS refers_to
FROM p JOIN g ON p.h = g.h
"""

DECONTAMINATE = f"""
WITH b AS (SELECT item_id::VARCHAR AS item, {_BENCH_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n,
         unnest([array_to_string(w[i:i + 9], ' ') for i in range(1, greatest(len(w) - 9, 1) + 1)]) AS win
       FROM b WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_BENCH_WORDS} AS w FROM documents),
at_ AS (SELECT rid, s.n, unnest(range(1, len(w) - s.n + 2)) AS i, w FROM d, (SELECT DISTINCT n FROM bw) s WHERE len(w) >= s.n),
dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM at_),
hits AS (SELECT rid, item, i, dw.n FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
hw AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON d.rid = hw.rid LEFT JOIN it ON d.rid = it.rid
"""

LINE_FREQUENCY = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text FROM documents),
l AS (SELECT rid, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
      FROM d WHERE text IS NOT NULL),
t AS (SELECT rid, source, line, i, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS bare FROM l),
pages_ AS (SELECT source, count(*) AS total FROM d GROUP BY source),
c AS (SELECT source, bare, count(DISTINCT rid) AS n FROM t WHERE bare <> '' GROUP BY source, bare),
bad AS (SELECT c.source, c.bare FROM c JOIN pages_ p ON c.source IS NOT DISTINCT FROM p.source WHERE n >= 3 AND n > 0.05 * total),
m AS (SELECT t.*, bad.bare IS NULL AS keep FROM t LEFT JOIN bad ON t.source IS NOT DISTINCT FROM bad.source AND t.bare = bad.bare),
a AS (SELECT rid, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE keep), '') AS clean, count(*) AS n,
        count(*) FILTER (WHERE NOT keep) AS gone FROM m GROUP BY rid)
SELECT d.doc_id, d.source, a.clean AS text, coalesce(n, 0)::BIGINT AS n_lines, coalesce(gone, 0)::BIGINT AS n_dropped
FROM d LEFT JOIN a ON d.rid = a.rid
"""

def _linked_documents(k: int, percent: int, kept: str = "") -> str:
    """Components of documents whose sets of k-word shingles are similar."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {_JOIN_WORDS} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct([array_to_string(w[i:i + {k - 1}], ' ')
        for i in range(1, greatest(len(w) - {k - 1}, 1) + 1)]) END AS sh FROM d),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS shared
          FROM e x JOIN e y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pairs WHERE 100 * shared >= {percent} * (na + nb - shared)),
ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a)
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, min(reach.b) AS component_id{kept} FROM s JOIN reach ON s.doc_id = reach.a GROUP BY s.doc_id, sh
"""

SIGNATURE_TREE = _linked_documents(5, 75)
HYPER_MINHASH = _linked_documents(3, 85, ", s.doc_id = min(reach.b) AS kept")

FILL_MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, 'null')) AS x,
             regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w FROM documents),
h AS (SELECT doc_id, text, w, len(w)::BIGINT AS n, ('0x' || substr(x, 1, 8))::BIGINT AS h1, ('0x' || substr(x, 9, 8))::BIGINT AS h2,
        ('0x' || substr(x, 17, 8))::BIGINT AS h3, ('0x' || substr(x, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
s AS (SELECT doc_id, text, n, form, array_to_string(w[1:i], '') AS p, array_to_string(w[i + 1:j], '') AS m, array_to_string(w[j + 1:], '') AS t FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || t || '<M>' || m ELSE '<S>' || t || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM s
"""

ORACLE: dict[str, str] = {
    "op1_warc_normalise": WARC,
    "op4_decontaminate": DECONTAMINATE,
    "op5_line_frequency": LINE_FREQUENCY,
    "op9_signature_tree": SIGNATURE_TREE,
    "op12_hyper_minhash": HYPER_MINHASH,
    "op13_fill_middle": FILL_MIDDLE,
}
