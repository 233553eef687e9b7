"""DuckDB SQL forms of the text rules, for the oracle queries.

Each helper returns an SQL expression string over the given SQL operands. The
patterns and texts are stated here once more, for RE2 (no look-around, no
possessive repeats), so that a wrong one in ``docketline.functions.text`` shows
as a difference.
"""

from __future__ import annotations

# --- fixed values, stated apart from the engine's ---------------------------
PY_WHITESPACE = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "    　"
_BLANK = r"\t\n\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&#x27;": "'", "&apos;": "'", "&nbsp;": "\xa0",
            "&middot;": "·", "&copy;": "©", "&amp;": "&"}  # all that the test tables hold
RAW_BLOCK = r"(?is)<(?:!--.*?(?:-->|\z)|script\b[^>]*>.*?(?:</script\s*>|\z)|style\b[^>]*>.*?(?:</style\s*>|\z)|[!?][^>]*>)"
_REST_OF_TAG = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
TAG = "</?[A-Za-z]" + _REST_OF_TAG + ">"
P_START = r"(?i)<p(?:\s" + _REST_OF_TAG + ")?/?>"
P_END = r"(?i)</p\s*>"
STEM = r"(?s)\A((?:.*[/\\])?\.*[^./\\][^/\\]*)\.[^./\\]*\z"
BULLET_LINES = rf"(?:\A|\n)[{_BLANK}]*[*\-•→]+[{_BLANK}]+[^\n]*"
LEADING_BULLETS = rf"\A[\-*•→{_BLANK}]+"
HEADING, INCONCLUSIVE, MOJIBAKE = "AI Summary", "Inconclusive Response", "â€¢"
TOKENS_PER_WORD, TOKEN_LIMIT, LINE_MAX = 1.3, 3500, 80
DROPPED_STARTS, DROPPED_PART = ("BrewChat", "Dates are answered in the format"), "XML"
# ----------------------------------------------------------------------------


def lit(s: str) -> str:
    """SQL string literal; control characters spelled with chr()."""
    parts, buf = [], ""
    for ch in s:
        if ord(ch) < 32 or (ch in PY_WHITESPACE and ch != ' '):
            if buf:
                parts.append("'" + buf.replace("'", "''") + "'")
                buf = ""
            parts.append(f"chr({ord(ch)})")
        else:
            buf += ch
    if buf or not parts:
        parts.append("'" + buf.replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")"


def rx(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


NODE, P_OPEN, P_CLOSE = "chr(1)", "chr(2)", "chr(3)"


def strip(x: str) -> str:
    return f"trim({x}, {lit(PY_WHITESPACE)})"


def words(x: str) -> str:
    return f"regexp_extract_all(coalesce({x}, ''), {rx('[^' + _BLANK + ']+')})"


def token_estimate(n: str) -> str:
    return f"CAST(round_even(CAST({n} AS DOUBLE) * {TOKENS_PER_WORD}, 0) AS BIGINT)"


def part_count(tokens: str, limit: int = TOKEN_LIMIT) -> str:
    return f"greatest(1, CAST(ceil({tokens} / {float(limit)}) AS BIGINT))"


def part_text(w: str, n: str, i: str) -> str:
    """Words of part ``i`` (0-based) of ``n`` parts, joined by one blank."""
    k = f"(len({w}) // {n})"
    end = f"CASE WHEN {i} = {n} - 1 THEN len({w}) ELSE ({i} + 1) * {k} END"
    return f"array_to_string({w}[{i} * {k} + 1 : {end}], ' ')"


def decode_entities(x: str) -> str:
    out = x
    for ent, ch in ENTITIES.items():
        out = f"replace({out}, {lit(ent)}, {lit(ch)})"
    return out


def drop_raw_blocks(x: str) -> str:
    return f"regexp_replace({x}, {rx(RAW_BLOCK)}, {NODE}, 'g')"


def text_nodes(x: str) -> str:
    s = f"regexp_replace({x}, {rx(TAG)}, {NODE}, 'g')"
    nodes = f"list_transform(string_split({s}, {NODE}), lambda z: {strip(decode_entities('z'))})"
    return f"list_filter({nodes}, lambda z: z <> '')"


def html_to_text(x: str) -> str:
    text = decode_entities(f"array_to_string({text_nodes(drop_raw_blocks(x))}, ' ')")
    return f"(CASE WHEN {x} IS NULL OR {x} = '' THEN '' ELSE {text} END)"


def first_paragraph(x: str, max_length: int = LINE_MAX) -> str:
    s = drop_raw_blocks(x)
    s = f"regexp_replace({s}, {rx(P_START)}, {P_OPEN}, 'g')"
    s = f"regexp_replace({s}, {rx(P_END)}, {P_CLOSE}, 'g')"
    pieces = f"(string_split({s}, {P_OPEN}))[2:]"
    texts = (f"list_transform({pieces}, lambda p: array_to_string("
             f"{text_nodes(f'split_part(p, {P_CLOSE}, 1)')}, ''))")
    first = f"(list_filter({texts}, lambda t: t <> ''))[1]"
    return (f"coalesce(CASE WHEN length({first}) > {max_length} "
            f"THEN left({first}, {max_length}) || '...' ELSE {first} END, '-')")


def is_upper(x: str) -> str:
    return (f"(regexp_matches(coalesce({x}, ''), '\\p{{Lu}}') AND "
            f"NOT regexp_matches(coalesce({x}, ''), '[\\p{{Ll}}\\p{{Lt}}]'))")


def entry_description(fl: str) -> str:
    return f"(CASE WHEN {is_upper(fl)} THEN {fl} ELSE '-' END)"


def py_datetime_str(ts: str) -> str:
    return (f"(CASE WHEN {ts} IS NULL THEN NULL WHEN microsecond({ts}) % 1000000 = 0 "
            f"THEN strftime({ts}, '%Y-%m-%d %H:%M:%S') "
            f"ELSE strftime({ts}, '%Y-%m-%d %H:%M:%S.%f') END)")


def entry_uid(*cols: str) -> str:
    return f"sha256(concat_ws('|', {', '.join(f'CAST({c} AS VARCHAR)' for c in cols)}))"


def extract_bullets(x: str) -> str:
    found = f"regexp_extract_all(coalesce({x}, ''), {rx(BULLET_LINES)})"
    return (f"(CASE WHEN len({found}) > 0 THEN {lit(HEADING + chr(10))} || "
            f"array_to_string({found}, chr(10)) ELSE {lit(INCONCLUSIVE)} END)")


def fix_mojibake(x: str) -> str:
    return f"replace({x}, {lit(MOJIBAKE)}, '*')"


def clean_response(x: str) -> str:
    s = f"regexp_replace({x}, {rx(chr(10) + '[' + _BLANK + ']*[*\\-•→]+')}, chr(10) || '*', 'g')"
    cond = f"{strip('l')} <> '' AND NOT contains(l, {lit(DROPPED_PART)})"
    for p in DROPPED_STARTS:
        cond += f" AND NOT starts_with(l, {lit(p)})"
    kept = f"list_transform(list_filter(string_split({s}, chr(10)), lambda l: {cond}), lambda l: chr(9) || {strip('l')})"
    return strip(fix_mojibake(f"array_to_string({kept}, chr(10))"))


def described_response(desc: str, resp: str) -> str:
    return f"(coalesce({desc}, '') || chr(10) || coalesce({clean_response(resp)}, ''))"


def file_stem(x: str) -> str:
    return f"regexp_replace({x}, {rx(STEM)}, '\\1')"


def format_html(resp: str, src: str) -> str:
    r = strip(fix_mojibake(f"coalesce({resp}, '')"))
    lines = f"list_transform(string_split({r}, chr(10)), lambda l: {strip('l')})"
    lines = f"list_filter({lines}, lambda l: l <> '' AND NOT contains(l, {lit(HEADING)}))"
    lines = f"list_transform({lines}, lambda l: regexp_replace(l, {rx(LEADING_BULLETS)}, ''))"
    lines = f"list_filter({lines}, lambda l: l <> '')"
    items = f"array_to_string(list_transform({lines}, lambda l: '<li>' || l || '</li>'), '')"
    html = f"'<header><h2>' || coalesce({file_stem(src)}, '') || '</h2></header><ul>' || {items} || '</ul>'"
    return f"(CASE WHEN len({lines}) > 0 THEN {html} ELSE '' END)"


def sse_content(line: str) -> str:
    body = f"regexp_replace({line}, '^data: ', '')"
    return (f"(CASE WHEN {is_json_object(body)} THEN json_extract_string({body}, '$.content') END)")


def is_json_object(x: str) -> str:
    return f"coalesce(CASE WHEN json_valid({x}) THEN json_type({x}) = 'OBJECT' END, FALSE)"


def review_flag(x: str) -> str:
    return (f"(CASE WHEN contains(lower({x}), 'inconclusive') THEN 'red' "
            f"WHEN contains(lower({x}), 'handwritten') THEN 'yellow' END)")


def html_paragraphs(x: str) -> str:
    esc = f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return f"('<p>' || replace({esc}, chr(10), '</p><p>') || '</p>')"
