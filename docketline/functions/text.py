"""Text rules of the chronology pipeline as Spark Column expressions.

Every function maps Columns to a Column built from ``pyspark.sql.functions``
only, so it stays inside the JVM (whole-stage codegen where Spark supports it,
interpreted higher-order functions otherwise) and works the same in batch and
in Structured Streaming. The semantics follow Python's ``str`` methods, which
differ from Spark's defaults in several places (see the notes per function).
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Characters Python's str.isspace() / str.strip() / str.split() treat as
# white space (Java's \s and Spark's trim() cover fewer of them).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regex character class, valid for Java and RE2.
WS = (r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
NOT_WS = WS.replace("[", "[^", 1)
# Bullet characters recognised in model responses.
BULLET_CLASS = "[*\\-•→]"
# Word-to-token factor and per-part token limit of the splitter.
TOKENS_PER_WORD = 1.3
TOKEN_LIMIT = 3500
# Response texts produced by the pipeline itself.
HANDWRITTEN_RESPONSE = "** handwritten **"
INCONCLUSIVE_RESPONSE = "Inconclusive Response"
SUMMARY_HEADING = "AI Summary"
NO_CONTENT_RESPONSE = "Error: No content extracted"
DEFAULT_PROMPT = "Default Prompt"
MOJIBAKE_BULLET = "â€¢"  # UTF-8 bullet read as cp1252
# Lines dropped from a cleaned response (startswith tests are on the raw line).
DROP_LINE_PREFIXES = ("BrewChat", "Dates are answered in the format")
DROP_LINE_CONTAINS = "XML"
FIRST_LINE_MAX = 80
# ----------------------------------------------------------------------------

_NODE = "\u0001"   # separator put where a tag was
_P_OPEN = "\u0002"
_P_CLOSE = "\u0003"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value`` evaluated once.

    A test on a computed value (``when(x == '', …).otherwise(f(x))``, also
    ``nullif``, which Spark rewrites to ``if(x = '', null, x)``) evaluates
    ``x`` twice: Spark does not share a sub-expression between a condition
    and one branch. A one-element ``transform`` binds it once."""
    return F.transform(F.array(value), body).getItem(0)


def py_strip(c) -> Column:
    """``str.strip()``: trims every character Python calls white space."""
    return F.trim(_c(c), F.lit(PY_WHITESPACE))


def words(c) -> Column:
    """``str.split()`` with no argument: array of non-blank runs.

    Every Python white-space character is mapped to a blank with
    ``translate`` (a character table, no regex), then the text is split on
    single blanks and the empty pieces removed. This is about three times
    faster than matching the Unicode white-space class with a regex.
    """
    blanks = F.translate(F.coalesce(_c(c), F.lit("")), PY_WHITESPACE, " " * len(PY_WHITESPACE))
    return F.array_remove(F.split(blanks, " "), "")


def word_count(c) -> Column:
    return F.size(words(c)).cast("bigint")


def token_estimate(n_words) -> Column:
    """``int(round(n * 1.3))``: half-even on the double, like Python."""
    return F.rint(_c(n_words) * F.lit(TOKENS_PER_WORD)).cast("bigint")


def part_count(tokens, limit: int = TOKEN_LIMIT) -> Column:
    """``max(1, ceil(tokens / limit))``."""
    return F.greatest(F.lit(1).cast("bigint"),
                      F.ceil(_c(tokens) / F.lit(limit)).cast("bigint"))


def split_words(word_arr, n_parts) -> Column:
    """Split a word array into ``n`` parts of ``len // n`` words, the last part
    taking the rest; each part re-joined with one blank."""
    w = _c(word_arr)
    n = _c(n_parts).cast("int")
    size = F.size(w)
    k = F.floor(size / n).cast("int")

    def part(i):
        length = F.when(i == n - 1, size - i * k).otherwise(k)
        return F.array_join(F.slice(w, i * k + 1, length), " ")

    return F.transform(F.sequence(F.lit(0), n - 1), part)


# A character reference after its '&' (never across a tag's mark).
_REFERENCE_RX = r"\A(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;\x01]{1,32};?)"
_REPLACEMENT = "�"


def _names() -> Column:
    """Map of the public HTML5 names (with and without ';') to their text: one
    constant, folded when the query is planned."""
    table = "\x01".join(f"{name}\x02{value}" for name, value in sorted(html5.items()))
    return F.str_to_map(F.lit(table), F.lit("\x01"), F.lit("\x02"))


def _common(ref: Column) -> Column:
    """The names of nearly all references, before the scan of the whole map."""
    out = F.when(ref == "amp;", "&")
    for name in ("lt;", "gt;", "quot;", "nbsp;", "apos;"):
        out = out.when(ref == name, html5[name])
    return out


def _code_point(n: Column) -> Column:
    """The character of a numeric reference by the HTML5 rules: 128-159 read
    as windows-1252, no control characters or non-characters, U+FFFD for zero,
    surrogates and numbers out of range."""
    old = F.array(*[F.lit(bytes([b]).decode("cp1252", "ignore") or chr(b)) for b in range(0x80, 0xA0)])
    nothing = (n.between(1, 8) | (n == 0xB) | n.between(0xE, 0x1F) | (n == 0x7F) | n.between(0xFDD0, 0xFDEF)
               | (n.bitwiseAND(0xFFFF) >= 0xFFFE))
    return (F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), _REPLACEMENT)
            .when(n.between(0x80, 0x9F), F.get(old, (n - 0x80).cast("int")))
            .when(nothing, "")
            .when(n == 0xFEFF, "\ufeff")  # else taken for a byte order mark
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")))


def _decode_piece(p: Column) -> Column:
    """Text after an '&', with the reference at its start decoded. Names
    without ';' count by their longest known prefix."""
    ref = F.regexp_extract(p, _REFERENCE_RX, 0)
    hexa = F.regexp_extract(ref, r"\A#[xX]0*([0-9a-fA-F]*)", 1)
    deci = F.regexp_extract(ref, r"\A#0*([0-9]*)", 1)
    is_hex, is_dec = ref.rlike(r"\A#[xX]"), ref.rlike(r"\A#[0-9]")
    number = (F.when(is_hex, F.when(F.length(hexa) > 8, 0x110000).otherwise(F.coalesce(F.conv(hexa, 16, 10).cast("bigint"), F.lit(0))))
              .otherwise(F.when(F.length(deci) > 9, 0x110000).when(deci == "", 0).otherwise(deci.cast("bigint"))))
    old_names = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    prefix = F.regexp_extract(ref, r"\A(?:" + "|".join(old_names) + ")", 0)
    named = F.coalesce(
        _common(ref),
        F.try_element_at(_names(), ref),
        F.concat(F.try_element_at(_names(), prefix), F.substring(ref, F.length(prefix) + 1, F.lit(64))),
        F.concat(F.lit("&"), ref))
    return F.concat(F.when(is_hex | is_dec, _code_point(number)).otherwise(named),
                    F.substring(p, F.length(ref) + 1, F.length(p)))


def decode_entities(c) -> Column:
    """Decode all HTML character references, as ``html.unescape`` does.

    The input appears once in the expression and is split at '&'; a text
    without one passes through the one-element array."""
    return F.array_join(F.transform(F.split(_c(c), "&"), lambda p, i: F.when(i == 0, p).otherwise(_decode_piece(p))), "")


# Patterns. Repetitions over quoted values are possessive: Java matches them in a
# loop, without recursion or backtracking, however long the tag.
# Comment, script body, style body, declaration / processing instruction;
# one alternation so the document is scanned once.
RAW_BLOCK_RX = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    r"|script\b[^>]*>.*?(?:</script\s*>|\z)"
    r"|style\b[^>]*>.*?(?:</style\s*>|\z)"
    r"|[!?][^>]*>)",
)
_ATTRS = r"[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+"
TAG_RX = r"</?[A-Za-z]" + _ATTRS + ">"
P_OPEN_RX = r"(?i)<p(?:/?|\s" + _ATTRS + r")>"
P_CLOSE_RX = r"(?i)</p\s*>"
STEM_RX = r"(?s)\A((?:.*[/\\])?\.*[^./\\][^/\\]*)\.[^./\\]*\z"
BULLETS_RX = r"(?:\A|\n)" + WS + "*" + BULLET_CLASS + "+" + WS + r"+[^\n]*"
LEADING_BULLETS_RX = r"\A[\-*•→" + WS[1:-1] + "]+"


def _drop_raw_blocks(c) -> Column:
    """Comments, <script>/<style> bodies, declarations and processing
    instructions; each becomes a node break."""
    s = _c(c)
    for pattern in RAW_BLOCK_RX:
        s = F.regexp_replace(s, pattern, _NODE)
    return s


_TAG = TAG_RX


def _text_nodes(c) -> Column:
    """Text nodes between tags, each entity-decoded once (as the HTML parser
    does) and stripped; empty nodes removed. Decoding the whole string once
    before the split is the same as decoding each node: tags are already
    markers, so a decoded '<' cannot start a tag."""
    s = decode_entities(F.regexp_replace(_c(c), _TAG, _NODE))
    nodes = F.transform(F.split(s, _NODE), py_strip)
    return F.array_remove(nodes, "")


def without_raw_blocks(c) -> Column:
    """The HTML (NULL as '') with comments, script/style bodies and
    declarations removed: the common first pass of ``html_to_text`` and
    ``paragraph_marked``. Project it once when both run on the same HTML."""
    return _drop_raw_blocks(F.coalesce(_c(c), F.lit("")))


def html_to_text(c, raw_free: Column | None = None) -> Column:
    """HTML to text: stripped text nodes joined by one blank, then entities
    decoded a second time. Null or empty input gives ''. ``raw_free``:
    ``without_raw_blocks(c)`` when it is already projected.

    Raw blocks and tags are removed in two regex passes: one alternation of
    both measured twice as slow, as the engine then tries both branches at
    every position."""
    body = raw_free if raw_free is not None else _drop_raw_blocks(c)
    text = decode_entities(F.array_join(_text_nodes(body), " "))
    return F.when(_c(c).isNull() | (_c(c) == ""), F.lit("")).otherwise(text)


def paragraph_marked(c, raw_free: Column | None = None) -> Column:
    """The HTML with raw blocks removed and ``<p>`` / ``</p>`` replaced by
    single marker characters; input of ``first_paragraph`` and
    ``paragraphs_alternate`` (project it once when both are needed).
    ``raw_free``: ``without_raw_blocks(c)`` when it is already projected."""
    s = raw_free if raw_free is not None else without_raw_blocks(c)
    return F.regexp_replace(F.regexp_replace(s, P_OPEN_RX, _P_OPEN), P_CLOSE_RX, _P_CLOSE)


def first_paragraph(c, max_length: int = FIRST_LINE_MAX, marked: bool = False) -> Column:
    """Text of the first non-empty ``<p>``: its stripped text nodes joined with
    no separator, cut to ``max_length`` + '...'; '-' when there is none.

    A paragraph runs up to the next ``<p>`` or ``</p>``. This equals the
    tree-building parser whenever paragraphs open and close in turn
    (``paragraphs_alternate``); ``html_exact.first_line_exact`` is the exact
    path for the other rows. ``marked``: ``c`` is already
    ``paragraph_marked``.
    """
    s = _c(c) if marked else paragraph_marked(c)
    pieces = F.slice(F.split(s, _P_OPEN), 2, 1 << 30)
    # text is worked out up to the first paragraph that has some
    first = F.aggregate(pieces, F.lit(""), lambda found, p: F.when(found != "", found).otherwise(
        F.array_join(_text_nodes(F.substring_index(p, _P_CLOSE, 1)), "")))
    return _let(first, lambda x: cut_line(F.when(x != "", x), max_length))


def cut_line(c, max_length: int = FIRST_LINE_MAX) -> Column:
    """A first line: cut to ``max_length`` + '...'; '-' for none. The cut is one
    regex so that its input (a lambda expression) is evaluated once; '.' is one
    code point, like length() and Python's len."""
    cut = F.regexp_replace(_c(c), r"(?s)\A(.{%d}).+\z" % max_length, "$1...")
    return F.coalesce(cut, F.lit("-"))


def paragraphs_alternate(c, marked: bool = False) -> Column:
    """True when every ``<p>`` is closed by ``</p>`` before the next one opens
    (no open or nested paragraphs): then ``first_paragraph`` is exact."""
    s = _c(c) if marked else paragraph_marked(c)
    marks = F.regexp_replace(s, f"[^{_P_OPEN}{_P_CLOSE}]+", "")
    return marks.rlike(f"^(?:{_P_OPEN}{_P_CLOSE})*$")


def is_upper(c) -> Column:
    """``str.isupper()``: some upper-case letter and no lower/title-case one."""
    x = F.coalesce(_c(c), F.lit(""))
    return x.rlike(r"\p{IsUppercase}") & ~x.rlike(r"[\p{IsLowercase}\p{Lt}]")


def entry_description(first_line) -> Column:
    return F.when(is_upper(first_line), _c(first_line)).otherwise(F.lit("-"))


def epoch_millis_to_ts(ms) -> Column:
    """Epoch milliseconds (any JSON scalar) to a timestamp; NULL when invalid."""
    return F.timestamp_millis(F.expr("try_cast(null as bigint)") if ms is None
                              else _c(ms).try_cast("bigint"))


def py_datetime_str(ts) -> Column:
    """``str(datetime)``: seconds, plus 6 fraction digits only when non-zero."""
    t = _c(ts)
    whole = F.date_format(t, "yyyy-MM-dd HH:mm:ss")
    frac = F.date_format(t, "SSSSSS")
    return F.when(t.isNull(), None).when(frac == "000000", whole) \
        .otherwise(F.concat(whole, F.lit("."), frac))


def entry_uid(*cols) -> Column:
    """Deterministic id of a source entry, shared by its parts."""
    return F.sha2(F.concat_ws("|", *[_c(x).cast("string") for x in cols]), 256)


def extract_bullets(c) -> Column:
    """All bullet lines of a response, or 'Inconclusive Response'."""
    found = F.regexp_extract_all(F.coalesce(_c(c), F.lit("")), F.lit(BULLETS_RX), 0)
    # every match holds a bullet, so the joined text is '' only when there
    # is no match; the regex runs once (bound by _let)
    return _let(F.array_join(found, "\n"),
                lambda j: F.when(j == "", F.lit(INCONCLUSIVE_RESPONSE))
                .otherwise(F.concat(F.lit(SUMMARY_HEADING + "\n"), j)))


def fix_mojibake(c) -> Column:
    return F.replace(_c(c), F.lit(MOJIBAKE_BULLET), F.lit("*"))


def clean_response(c, drop_prefixes: tuple[str, ...] = DROP_LINE_PREFIXES) -> Column:
    """Normalise bullets to '*', drop blank lines, lines that begin with one of
    ``drop_prefixes`` and XML lines, tab-indent."""
    x = F.regexp_replace(_c(c), "\n" + WS + "*" + BULLET_CLASS + "+", "\n*")
    lines = F.split(x, "\n", -1)

    def keep(line):
        cond = (py_strip(line) != "") & ~line.contains(DROP_LINE_CONTAINS)
        for p in drop_prefixes:
            cond = cond & ~line.startswith(p)
        return cond

    kept = F.transform(F.filter(lines, keep), lambda line: F.concat(F.lit("\t"), py_strip(line)))
    return py_strip(fix_mojibake(F.array_join(kept, "\n")))


def described_response(description, response) -> Column:
    """Description line in front of the cleaned response."""
    return F.concat(F.coalesce(_c(description), F.lit("")), F.lit("\n"),
                    F.coalesce(clean_response(response), F.lit("")))


def file_stem(c) -> Column:
    """``os.path.splitext(name)[0]`` for Windows paths: the last dot of the
    base name, leading dots excluded."""
    return F.regexp_replace(_c(c), STEM_RX, "$1")


def format_html(response, source_doc) -> Column:
    """Response lines to ``<header><h2>stem</h2></header><ul><li>…</li></ul>``.

    Lines containing 'AI Summary' are dropped, leading bullets and blanks are
    removed; no HTML escaping (parity). Empty when no line is left.
    """
    r = py_strip(fix_mojibake(F.coalesce(_c(response), F.lit(""))))
    lines = F.transform(F.split(r, "\n", -1), py_strip)
    lines = F.filter(lines, lambda x: (x != "") & ~x.contains(SUMMARY_HEADING))
    lines = F.transform(lines, lambda x: F.regexp_replace(x, LEADING_BULLETS_RX, ""))
    lines = F.filter(lines, lambda x: x != "")
    items = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("<li>"), x, F.lit("</li>"))), "")
    title = F.coalesce(file_stem(source_doc), F.lit(""))
    # items is '' exactly when no line is left; the line pipeline runs once
    return _let(items, lambda it: F.when(it == "", F.lit("")).otherwise(
        F.concat(F.lit("<header><h2>"), title, F.lit("</h2></header><ul>"), it, F.lit("</ul>"))))


def sse_content(line) -> Column:
    """Content of one event-stream line ``data: {"content": …}``; NULL for
    lines that are not JSON objects or carry no content."""
    body = F.regexp_replace(_c(line), r"\Adata: ", "")
    return F.try_variant_get(F.try_parse_json(body), "$.content", "string")


def review_flag(c) -> Column:
    """Highlight class of a response: 'red' for inconclusive, else 'yellow'
    for handwritten (case-insensitive), else NULL."""
    low = F.lower(_c(c))
    return F.when(low.contains("inconclusive"), F.lit("red")) \
        .when(low.contains("handwritten"), F.lit("yellow"))


def html_paragraphs(text) -> Column:
    """Render plain text as HTML paragraphs (one per line, text escaped)."""
    esc = F.replace(F.replace(F.replace(_c(text), F.lit("&"), F.lit("&amp;")),
                              F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.concat(F.lit("<p>"), F.replace(esc, F.lit("\n"), F.lit("</p><p>")), F.lit("</p>"))
