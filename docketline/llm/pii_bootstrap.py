"""PII by bootstrapped contextual extraction.

Seeds are what the base expressions find (email, ip, card, phone). Every seed
and every other number-, key- or address-like string of a text is an instance; the
word to its left, the word to its right, and both together are the lexical patterns
it occurs with. An instance's form (digits, dots, letters, '@') says which kinds it
could be of; a pattern is judged for each kind by the instances that could be of it.
Spark scores the graph of patterns and instances in rounds:

    pattern  = mean score of its distinct instances, drawn down by PRIOR
    instance = 1 for a seed of the kind; the score of the best pattern that
               extracted it, for a found one; else 0

Patterns that at least MIN_SEEDS distinct seeds or found instances of a kind hold
up and whose score reaches ACCEPT extract their other instances as new spans of
that kind. These count as instances in the next round, with the score they were
found with, on every pattern they occur with, so patterns that only share instances
with good ones can follow. The rounds end when one finds nothing new. Scores are
whole millionths, so sums don't depend on their order.

One pass over the texts writes the base spans and the instances, with their
contexts, in a narrow table; all else is joins and sums over it, by pattern and
by instance, summed before the shuffle. Everything is linear in the instances.

Instances are told apart by a 64-bit hash of the whole string, and context words
are whole words (a long one goes by its hash; a run of over WORD characters
without white space is no word, and all such runs are one context).

Defined results: null and empty texts have no spans; a pattern at a text's edge
has the empty word as its context; repeated rows count their instances once, as
instances are distinct strings; equal scores accept alike; an empty table gives an
empty result; null ids stay null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import materialize

#: The kinds, in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
PRIOR = 1.0
ACCEPT = 0.7
MIN_SEEDS = 3
UNIT = 1_000_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# possessive, and only at the start of a run of digits: the same matches without backtracking
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_LETTER = re.compile(r"[A-Za-z]")
#: Other instances: runs of at least seven digits with separators, strings of at
#: least 16 letters and digits, and what has an '@' inside.
_NUMBER = re.compile(r"\+?\(?[0-9](?:[ ().-]{0,2}[0-9]){6,}+")
_KEY = re.compile(r"(?<![0-9A-Za-z])[0-9A-Za-z]{16,}+")
_AT = re.compile(r"""(?<![^\s@<>()\[\],;:"'])[^\s@<>()\[\],;:"']++@[^\s@<>()\[\],;:"']++""")
#: A longer context word goes by a hash of the whole word; what has more than
#: WORD characters without white space is no word, and all such runs are alike.
SHOWN = 24
WORD = 1000
_WORD_AFTER = re.compile(r"\s*(\S{0,%d})" % (WORD + 1))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each '@' with the whole run of local characters before it: the leftmost
    matches, found from the '@' so that no other text is tried."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", a, b) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return out
    if "." in text:
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return out


def form_kinds(s: str) -> list[str]:
    """The kinds that a string could be of by its form, a weak test: an address or
    a key names a user as an email does, a key may stand for a card; numbers go by
    how many digits they have, and dotted ones may be an ip."""
    if "@" in s:
        return ["email"]
    if _LETTER.search(s):
        return ["email", "card"]
    n = len(_DIGIT.findall(s))
    fits = {"ip": s.count(".") == 3 and s.replace(".", "").isdigit(), "card": 12 <= n <= 19, "phone": 7 <= n <= 15}
    return [k for k in KINDS if fits.get(k)]


def _word(w: str) -> str:
    if len(w) > WORD:
        return "#"
    w = w.strip(".,;:!?\"'()[]<>#$%&*|").lower()
    return w if len(w) <= SHOWN else f"#{xxhash.xxh3_128_hexdigest(w)}"


def _word_before(text: str, start: int) -> str:
    """The last word of ``text[:start]``, or what of it shows that it is too long."""
    end = start
    while end > 0 and text[end - 1].isspace():
        end -= 1
    low = max(0, end - WORD - 1)
    return text[low:end].rsplit(None, 1)[-1] if low < end else ""


def contexts(text: str, start: int, end: int) -> tuple[str, str]:
    return _word(_word_before(text, start)), _word(_WORD_AFTER.match(text, end)[1])


def instances(text: str) -> tuple[list[tuple[str, int, int]], list[dict]]:
    """The base spans, and all instances with kind (null: not a seed)."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    found = [(k, a, b) for k, a, b in base]
    spots = {m.span() for rx in (_NUMBER, _KEY) for m in rx.finditer(text) if _DIGIT.search(m[0])} if _DIGIT.search(text) else set()
    if "@" in text:
        spots |= {(m.start(), m.start() + len(m[0].rstrip(".!?"))) for m in _AT.finditer(text)}
    if spots:
        spots = sorted(spots)
        at, end = 0, -1
        for a, b in spots:
            while at < len(taken) and taken[at][1] <= a:
                at += 1
            if a >= end and not (at < len(taken) and taken[at][0] < b):
                found.append((None, a, b))
                end = b
    rows = []
    for k, a, b in found:
        left, right = contexts(text, a, b)
        rows.append({"kind": k, "start": a, "end": b, "value": xxhash.xxh3_64_intdigest(text[a:b]) - (1 << 63), "fits": form_kinds(text[a:b]), "left": left, "right": right})
    return base, rows


_INSTANCE = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.int64()), ("fits", pa.list_(pa.string())),
                       ("left", pa.string()), ("right", pa.string())])
_DDL = ("id long, task long, row long, base array<struct<kind: string, start: long, end: long>>, "
        "found array<struct<kind: string, start: long, end: long, value: long, fits: array<string>, left: string, right: string>>")
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, row = TaskContext.get().partitionId(), 0
    for b in batches:
        base, found = [], []
        for text in b.column(1).to_pylist():
            s, f = instances(text or "")
            base.append([{"kind": k, "start": x, "end": y} for k, x, y in s])
            found.append(f)
        n = b.num_rows
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([task] * n, pa.int64()), pa.array(range(row, row + n), pa.int64()),
                                          pa.array(base, pa.list_(_SPAN)), pa.array(found, pa.list_(_INSTANCE))],
                                         names=["id", "task", "row", "base", "found"])
        row += n


def _patterns() -> Column:
    """The lexical patterns of a row: left word, right word, both."""
    return F.array(F.concat_ws("\t", F.lit("left"), "left"), F.concat_ws("\t", F.lit("right"), "right"), F.concat_ws("\t", F.lit("both"), "left", "right"))


def accepted_patterns(found: DataFrame) -> DataFrame:
    """found (kind, value, fits, left, right) -> (pattern, kind, score): the
    patterns that extract, once a round over the graph finds no new instance."""
    own = F.when(F.col("kind").isNotNull(), F.array("kind")).otherwise(F.array().cast("array<string>"))
    edges = found.select("kind", F.xxhash64("value").alias("instance"), F.array_union("fits", own).alias("fits"), F.explode(_patterns()).alias("pattern"))
    edges = edges.select("pattern", "instance", "kind", F.explode("fits").alias("of")).groupBy("pattern", "of", "instance").agg(
        F.max(F.col("kind").eqNullSafe(F.col("of")).cast("long")).alias("seed"), F.max(F.col("kind").isNotNull()).alias("taken"))
    edges = materialize(edges, "pii-graph")
    key = ["pattern", "of"]
    # fewer instances than MIN_SEEDS can't hold a pattern up, found or not
    patterns = (edges.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.sum("seed").alias("held")).where(F.col("n") >= MIN_SEEDS)
                .withColumns({"mass": F.col("held") * UNIT, "score": F.lit(None).cast("long")}))
    patterns = materialize(patterns, "pii-patterns")
    free = materialize(edges.where(~F.col("taken")).join(patterns.select(*key), key).select(*key, "instance"), "pii-free")
    known = None
    while True:
        passes = F.col("score").isNull() & (F.col("held") >= MIN_SEEDS) & (F.col("mass") >= F.lit(ACCEPT * UNIT) * (F.col("n") + F.lit(PRIOR)))
        passed = patterns.where(passes).select(*key, F.floor(F.col("mass") / (F.col("n") + F.lit(PRIOR))).alias("score"))
        new = free.join(passed, key).groupBy("instance", "of").agg(F.max("score").alias("score"))
        new = materialize(new if known is None else new.join(known, ["instance", "of"], "left_anti"), "pii-found")
        gained = free.join(new, ["instance", "of"]).groupBy(*key).agg(F.count(F.lit(1)).alias("more"), F.sum("score").alias("weight"))
        patterns = patterns.withColumn("score", F.when(passes, F.floor(F.col("mass") / (F.col("n") + F.lit(PRIOR)))).otherwise(F.col("score")))
        if new.isEmpty():
            return patterns.where("score is not null").select("pattern", F.col("of").alias("kind"), "score")
        patterns = patterns.join(gained, key, "left").select(
            *key, "n", (F.col("held") + F.coalesce("more", F.lit(0))).alias("held"), (F.col("mass") + F.coalesce("weight", F.lit(0))).alias("mass"), "score")
        patterns = materialize(patterns, "pii-patterns")
        known = new if known is None else materialize(known.select("instance", "of").union(new.select("instance", "of")), "pii-known")


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): each document's base spans and all its spans, both in
    the order of kinds and starts."""
    table = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(_extract, _DDL)
    table = materialize(table, "pii-instances")
    one = table.select("task", "row", F.explode("found").alias("f")).select("task", "row", "f.*")
    patterns = accepted_patterns(one.select("kind", "value", "fits", "left", "right"))
    new = one.where(F.col("kind").isNull()).select("task", "row", "start", "end", F.explode("fits").alias("kind"), _patterns().alias("of"))
    new = new.select("task", "row", "start", "end", "kind", F.explode("of").alias("pattern"))
    new = (new.join(patterns, ["pattern", "kind"]).groupBy("task", "row", "start", "end").agg(F.max(F.struct("score", "kind")).alias("best"))
           .groupBy("task", "row").agg(F.collect_list(F.struct(F.col("best.kind").alias("kind"), "start", "end")).alias("more"))
           .withColumnsRenamed({"task": "n_task", "row": "n_row"}))
    df = table.select("id", "task", "row", "base").join(new, (F.col("task") == F.col("n_task")) & (F.col("row") == F.col("n_row")), "left")
    order = F.array(*[F.lit(k) for k in KINDS])

    def sort(spans):
        keyed = F.array_sort(F.transform(spans, lambda s: F.struct(F.array_position(order, s["kind"]).alias("k"), s["start"].alias("start"),
                                                                   s["end"].alias("end"), s["kind"].alias("kind"))))
        return F.transform(keyed, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    return df.select("id", sort(F.col("base")).alias("base"), sort(F.concat("base", F.coalesce("more", F.array().cast(
        "array<struct<kind: string, start: bigint, end: bigint>>")))).alias("spans"))


def span_text(spans) -> "F.Column":
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
