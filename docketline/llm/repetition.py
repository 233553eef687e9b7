"""Quality rules by repetition coverage.

For each n-gram length a rolling hash of every n-word run of a text is taken in
numpy; runs with equal hashes are verified word for word. The characters inside
repeated runs (every occurrence after the first), counted once however many
runs cover them, are divided by the characters of all words. The same is done
for lines. A text whose coverage exceeds a limit is rejected.

Defined results: null and empty texts have no words, fail the base rule and are
not kept; a text with fewer words than a run is long has no run of that length;
ties and repeated rows are judged alone, each on its own text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import CONTINUATION, SPACES, fresh, text_struct

#: The largest share of characters inside repeated n-word runs,
#: and inside repeated lines, as published for the MassiveText filters.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_CHAR_LIMIT = 0.20
LINE_COUNT_LIMIT = 0.30
#: Fixed values of the base rule.
SYMBOLS = b"#*$%&|<>"
BASE_RUN = 5
BASE_MIN_WORDS = 10
BASE_PERCENT = 20


def repeats(ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of n-word runs that occur before (later ones), and of
    those that occur again or before (all). ``ids``: one int per distinct word."""
    m = len(ids) - n + 1
    none = np.zeros(0, np.int64)
    if m < 2:
        return none, none
    rolling = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            rolling = rolling * np.uint64(0x9E3779B97F4A7C15) + ids[k:m + k] + np.uint64(1)
    order = np.argsort(rolling, kind="stable")
    ranked = rolling[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return none, none
    head = np.concatenate(([True], ~same))
    group = np.cumsum(head) - 1
    first = order[head][group]
    runs = np.lib.stride_tricks.sliding_window_view(ids, n)
    later = np.flatnonzero(~head)
    equal = (runs[order[later]] == runs[first[later]]).all(axis=1)
    if not equal.all():  # two different runs with one hash: compare them exactly
        seen: dict[bytes, int] = {}
        pairs = [(seen.setdefault(r.tobytes(), i), i) for i, r in enumerate(runs)]
        again = [i for f, i in pairs if f != i]
        return np.array(again, np.int64), np.unique([x for f, i in pairs if f != i for x in (f, i)])
    return order[later], np.unique(np.concatenate((order[later], first[later])))


def covered(n_words: int, starts: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in a run of n words from one of ``starts``."""
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def _chars(text: bytes) -> int:
    return len(text.translate(None, CONTINUATION + SPACES))


_FIELDS = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
           ("n_repeat_words", "long"), ("dup_line_share", "double"), ("dup_line_char_share", "double"),
           *[(f"dup_{n}gram_share", "double") for n in NGRAM_LIMITS]]
_TYPES = {"long": pa.int64(), "double": pa.float64()}


def measure(text: bytes | None) -> tuple:
    """The measures of one text, in the order of the struct's fields."""
    text = text or b""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    n_dup = len(lines) - len(set(lines))
    chars = _chars(text)
    dup_chars = 0
    if n_dup:
        seen: set[bytes] = set()
        for x in lines:
            if x in seen:
                dup_chars += _chars(x)
            seen.add(x)
    n_repeat, shares = 0, []
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
    sizes = None
    live = len(number) < len(words)
    for n in NGRAM_LIMITS:
        later, all_ = repeats(ids, n) if live else ([], [])
        live = live and len(later) > 0  # no repeated n-gram: none of n + 1 words
        if n == BASE_RUN and live:
            n_repeat = int(covered(len(words), all_, n).sum())
        if live:
            if sizes is None:
                sizes = np.array([len(w.translate(None, CONTINUATION)) for w in words])
            shares.append(float(sizes[covered(len(words), later, n)].sum()) / chars)
        else:
            shares.append(0.0)
    return (len(words), chars, len(text) - len(text.translate(None, SYMBOLS)), n_dup, n_repeat,
            n_dup / len(lines) if lines else 0.0, dup_chars / chars if chars else 0.0, *shares)


def measures(text: Column) -> Column:
    """Struct of a text's counts and coverage shares."""
    return text_struct(lambda: measure, pa.struct([(k, _TYPES[t]) for k, t in _FIELDS]),
                       ", ".join(f"{k} {t}" for k, t in _FIELDS))(text)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < BASE_MIN_WORDS) | (100 * m["n_repeat_words"] > BASE_PERCENT * m["n_words"])


def verdict(m: Column) -> Column:
    """True where no coverage limit is exceeded."""
    ok = (m["dup_line_share"] <= LINE_COUNT_LIMIT) & (m["dup_line_char_share"] <= LINE_CHAR_LIMIT)
    for n, limit in NGRAM_LIMITS.items():
        ok = ok & (m[f"dup_{n}gram_share"] <= limit)
    return ok


def repetition_filter(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that pass the base rule and the coverage limits."""
    out = fresh(docs, "measures")
    df = docs.withColumn(out, measures(F.col(f"`{text_col}`")))
    return df.where(~base_failed(F.col(out)) & verdict(F.col(out))).drop(out)
