"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Every run of
``n`` words of a benchmark item is a window; an item of fewer words, but not
none, is one window. Each document's words are mapped to the ids that the
benchmark's vocabulary has (0: not a benchmark word), a rolling hash of every
run of known words is looked up in the sorted window hashes, and each match is
verified word for word. A word inside any verified window is hit.

The set of windows is broadcast ``max_windows`` at a time: a benchmark with
more is cut into slices by window hash, and each slice is a further pass over
the documents, so nothing broadcast grows beyond that bound.

Defined results: null or wordless texts have no words and no hits; null or
wordless items give no window; a null item id counts as the item '' (empty
string); repeated items and repeated rows are judged one by one; an empty
benchmark hits nothing. Other columns of the documents pass through untouched,
whatever their names.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import fresh, materialize, text_struct

WINDOW = 10
#: Windows broadcast in one pass (about 200 bytes each in a worker).
MAX_WINDOWS = 500_000

_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_SCAN = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                   ("spans", pa.list_(_SPAN)), ("clean", pa.string())])
_SCAN_DDL = ("n_words long, n_hit long, items array<string>, "
             "spans array<struct<start: long, end: long>>, clean string")


def _fold_table() -> bytes:
    """Byte map: A-Z to a-z, every other ASCII byte but a-z and 0-9 to a space."""
    keep = set(b"abcdefghijklmnopqrstuvwxyz0123456789")
    return bytes(c + 32 if 65 <= c <= 90 else c if c in keep or c >= 128 else 32 for c in range(256))


FOLD = _fold_table()


def fold_words(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def windows_of(words: list[bytes], n: int) -> list[bytes]:
    if len(words) < n:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]


def benchmark_windows(bench: DataFrame, n: int = WINDOW, id_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """(item, win) rows: the distinct windows of every item, as folded words."""
    def run(batches):
        for b in batches:
            items, wins = [], []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                found = set(windows_of(fold_words(text), n))
                items += [item] * len(found)
                wins += [w.decode() for w in found]
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(wins, pa.string())],
                                             names=["item", "win"])

    return bench.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                        F.col(text_col).cast("string").alias("text")).mapInArrow(run, "item string, win string")


def _rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of each run of n ids, by doubling (wraps at 64 bits)."""
    base = 0x9E3779B97F4A7C15
    out = np.zeros(len(ids) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * np.uint64(base) + ids[k:len(ids) - n + 1 + k]
    return out


def window_index(rows: list[tuple[str, str]]) -> dict:
    """What a worker needs to look windows up: the vocabulary, and by window
    length the sorted hashes and the items of each window."""
    vocabulary, by_length = {}, defaultdict(lambda: defaultdict(list))
    for item, win in rows:
        words = win.encode().split(b" ")
        for w in words:
            vocabulary.setdefault(w, len(vocabulary) + 1)
        by_length[len(words)][tuple(vocabulary[w] for w in words)].append(item)
    hashes = {n: np.unique(np.concatenate([_rolling(np.array(k, np.uint64), n) for k in wins]))
              for n, wins in by_length.items()}
    return {"vocabulary": vocabulary, "windows": {n: dict(w) for n, w in by_length.items()}, "hashes": hashes}


def scan_words(words: list[bytes], index: dict) -> tuple[np.ndarray, set[str]]:
    """Which words are hit, and the items with an occurring window."""
    hit, items = np.zeros(len(words), bool), set()
    if not words or not index["windows"]:
        return hit, items
    ids = np.array(list(map(index["vocabulary"].get, words, repeat(0))), np.uint64)
    known = np.concatenate(([0], np.cumsum(ids > 0)))
    for n, windows in index["windows"].items():
        if len(ids) < n:
            continue
        at = np.flatnonzero(known[n:] - known[:-n] == n)
        if not len(at):
            continue
        hashes = index["hashes"][n]
        found = _rolling(ids, n)[at]
        place = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
        for i in at[hashes[place] == found].tolist():
            here = windows.get(tuple(ids[i:i + n].tolist()))
            if here is not None:  # verified word for word
                hit[i:i + n] = True
                items.update(here)
    return hit, items


_WORD = re.compile(rb"[^ ]+")


def hit_spans(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Byte spans from the first to the last word of each run of hit words."""
    bounds = [m.span() for m in _WORD.finditer(text.translate(FOLD))]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [(bounds[a][0], bounds[b - 1][1]) for a, b in zip(edges[::2], edges[1::2])]


def scan(docs: DataFrame, bench: DataFrame, text_col: str = "text", n: int = WINDOW,
         max_windows: int = MAX_WINDOWS, out: str = "scan",
         bench_id: str = "item_id", bench_text: str = "text") -> DataFrame:
    """``docs`` with a struct column: n_words, n_hit, items, spans (code points,
    end exclusive) and clean (the text without the spans)."""
    spark = docs.sparkSession
    wins = materialize(benchmark_windows(bench, n, bench_id, bench_text).distinct(), "bench-windows")
    slices = max(1, -(-wins.count() // max_windows))
    found = fresh(docs, "hits")
    cols = [docs[c] for c in docs.columns]
    df = docs
    for k in range(slices):
        part = wins.where(F.pmod(F.xxhash64("win"), F.lit(slices)) == k)
        index = spark.sparkContext.broadcast(window_index([tuple(r) for r in part.collect()]))

        def make(index=index):
            value = index.value

            def one(text):
                hit, items = scan_words(words := fold_words(text), value)
                spans = hit_spans(text, hit) if items else []
                clean, points, at = text, [], 0
                if spans:
                    kept = []
                    for a, b in spans:
                        kept.append(text[at:a])
                        points.append({"start": len(text[:a].decode()), "end": len(text[:b].decode())})
                        at = b
                    clean = b"".join([*kept, text[at:]])
                return len(words), int(hit.sum()), sorted(items), points, None if clean is None else clean.decode()
            return one

        one_pass = text_struct(make, _SCAN, _SCAN_DDL)
        if slices == 1:
            return df.withColumn(out, one_pass(F.col(f"`{text_col}`")))
        new = one_pass(F.col(f"`{text_col}`"))
        df = df.withColumn(found, F.concat(F.coalesce(F.col(found), F.array()), F.array(new)) if k else F.array(new))
        df = materialize(df, "decontaminate-slice")  # one broadcast slice at a time
    return _merged(df, found, text_col, out)


def _merged(df: DataFrame, found: str, text_col: str, out: str) -> DataFrame:
    """Union of the slices' spans and items; words and text follow from it."""
    def merge(batches):
        for texts, slices in batches:
            rows = []
            for text, parts in zip(texts.cast(pa.binary()).to_pylist(), slices.to_pylist()):
                text_ = (text or b"").decode()
                spans: list[list[int]] = []
                for s in sorted((s["start"], s["end"]) for p in parts for s in p["spans"]):
                    if spans and s[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], s[1])
                    else:
                        spans.append(list(s))
                inside = "".join(" " + text_[a:b] for a, b in spans)
                clean, at = [], 0
                for a, b in spans:
                    clean.append(text_[at:a])
                    at = b
                rows.append({"n_words": parts[0]["n_words"], "n_hit": len(fold_words(inside.encode())),
                             "items": sorted({i for p in parts for i in p["items"]}),
                             "spans": [{"start": a, "end": b} for a, b in spans],
                             "clean": None if text is None else "".join([*clean, text_[at:]])})
            yield pa.array(rows, type=_SCAN)

    from collections.abc import Iterator
    merge.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    udf = F.arrow_udf(merge, _SCAN_DDL).asNondeterministic()
    return df.withColumn(out, udf(F.col(f"`{text_col}`").cast("string"), F.col(found))).drop(found)


def decontaminate(docs: DataFrame, bench: DataFrame, text_col: str = "text", mode: str = "documents",
                  max_share: float = 0.0, **kw) -> DataFrame:
    """Clean documents, with the columns of ``docs``.

    mode 'documents': a document goes when more than ``max_share`` of its words
    are hit. mode 'spans': the hit spans are cut out of the text, and all
    documents stay.
    """
    if mode not in ("documents", "spans"):
        raise ValueError(f"unknown mode {mode!r}")
    out = fresh(docs, "scan")
    scanned = scan(docs, bench, text_col, out=out, **kw)
    if mode == "spans":
        return scanned.withColumn(text_col, F.col(out)["clean"]).select(*[f"`{c}`" for c in docs.columns])
    kept = scanned.where(F.col(out)["n_hit"] <= F.lit(max_share) * F.col(out)["n_words"])
    return kept.select(*[f"`{c}`" for c in docs.columns])
