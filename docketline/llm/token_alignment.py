"""Alignment of two tokenizers' tokens by pointer jumping.

Both tokenizers encode a text; tokenizer A sees a space before it, as B (a
SentencePiece model) puts one there itself. The tokens of each tile the same bytes.

1. *Groups.* Every token points to the token of the other side that overlaps it
   and reaches farthest to the right, or to itself where none reaches farther (of
   two that end together the A token is the terminal one). All pointers of a batch
   of texts are doubled at once, ``p = p[p]``, until nothing changes: about log2 of
   the longest chain rounds. The token where a chain ends labels its group, and
   groups are numbered by their terminal tokens. A group is thus a connected
   component of overlaps, and it ends where both sides have a token's end.
2. *Links.* Between two neighbouring ends of either side lies exactly one pair of
   overlapping tokens, so the merged ends list all links, once each.
3. *Corpus counts.* How many texts hold a pair of ids linked is a grouped count
   over the distinct pairs of each text. The best count of an A id follows by a
   second grouping.
4. *Scores.* The pairs of each text are joined with that table, and sums are taken
   by text before anything is shuffled. The table is broadcast if its counted rows
   are at most ``LOOKUP_ROWS``; beyond that it is an ordinary shuffle join, whose
   skewed keys AQE splits. The rows are the same.

Only whole Arrow batches of texts (a few MB, or one longer text) are in memory in
Python; tokenising runs once, and its result is written below the checkpoint folder.

Defined results: a text that is null or empty, or whose joined token bytes on
either side differ from space + text (normalisation, unknown characters), has no
tokens: all counts are 0 and ``groups`` is ''. Strings of special tokens inside a
text are ordinary text. Repeated rows count as separate texts; null ids stay null;
an empty table gives empty results. Results have their own columns only.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import materialize
from docketline.llm.packing import PATTERN, byte_alphabet

LOOKUP_ROWS = 2_000_000
#: Ids and rows of a batch are packed into one number; both vocabularies stay below.
ID_BITS = 20


def encoder_a(spec: str) -> tuple[Callable[[str], np.ndarray], list[bytes]]:
    """(text -> ids, bytes of each id) of a byte-level BPE tokenizer in JSON form;
    strings of special tokens are ordinary text."""
    import tiktoken

    model, letters = json.loads(spec), byte_alphabet()
    special = {t["content"] for t in model["added_tokens"]}
    ranks = {bytes(letters[c] for c in word): i for word, i in model["model"]["vocab"].items() if word not in special}
    shown = [b""] * (max(ranks.values()) + 1)
    for word, i in ranks.items():
        shown[i] = word
    fast = tiktoken.Encoding("alignment", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow = []

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, disallowed_special=())
        except ValueError:  # its matcher has a limited stack
            pass
        if not slow:
            from tokenizers import Tokenizer
            slow.append(Tokenizer.from_str(spec))
            slow[0].encode_special_tokens = True
        return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)
    return encode, shown


def encoder_b(model: bytes) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """(text -> ids, bytes of each id) of a SentencePiece model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)

    def shown(i: int) -> bytes:
        piece = sp.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode()

    return sp.encode, [shown(i) for i in range(sp.get_piece_size())]


class Segments:
    """The pieces between neighbouring ends of either side, one for each
    overlapping pair: its A and its B token, and whether they end with it. Ends
    are byte offsets in rising order; both sides reach the same last end."""

    def __init__(self, ends_a: np.ndarray, ends_b: np.ndarray):
        ends = np.concatenate((ends_a, ends_b))
        order = np.argsort(ends, kind="stable")  # merges two sorted runs
        ends, of_a = ends[order], order < len(ends_a)
        first = np.concatenate(([True], ends[1:] != ends[:-1])) if len(ends) else np.zeros(0, bool)
        last = np.concatenate((first[1:], [True])) if len(ends) else first
        both = ~(first & last)[first]
        self.ends_a, self.ends_b = of_a[first] | both, ~of_a[first] | both
        self.a, self.b = (np.cumsum(x) - x for x in (self.ends_a, self.ends_b))


def terminals(seg: Segments) -> np.ndarray:
    """For every token, A's first and then B's, the A token that ends its group."""
    a_at, b_at = np.flatnonzero(seg.ends_a), np.flatnonzero(seg.ends_b)
    n = len(a_at)
    point = np.concatenate((np.where(seg.ends_b[a_at], np.arange(n), n + seg.b[a_at]), seg.a[b_at]))
    while True:
        jumped = point[point]
        if np.array_equal(jumped, point):
            return point
        point = jumped


_FIELDS = [("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()),
           ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))]
_DDL = "id long, n_a long, n_b long, n_groups long, n_links long, groups string, a array<int>, b array<int>, times array<int>"


class Aligner:
    """Aligns the texts of a batch."""

    def __init__(self, spec_a: str, model_b: bytes):
        self.encode_a, self.bytes_a = encoder_a(spec_a)
        self.encode_b, self.bytes_b = encoder_b(model_b)
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        top = self.top = max(len(self.bytes_a), len(self.bytes_b))
        self.written = [f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(top)]

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides, none where either doesn't give the text's bytes."""
        if text:
            raw = b" " + text.encode()
            a = self.encode_a(" " + text)
            b = self.encode_b(text)
            if b"".join(map(self.bytes_b.__getitem__, b)) == raw and b"".join(map(self.bytes_a.__getitem__, a.tolist())) == raw:
                return a.astype(np.int64), np.array(b, np.int64)
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    def batch(self, texts: list[str | None]) -> list[pa.Array]:
        """The columns of the result behind the id."""
        pairs = [self.tokens(t) for t in texts]
        n_a, n_b = (np.array([len(p[k]) for p in pairs], np.int64) for k in (0, 1))
        ids_a, ids_b = (np.concatenate([p[k] for p in pairs] or [np.zeros(0, np.int64)]) for k in (0, 1))
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        row_a, row_b = np.repeat(np.arange(len(texts)), n_a), np.repeat(np.arange(len(texts)), n_b)
        seg = Segments(ends_a, ends_b)
        last = terminals(seg)
        closes = last[:len(ids_a)] == np.arange(len(ids_a))
        group = np.cumsum(closes)[last] - 1 if len(last) else last
        row = row_a[seg.a]
        key = np.sort((row << (2 * ID_BITS)) | (ids_a[seg.a] << ID_BITS) | ids_b[seg.b])
        begins = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        times = np.diff(begins, append=len(key))
        key = key[begins]
        mask = (1 << ID_BITS) - 1
        offsets = pa.array(np.searchsorted(key >> (2 * ID_BITS), np.arange(len(texts) + 1)), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in ((key >> ID_BITS) & mask, key & mask, times)]
        counts = [n_a, n_b, np.bincount(row_a[closes], minlength=len(texts)), np.bincount(row, minlength=len(texts))]
        return [*[pa.array(c.astype(np.int64)) for c in counts],
                pa.array(self.shown(ids_a, ids_b, group, n_a + n_b, np.concatenate((row_a, row_b))), pa.string()), *lists]

    def shown(self, ids_a: np.ndarray, ids_b: np.ndarray, group: np.ndarray, sizes: np.ndarray, row: np.ndarray) -> list[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        side = 2 * group
        side[len(ids_a):] += 1
        order = np.argsort(side, kind="stable")
        ids, side, row = np.concatenate((ids_a, ids_b))[order], side[order], row[order]
        mark = np.full(len(ids), 3)
        step, same = np.diff(side), row[1:] == row[:-1]
        mark[:-1][same] = np.where(step == 0, 0, np.where(side[1:] & 1, 1, 2))[same]
        words = (mark * self.top + ids).tolist()
        ends = np.cumsum(sizes).tolist()
        return ["".join(map(self.written.__getitem__, words[end - n:end])) for end, n in zip(ends, sizes.tolist())]


def align(docs: DataFrame, spec_a: str, model_b: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a text: numbers of tokens, groups and links, the groups, and the
    distinct pairs of linked ids (``a``, ``b``) with their numbers of links."""
    shared = docs.sparkSession.sparkContext.broadcast((spec_a, model_b))  # a few MB, fixed by the tokenizers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), *aligner.batch(b.column(1).to_pylist())], schema=pa.schema(_FIELDS))

    return docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")).mapInArrow(run, _DDL)


def write(aligned: DataFrame) -> DataFrame:
    """The alignment as a written table, with a number for each row."""
    return materialize(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")


def link_table(aligned: DataFrame) -> DataFrame:
    """(a, b, count, best): in how many texts a pair of ids is linked, and whether
    no other pair of its A id is in more."""
    counts = aligned.select(F.inline(F.arrays_zip("a", "b"))).groupBy("a", "b").agg(F.count(F.lit(1)).alias("count"))
    counts = materialize(counts, "link-counts")
    tops = counts.groupBy("a").agg(F.max("count").alias("top")).withColumnRenamed("a", "top_a")
    return materialize(counts.join(tops, F.col("a") == F.col("top_a")).select("a", "b", "count", (F.col("count") == F.col("top")).alias("best")), "link-table")


def score(aligned: DataFrame, table: DataFrame, lookup_rows: int = LOOKUP_ROWS) -> DataFrame:
    """``n_best``, the links whose pair is a best one of its A id, and
    ``count_sum``, the sum of the counts of all links, in place of the pairs.
    ``aligned`` is a written table with a ``row`` number (``write``)."""
    known = table.select(F.col("a").alias("t_a"), F.col("b").alias("t_b"), "count", "best")
    if table.limit(lookup_rows + 1).count() <= lookup_rows:
        known = F.broadcast(known)
    each = aligned.select("row", F.inline(F.arrays_zip("a", "b", "times")))
    sums = (each.join(known, (F.col("a") == F.col("t_a")) & (F.col("b") == F.col("t_b"))).groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")))
    sums = sums.withColumnRenamed("row", "sum_row")
    zero = F.lit(0).cast("long")
    return (aligned.drop("a", "b", "times").join(sums, F.col("row") == F.col("sum_row"), "left")
            .withColumns({"n_best": F.coalesce("n_best", zero), "count_sum": F.coalesce("count_sum", zero)}).drop("row", "sum_row"))
