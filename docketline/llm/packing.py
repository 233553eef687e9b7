"""Best-fit packing of tokenised documents into sequences of bounded length.

1. One pass over the texts tokenises them, cuts documents over the capacity
   (the first piece takes the remainder) and writes one narrow row a piece,
   with the task's number and the piece's rank among the task's pieces of its
   length. The rank is part of the written row, so later jobs don't depend on
   how that table is read.
2. Only the histogram of lengths (at most ``capacity`` numbers) goes to the
   driver, where bin completion (``bin_completion.solve``) turns it into
   fillings. An allocation table says which ranks of a length go to which
   sequences; it has a few rows a filling, whatever the number of documents.
3. Ranks become global by adding each (length, task)'s offset, and one join
   with the allocation table places every piece.

The histogram covers all pieces, so the packing is one for the whole corpus, and
nothing but the histogram and the fillings is ever in one place.

Tokens are those of ``tokenizers`` for the given file, with no special tokens
added; an added token that stands in a text has its own id there. The same vocabulary and merges are run by ``tiktoken``, which is about five
times faster; a text on whose white space its matcher gives up goes to
``tokenizers``.

Defined results: a null text is an empty one and gives one piece, the end
token; repeated rows are packed one by one; a null id stays null; an empty table
gives an empty result. Column clashes can't occur, as the result has its own
columns only.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketline.llm.bin_completion import MAX_NODES, Packing, solve
from docketline.llm.common import give_back, materialize

CAPACITY = 1024
END_TOKEN = 2
#: Fixed value: the splitting pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def encoder(spec: str) -> Callable[[str], np.ndarray]:
    """text -> ids (uint32) for a byte-level BPE tokenizer in JSON form."""
    import tiktoken

    model, letters = json.loads(spec), byte_alphabet()
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    plain = not any(t[k] for t in model["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
    ranks = {bytes(letters[c] for c in word): i for word, i in model["model"]["vocab"].items() if word not in special}
    fast = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    slow = []

    def encode(text: str) -> np.ndarray:
        try:
            if plain:
                return fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # its matcher has a limited stack
            pass
        if not slow:
            from tokenizers import Tokenizer
            slow.append(Tokenizer.from_str(spec))
        return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)
    return encode


_PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, task long, rank long")


def pieces(docs: DataFrame, spec: str, capacity: int = CAPACITY, end_token: int = END_TOKEN,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row a piece: place in its document, length and checksum of its ids,
    the task's number and the rank among the task's pieces of the same length."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)  # about 2 MB, fixed by the tokenizer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # of earlier stages
        encode = encoder(shared.value)
        task = TaskContext.get().partitionId()
        ranks: dict[int, int] = defaultdict(int)
        end = np.array([end_token], "<u4")
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.concatenate((encode(text or ""), end)).astype("<u4", copy=False)
                start, n = 0, len(ids)
                size = n % capacity or min(n, capacity)
                k = 0
                while start < n:
                    part = ids[start:start + size].tobytes()
                    rows.append((doc, k, start, size, zlib.crc32(part), task, ranks[size], part))
                    ranks[size] += 1
                    start, k, size = start + size, k + 1, capacity
            cols = list(zip(*rows)) or [[]] * 8
            types = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.binary()][:8 if with_ids else 7]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names[:len(types)])
        del encode
        give_back()

    return (docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
            .mapInArrow(run, _PIECES + (", ids binary" if with_ids else "")))


def allocation(packing: Packing) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from rank, to rank, copies, first sequence, offset) rows."""
    rows, taken, sequence = [], defaultdict(int), 0
    for filling, times in packing:
        offset = 0
        for length, copies in filling:
            rows.append((length, taken[length], taken[length] + copies * times, copies, sequence, offset))
            taken[length] += copies * times
            offset += length * copies
        sequence += times
    return rows


def pack(docs: DataFrame, spec: str, capacity: int = CAPACITY, end_token: int = END_TOKEN,
         id_col: str = "doc_id", text_col: str = "text", max_nodes: int = MAX_NODES,
         with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and place there."""
    spark = docs.sparkSession
    cut = materialize(pieces(docs, spec, capacity, end_token, id_col, text_col, with_ids), "pieces")
    blocks = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r[0]: r[1] for r in cut.groupBy("length").agg(F.count(F.lit(1))).collect()}  # <= capacity rows
    plan = spark.createDataFrame(allocation(solve(histogram, capacity, max_nodes)) or [(0, 0, 0, 1, 0, 0)],
                                 "l long, lo long, hi long, copies long, first long, place long")
    give_back()  # what the search held; the driver goes on to other stages
    # the plan has a few fillings a length, of at most some 45 lengths each: under 10 MB at this capacity
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    bases = blocks.select(F.col("length").alias("b_length"), F.col("task").alias("b_task"),
                          F.coalesce(before, F.lit(0)).alias("base"))
    ranked = cut.join(bases, (cut["length"] == bases["b_length"]) & (cut["task"] == bases["b_task"]))
    r = F.col("base") + F.col("rank")
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("l")) & (r >= F.col("lo")) & (r < F.col("hi")))
    turn = r - F.col("lo")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor(turn / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("place") + F.pmod(turn, F.col("copies")) * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if with_ids else []))


def sequences(docs: DataFrame, spec: str, **kw) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, ids as
    little-endian unsigned 32-bit integers; at most ``capacity`` ids a row."""
    placed = pack(docs, spec, with_ids=True, **kw)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (placed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", F.aggregate(F.transform("parts", lambda p: F.hex(p["ids"])), F.lit(""),
                                               lambda a, x: F.concat(a, x), F.unhex).alias("ids")))
