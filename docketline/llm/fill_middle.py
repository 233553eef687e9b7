"""Fill-in-the-middle transformation, cuts located by a wavelet matrix.

A text is a row of units: a run of letters A-Z, a-z, or any other single code
point. Two hashed numbers a document say after how many units the prefix and the
middle end; the output puts the suffix before the middle, so that a model trained
on it learns to fill the gap.

The bytes of a whole Arrow batch are one sequence over four character classes:

* ``INSIDE``: a letter that continues its run;
* ``OPENS``: a letter that opens a run;
* ``TRAIL``: a continuation byte of UTF-8;
* ``SINGLE``: any other byte, which starts a unit of its own.

A wavelet matrix holds the sequence in two bit levels. Rank queries on it combine
into all that is needed: units before byte i = rank(OPENS, i) + rank(SINGLE, i),
code points before byte i = i - rank(TRAIL, i). A cut after k units of a text that
starts at byte s lies where the count of units reaches its value at s plus k; both
cuts of all texts of the batch are found by one bisection on ranks. Nothing is
split into tokens and no text is decoded.

Forms: ``plain`` is the text itself; ``psm`` is prefix mark, prefix, suffix mark,
suffix, middle mark, middle; ``spm`` is suffix mark, suffix, prefix mark, prefix,
middle mark, middle. A text that holds a mark stays plain, so ``restore`` is exact:
a mark can't arise at a seam, as only a mark's first character is ``<``.

Memory: an Arrow batch (a few MB, or one longer text) with its classes, two bit
levels and their counts, about two bytes a byte of text.

Defined results: a null text is an empty one; an empty text is plain with no
units; a null id hashes like the text ``null``; repeated rows are transformed one
by one; an empty table gives an empty result; other columns pass through, and the
result's column takes a free name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = ("<P>", "<S>", "<M>")
SEED = "1"
PLAIN_PERCENT = 10
SPM_PERCENT = 20
INSIDE, OPENS, TRAIL, SINGLE = range(4)

_DDL = "n long, form string, prefix_chars long, middle_chars long, output string"
_TYPE = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])


class Bits:
    """A bit vector with a count at every 64-bit word: rank in constant time."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word, rest = i >> 6, (i & 63).astype(np.uint64)
        mask = (np.uint64(1) << rest) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Rank of symbols below 2 ** depth, one bit level a binary digit."""

    def __init__(self, symbols: np.ndarray, depth: int):
        self.depth, self.levels = depth, []
        for d in reversed(range(depth)):
            bit = (symbols >> d) & 1
            level = Bits(bit)
            zeros = len(symbols) - int(level.before[-1])
            self.levels.append((level, zeros))
            if d:  # zeros first, then ones, each in order
                symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def rank(self, symbol: int, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` among the first i symbols."""
        start = np.zeros_like(i)
        for d, (level, zeros) in zip(reversed(range(self.depth)), self.levels):
            ones_start, ones_i = level.rank(start), level.rank(i)
            if (symbol >> d) & 1:
                start, i = zeros + ones_start, zeros + ones_i
            else:
                start, i = start - ones_start, i - ones_i
        return i - start


def classes(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of every byte; ``starts`` are the places where texts begin."""
    folded = raw | 0x20
    letter = (folded >= 97) & (folded <= 122)
    opens = letter.copy()
    opens[1:] &= ~letter[:-1]
    first = starts[starts < len(raw)]
    opens[first] = letter[first]
    out = np.full(len(raw), SINGLE, np.uint8)
    out[letter] = INSIDE
    out[opens] = OPENS
    out[(raw & 0xC0) == 0x80] = TRAIL
    return out


class Boundaries:
    """Units and code points of texts that lie one behind the other."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray):
        self.size, self.matrix = len(raw), WaveletMatrix(classes(raw, starts), 2)

    def units(self, i: np.ndarray) -> np.ndarray:
        return self.matrix.rank(OPENS, i) + self.matrix.rank(SINGLE, i)

    def points(self, i: np.ndarray) -> np.ndarray:
        return i - self.matrix.rank(TRAIL, i)

    def after(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Byte offset in [lo, hi] where the first k units from lo end: the last
        offset before which no more than k units start."""
        goal = self.units(lo) + k
        lo, hi = lo.copy(), hi.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi + 1) >> 1
            fits = self.units(mid) <= goal
            lo = np.where(open_ & fits, mid, lo)
            hi = np.where(open_ & ~fits, mid - 1, hi)
        return lo


def _arrange(texts: pa.Array, h1: np.ndarray, h2: np.ndarray, plain: np.ndarray, spm: np.ndarray, marks: tuple[bytes, ...]) -> pa.Array:
    blobs = [b or b"" for b in texts.cast(pa.binary()).to_pylist()]
    ends = np.cumsum([len(b) for b in blobs], dtype=np.int64) if blobs else np.zeros(0, np.int64)
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64) if blobs else ends
    at = Boundaries(np.frombuffer(b"".join(blobs), np.uint8), starts)
    n = at.units(ends) - at.units(starts)
    a, b = h1 % (n + 1), h2 % (n + 1)
    first, second = at.after(starts, ends, np.minimum(a, b)), at.after(starts, ends, np.maximum(a, b))
    chars = at.points(first) - at.points(starts), at.points(second) - at.points(first)
    p, s, m = marks
    forms, outputs = [], []
    for blob, start, c1, c2, is_plain, is_spm in zip(blobs, starts.tolist(), first.tolist(), second.tolist(), plain.tolist(), spm.tolist()):
        head, middle, tail = blob[:c1 - start], blob[c1 - start:c2 - start], blob[c2 - start:]
        if not blob or is_plain or any(x in blob for x in marks):
            forms.append("plain")
            outputs.append(blob)
        elif is_spm:
            forms.append("spm")
            outputs.append(b"".join((s, tail, p, head, m, middle)))
        else:
            forms.append("psm")
            outputs.append(b"".join((p, head, s, tail, m, middle)))
    none = np.array([f == "plain" for f in forms], bool)
    return pa.StructArray.from_arrays(
        [pa.array(n), pa.array(forms, pa.string()), pa.array(chars[0], mask=none), pa.array(chars[1], mask=none),
         pa.array(outputs, pa.binary()).cast(pa.string())], fields=list(_TYPE))


def draws(id_col: Column, seed: str = SEED) -> list[Column]:
    """Four numbers of 32 bits that depend on the id and the seed only."""
    digits = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit("null"))).cast("binary"), 256)
    return [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, out: str = "fim", id_col: str = "doc_id", text_col: str = "text", seed: str = SEED,
              plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """``docs`` with a struct column ``out``: number of units, form, code points of
    prefix and middle (null if plain), and the output. Marks differ from each
    other and have ``<`` as their first character and nowhere else."""
    if len(set(marks)) < 3 or any(m.rfind("<") != 0 or len(m) < 2 for m in marks):
        raise ValueError("marks must differ and hold '<' as their first character only")
    shown = tuple(m.encode() for m in marks)

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, h1, h2, plain, spm in batches:
            yield _arrange(texts, *(x.to_numpy(zero_copy_only=False) for x in (h1, h2, plain, spm)), shown)

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    h1, h2, h3, h4 = draws(F.col(f"`{id_col}`"), seed)
    made = F.arrow_udf(run, _DDL).asNondeterministic()(
        F.col(f"`{text_col}`").cast("string"), h1, h2, h3 % 100 >= 100 - plain_percent, h4 % 100 < spm_percent)
    return docs.withColumn(out, made)


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``transform`` made ``output`` from."""
    def quoted(mark: str) -> str:
        return r"\Q" + mark + r"\E"

    parts = F.split(output, "|".join(map(quoted, marks)), -1)  # nothing, two parts in the form's order, the middle
    head, tail = F.when(form == "psm", parts[1]).otherwise(parts[2]), F.when(form == "psm", parts[2]).otherwise(parts[1])
    return F.when(form == "plain", output).otherwise(F.concat(head, parts[3], tail))
