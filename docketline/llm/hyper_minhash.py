"""Near-duplicate groups by HyperMinHash registers.

A text's set holds the 64-bit hashes of its distinct three-word shingles (words
after lower-casing A-Z; a text of fewer words is one shingle). Texts with equal
sets form a class; from here on a class is one row, however many copies it has.

1. *Registers.* Each of 128 buckets keeps the least hash that falls into it, as a
   16-bit register: the number of leading zeros and the ten bits behind the first
   one. How many buckets share a hash function depends on the set's size: 128 for
   sets from 1024 shingles, 8 from 64, 1 for smaller ones, so that hardly a bucket
   is empty. A set just above such a limit is kept at the smaller setting too;
   sets that link always have one setting in common.
2. *Bands.* Four registers side by side are a band. Two sets that link agree on a
   register with a chance of at least 0.85, so they agree on none of the 32 bands
   with a chance of (1 - 0.85 ** 4) ** 32, below 6e-11.
3. *Estimate.* In each cell of candidates, equal registers are counted for all its
   pairs at once. Registers also agree by chance; that share follows from the sizes
   (``chance``) and is taken off. Pairs estimated below 0.6 go (a linking pair is
   estimated so low with a chance below 7e-11). Only members that still have a
   partner are sent on with their sets.
4. *Verification* on the whole sets: few pairs one by one, many by a product of
   0/1 matrices over the cell's shingles, a block of shingles at a time.

Which cells: first every class goes to the centre (least class of a bucket) that
most of its bands name; components of the links found there are drawn together.
Then only buckets whose classes lie in different components are looked at again:
pairs of small buckets; of large ones, each component with more than ``BIG``
classes there once with all classes of other components it meets, and the rest
leaf by leaf. Cells are bounded in classes and in shingles, and no pair of
different sets that shares a band is left out.

Exact up to hashing and the two chances above: a false equality of two classes
needs equal 64-bit set hashes.

Defined results: null, empty and wordless texts have an empty set, link with
nothing, and are their own component; repeated rows and ids are fine (rows with
one id and different texts are judged by text; their component is the least id);
null ids are never a component's id unless all ids in it are null; an empty table
gives an empty result; the result has its own columns only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import materialize
from docketline.llm.components import components
from docketline.llm.signature_tree import WordHashes, class_of, shingle_set
from docketline.llm.signature_tree import _among as among

SHINGLE = 3
PERCENT = 85
REGISTERS = 128
BAND = 4
ZEROS_MAX = 53
MANTISSA = 10
#: (least set size, buckets that share a hash function)
SETTINGS = ((1, 1), (64, 8), (1024, 128))
LEAST_ESTIMATE = 0.6
CELL = 512
CELL_SHINGLES = 300_000
SMALL_BUCKET = 48
BIG = 64
PAIRS_ONE_BY_ONE = 2000
BLOCK = 4096

_SEEDS = np.random.default_rng(12).integers(1, 1 << 63, REGISTERS, dtype=np.uint64) | np.uint64(1)


# -- registers

def setting_of(n: int) -> int:
    return max(k for k, (least, _) in enumerate(SETTINGS) if n >= least)


def also_smaller(n: int, percent: int = PERCENT) -> bool:
    """Whether a set of this size can link with one of the setting below."""
    k = setting_of(n)
    return k > 0 and percent * n <= 100 * (SETTINGS[k][0] - 1)


def registers(tokens: np.ndarray, buckets: int, mantissa: int = MANTISSA, count: int = REGISTERS) -> np.ndarray:
    """``count`` registers, ``buckets`` of them a hash function; 0 is empty."""
    turns, shift = count // buckets, buckets.bit_length() - 1
    with np.errstate(over="ignore"):
        h = (tokens[None, :] ^ _SEEDS[:turns, None]) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(29)
    if buckets == 1:
        least = h.min(axis=1)
    else:
        place = (h >> np.uint64(64 - shift)).astype(np.int64) + buckets * np.arange(turns)[:, None]
        least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(least, place.ravel(), (h << np.uint64(shift)).ravel())
    return compress(least, mantissa)


def compress(least: np.ndarray, mantissa: int = MANTISSA) -> np.ndarray:
    """Leading zeros, then the ``mantissa`` bits behind the first one, plus 1."""
    exponent = np.frexp((least >> np.uint64(64 - ZEROS_MAX)).astype(np.float64))[1]  # exact: 53 bits
    zeros = (ZEROS_MAX - exponent).astype(np.uint64)
    behind = np.where(zeros < ZEROS_MAX, (least << np.minimum(zeros + np.uint64(1), np.uint64(63))) >> np.uint64(64 - mantissa), 0)
    out = (zeros << np.uint64(mantissa)) + behind.astype(np.uint64) + np.uint64(1)
    return np.where(least == np.iinfo(np.uint64).max, 0, out).astype(np.uint16)


def _level_sum(rate: np.ndarray) -> np.ndarray:
    y = rate[..., None] * 2.0 ** -np.arange(1, 60)
    return (y * (np.exp(-y) - np.exp(-2 * y))).sum(axis=-1)


_GRID = np.linspace(-8, 40, 48 * 32 + 1)
_LEVELS = _level_sum(2.0 ** _GRID)


def chance(n: np.ndarray, m: np.ndarray, buckets: int, mantissa: int = MANTISSA) -> np.ndarray:
    """Chance that a bucket's registers of two sets without a common shingle agree:
    both least hashes in one cell of a register's values, summed over the cells."""
    a, b = n / buckets, m / buckets
    return 2.0 ** -mantissa * a * b / (a + b) ** 2 * np.interp(np.log2(a + b), _GRID, _LEVELS)


def estimate(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, buckets: int, mantissa: int = MANTISSA) -> np.ndarray:
    """Jaccard similarity of every set of ``x`` (registers, a row a set, sizes n)
    with every one of ``y``, corrected for chance."""
    out = np.zeros((len(x), len(y)))
    step = max(1, (1 << 21) // max(1, y.size))
    for lo in range(0, len(x), step):
        part = x[lo:lo + step, None, :]
        same = ((part == y[None]) & (part != 0)).sum(axis=2)
        used = ((part != 0) | (y[None] != 0)).sum(axis=2)
        c = chance(n[lo:lo + step, None], m[None, :], buckets, mantissa)
        out[lo:lo + step] = (same / np.maximum(used, 1) - c) / (1 - c)
    return out


_SKETCH = [("id", pa.int64()), ("mark", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()), ("own", pa.binary()), ("lower", pa.binary())]
_SKETCH_DDL = "id long, mark long, cls long, n long, own binary, lower binary"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class, size and registers of every text, at its setting and, where it
    matters, at the one below."""
    hashes = WordHashes()
    for b in batches:
        rows = []
        for text in b.column(2).cast(pa.binary()).to_pylist():
            s = shingle_set(text, hashes, SHINGLE)
            own = lower = None
            if len(s):
                k = setting_of(len(s))
                own = registers(s, SETTINGS[k][1]).tobytes()
                lower = registers(s, SETTINGS[k - 1][1]).tobytes() if also_smaller(len(s)) else None
            rows.append((class_of(s), len(s), own, lower))
        cols = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(c, t) for c, (_, t) in zip(cols, _SKETCH[2:])]], schema=pa.schema(_SKETCH))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for b in batches:
        sets = [shingle_set(t, hashes, SHINGLE) for t in b.column(1).cast(pa.binary()).to_pylist()]
        right = pa.array([class_of(s) == c for s, c in zip(sets, b.column(0).to_pylist())])  # else another text with the same id
        out = pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "tokens"])
        yield out.filter(right)


# -- cells

class Cell:
    """Classes whose pairs are to be judged: across the two sides, or all."""

    def __init__(self, table: pa.Table):
        def column(name: str) -> np.ndarray:
            return table.column(name).to_numpy()

        self.cls, self.comp, self.n = column("cls"), column("comp"), column("n")
        self.own, self.lower = table.column("own").to_pylist(), table.column("lower").to_pylist()
        self.two = table.column("two")[0].as_py()
        side = column("side")
        everyone = np.arange(len(side))
        self.left, self.right = (everyone[side == 0], everyone[side == 1]) if self.two else (everyone, everyone)

    def likely(self) -> np.ndarray:
        """Pairs (left, right) that sizes and estimate allow."""
        a, b = self.n[self.left][:, None], self.n[self.right][None, :]
        fits = (100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)) & (self.comp[self.left][:, None] != self.comp[self.right][None, :])
        if not self.two:
            fits &= self.left[:, None] < self.right[None, :]
        close = np.zeros_like(fits)
        setting = np.array([setting_of(x) for x in self.n.tolist()])
        for k, (_, buckets) in enumerate(SETTINGS):
            known = [o if s == k else w if s == k + 1 else None for o, w, s in zip(self.own, self.lower, setting)]
            i, j = (np.array([p for p, x in enumerate(group) if known[x] is not None], np.int64) for group in (self.left, self.right))
            if len(i) and len(j) and fits[np.ix_(i, j)].any():
                x, y = (np.frombuffer(b"".join(known[g] for g in group[at]), np.uint16).reshape(len(at), -1) for group, at in ((self.left, i), (self.right, j)))
                close[np.ix_(i, j)] |= estimate(x, y, self.n[self.left[i]], self.n[self.right[j]], buckets) >= LEAST_ESTIMATE
        return fits & close

    def links(self, tokens: list[np.ndarray]) -> list[tuple[int, int]]:
        """Links among the likely pairs; of those that join what is joined
        already, only the first."""
        i, j = np.nonzero(self.likely())
        if len(i) > PAIRS_ONE_BY_ONE:
            yes = self._linked(tokens, np.unique(i), np.unique(j))[i, j]
            i, j = i[yes], j[yes]
            tokens = None
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        found = []
        for x, y in zip(self.left[i].tolist(), self.right[j].tolist()):
            rx, ry = find(int(self.comp[x])), find(int(self.comp[y]))
            if rx != ry and (tokens is None or linked(tokens[x], tokens[y])):
                root[max(rx, ry)] = min(rx, ry)
                found.append((int(self.cls[x]), int(self.cls[y])))
        return found

    def _linked(self, tokens: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether pairs of the chosen rows and columns link, by common shingles
        counted in blocks of a matrix product."""
        sides = [[tokens[g] for g in group[at]] for group, at in ((self.left, i), (self.right, j))]
        both = np.intersect1d(*[np.concatenate(s) for s in sides])
        places = []
        for sets in sides:
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            spot = np.searchsorted(both, flat := np.concatenate(sets))
            hit = (spot < len(both)) & (both[np.minimum(spot, len(both) - 1)] == flat) if len(both) else np.zeros(len(flat), bool)
            order = np.argsort(spot[hit], kind="stable")
            places.append((owner[hit][order], spot[hit][order]))
        common = np.zeros((len(i), len(j)))
        for lo in range(0, len(both), BLOCK):
            dense = []
            for sets, (owner, spot) in zip(sides, places):
                at = slice(*np.searchsorted(spot, (lo, lo + BLOCK)))
                m = np.zeros((len(sets), BLOCK), np.float32)
                m[owner[at], spot[at] - lo] = 1
                dense.append(m)
            common += dense[0] @ dense[1].T
        a, b = self.n[self.left[i]][:, None], self.n[self.right[j]][None, :]
        out = np.zeros((len(self.left), len(self.right)), bool)
        out[np.ix_(i, j)] = 100 * common >= PERCENT * (a + b - common)
        return out


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = np.intersect1d(a, b, assume_unique=True).size
    return 100 * both >= percent * (a.size + b.size - both)


def _screen(table: pa.Table) -> pa.Table:
    """The rows of a cell that have a likely partner in it."""
    cell = Cell(table)
    keep = np.zeros(table.num_rows, bool)
    if len(cell.left) and len(cell.right):
        likely = cell.likely()
        keep[cell.left[likely.any(axis=1)]] = True
        keep[cell.right[likely.any(axis=0)]] = True
    return table.select(["k1", "k2", "two", "side", "cls", "comp"]).filter(pa.array(keep))


def _verify(table: pa.Table) -> pa.Table:
    found = Cell(table).links([np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()])
    return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})


_CELL_DDL = "k1 long, k2 string, two boolean, side int, cls long, comp long"


def _join_cells(cells: DataFrame, classes: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """cells (k1, k2, two, side, cls, comp) -> links (a, b)."""
    known = classes.select(F.col("cls").alias("c_cls"), "n", "own", "lower")
    t = sets.select(F.col("cls").alias("s_cls"), "tokens")
    rows = cells.join(known, F.col("cls") == F.col("c_cls")).drop("c_cls")
    alive = materialize(rows.groupBy("k1", "k2").applyInArrow(_screen, _CELL_DDL), name + "-likely")
    rows = alive.join(known, F.col("cls") == F.col("c_cls")).drop("c_cls").join(t, F.col("cls") == F.col("s_cls")).drop("s_cls")
    return materialize(rows.groupBy("k1", "k2").applyInArrow(_verify, "a long, b long"), name)


def _cuts(rows: DataFrame, key: str) -> DataFrame:
    """(key, cut): into how many leaves the rows of a key are cut."""
    size = F.greatest(F.count(F.lit(1)) / F.lit(CELL), F.sum("n") / F.lit(CELL_SHINGLES))
    return rows.groupBy(F.col(key).alias("cut_key")).agg(F.ceil(size).cast("int").alias("cut"))


def _spots(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with the number of leaves of their key and the leaf of each row."""
    rows = rows.join(_cuts(rows, key), F.col(key) == F.col("cut_key")).drop("cut_key")
    return rows.withColumn("spot", F.pmod(F.xxhash64("cls"), F.col("cut")).cast("int"))


def _each(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def _two_sides(left: DataFrame, right: DataFrame, kind: str) -> DataFrame:
    """Cells that join every leaf of ``left`` with every leaf of ``right`` of the
    same ``k1`` (both written, with cut and spot)."""
    out = []
    for side, (mine, other) in enumerate(((left, right), (right, left))):
        n = other.groupBy(F.col("k1").alias("o_k1")).agg(F.max("cut").alias("others"))
        rows = mine.join(n, F.col("k1") == F.col("o_k1")).withColumn("o", _each(F.col("others")))
        name = F.format_string(f"{kind} %d|%d", *(("spot", "o") if side == 0 else ("o", "spot")))
        out.append(rows.select("k1", name.alias("k2"), F.lit(True).alias("two"), F.lit(side).alias("side"), "cls", "comp"))
    return out[0].unionByName(out[1])


# -- which cells

def _bands(classes: DataFrame) -> DataFrame:
    """(key, cls, n): the buckets of every class."""
    def keys(regs: str, setting: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1)), lambda i: F.xxhash64(
            setting, i, F.substring(F.col(regs), i * (2 * BAND) + 1, F.lit(2 * BAND))))

    own = F.lit(0)
    for k, (least, _) in enumerate(SETTINGS):
        own = F.when(F.col("n") >= least, k).otherwise(own)
    lower = F.when(F.col("lower").isNotNull(), keys("lower", own - 1)).otherwise(F.array().cast("array<bigint>"))
    return classes.select(F.explode(F.concat(keys("own", own), lower)).alias("key"), "cls", "n")


def _near_cells(shared: DataFrame) -> DataFrame:
    """Each class with the centre that most of its buckets name."""
    votes = shared.where(F.col("cls") != F.col("centre")).groupBy("cls", "n", "centre").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("cls", "n").agg(F.min(F.struct(-F.col("votes"), "centre")).alias("best")).select(F.col("best.centre").alias("k1"), "cls", "n")
    best = materialize(_spots(materialize(best, "centres"), "k1"), "centre-leaves")
    heads = best.select("k1", F.col("k1").alias("cls"), "spot").distinct()
    rows = best.select("k1", "cls", "spot").unionByName(heads)
    return rows.select("k1", F.format_string("near %d", "spot").alias("k2"), F.lit(False).alias("two"), F.lit(0).alias("side"), "cls", F.col("cls").alias("comp"))


def _open_cells(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Cells for all pairs of a bucket whose classes are not connected yet."""
    r = roots.select("node", "root")
    p = shared.select("key", "cls", "n").join(r, F.col("cls") == F.col("node"), "left").select("key", "cls", "n", F.coalesce("root", "cls").alias("comp"))
    open_ = (p.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m"))
             .where(F.col("lo") < F.col("hi")).select(F.col("key").alias("o_key"), "m"))
    p = materialize(p.join(open_, F.col("key") == F.col("o_key")).drop("o_key"), "open-buckets")
    # small buckets: their pairs, once each
    x, y = (p.where(F.col("m") <= SMALL_BUCKET).select(*[F.col(c).alias(f"{s}_{c}") for c in ("key", "cls", "n", "comp")]) for s in "xy")
    fits = 100 * F.least("x_n", "y_n") >= PERCENT * F.greatest("x_n", "y_n")
    pairs = (x.join(y, (F.col("x_key") == F.col("y_key")) & (F.col("x_cls") < F.col("y_cls")) & (F.col("x_comp") != F.col("y_comp")) & fits)
             .select("x_cls", "x_comp", "y_cls", "y_comp").distinct())
    pairs = pairs.withColumn("k2", F.format_string("pairs %d", F.pmod(F.xxhash64("y_cls"), F.lit(16))))
    small = [pairs.select(F.col("x_cls").alias("k1"), "k2", F.lit(True).alias("two"), F.lit(side).alias("side"), F.col(f"{s}_cls").alias("cls"), F.col(f"{s}_comp").alias("comp"))
             for side, s in enumerate("xy")]
    small = small[0].distinct().unionByName(small[1])
    # large ones
    many = p.where(F.col("m") > SMALL_BUCKET)
    per = many.groupBy("key", "comp").agg((F.count(F.lit(1)) > BIG).alias("big"))
    per = materialize(per.withColumnsRenamed({"key": "p_key", "comp": "p_comp"}), "bucket-parts")
    many = many.join(per, (F.col("key") == F.col("p_key")) & (F.col("comp") == F.col("p_comp"))).select("key", "cls", "n", "comp", "big")
    bigs = per.where("big").select(F.col("p_key").alias("b_key"), F.col("p_comp").alias("k1"))
    own = many.where("big").select(F.col("comp").alias("k1"), "cls", "n", "comp").distinct()
    met = (many.join(bigs, (F.col("key") == F.col("b_key")) & (F.col("comp") != F.col("k1"))).where(~F.col("big") | (F.col("k1") < F.col("comp")))
           .select("k1", "cls", "n", "comp").distinct())
    own, met = (materialize(_spots(materialize(d, "big-part"), "k1"), "big-leaves") for d in (own, met))
    rest = many.where("not big").select(F.col("key").alias("k1"), "cls", "n", "comp")
    several = rest.groupBy(F.col("k1").alias("r_key")).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("r_key")
    rest = rest.join(several, F.col("k1") == F.col("r_key")).drop("r_key")
    rest = materialize(_spots(materialize(rest, "rest-part"), "k1"), "rest-leaves").withColumn("o", _each(F.col("cut")))
    leaves = rest.select("k1", F.format_string("leaf %d|%d", F.least("spot", "o"), F.greatest("spot", "o")).alias("k2"), (F.col("spot") != F.col("o")).alias("two"),
                         (F.col("spot") > F.col("o")).cast("int").alias("side"), "cls", "comp")
    return small.unionByName(_two_sides(own, met, "big")).unionByName(leaves)


def _lift(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after more links between nodes or their components."""
    r = roots.select("node", "root")
    lifted = links
    for c in ("a", "b"):
        lifted = lifted.join(r, F.col(c) == F.col("node"), "left").withColumn(c, F.coalesce("root", c)).drop("node", "root")
    top = components(lifted).withColumnsRenamed({"node": "n2", "root": "r2"})
    nodes = r.select("node").union(links.select("a")).union(links.select("b")).distinct().withColumnRenamed("node", "any")
    return materialize(nodes.join(r, F.col("any") == F.col("node"), "left").select(F.col("any").alias("node"), F.coalesce("root", "any").alias("root"))
                       .join(top, F.col("root") == F.col("n2"), "left").select("node", F.coalesce("r2", "root").alias("root")), "roots")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, component): each row's set size and the least id that links reach;
    one row a row of ``docs``."""
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    sketches = materialize(rows.mapInArrow(_sketches, _SKETCH_DDL), "sketches")
    classes = (sketches.where("n > 0").groupBy("cls").agg(F.min("id").alias("least"), F.min(F.struct("id", "mark", "n", "own", "lower")).alias("r"))
               .select("cls", "least", "r.*"))
    classes = materialize(classes, "classes")
    bands = _bands(classes)
    buckets = (bands.groupBy(F.col("key").alias("b_key")).agg(F.min("cls").alias("centre"), F.max("cls").alias("other")).where("centre < other").select("b_key", "centre"))
    shared = materialize(bands.join(buckets, F.col("key") == F.col("b_key")).drop("b_key"), "shared-buckets")
    chosen = classes.join(shared.select(F.col("cls").alias("s_cls")).distinct(), F.col("cls") == F.col("s_cls"), "left_semi")
    chosen = materialize(chosen.select("cls", "n", "own", "lower", F.col("id").alias("c_id"), F.col("mark").alias("c_mark")), "chosen")
    known = chosen.select("cls", "n", "own", "lower")  # cells hold no other classes
    chosen = chosen.select("cls", "c_id", "c_mark")
    texts = rows.where(among(chosen.select(F.col("c_mark").alias("id")))(F.col("mark")))
    texts = texts.join(chosen, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("mark") == F.col("c_mark"))).select("cls", "text")
    if not sketches.groupBy("id", "mark").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").isEmpty():
        texts = texts.dropDuplicates(["cls"])  # a chosen text stands in several rows
    sets = materialize(texts.mapInArrow(_sets, "cls long, tokens binary"), "sets")
    roots = components(_join_cells(_near_cells(shared), known, sets, "near-links"))
    more = _join_cells(_open_cells(shared, roots), known, sets, "open-links")
    if not more.isEmpty():
        roots = _lift(roots, more)
    named = classes.select(F.col("cls").alias("c_cls"), "least").join(roots, F.col("c_cls") == F.col("node"), "left").select("c_cls", "least", F.coalesce("root", "c_cls").alias("root"))
    tops = named.groupBy(F.col("root").alias("t_root")).agg(F.min("least").alias("component"))
    named = named.join(tops, F.col("root") == F.col("t_root")).select("c_cls", "component")
    out = sketches.select("id", "cls", "n").join(named, (F.col("n") > 0) & (F.col("cls") == F.col("c_cls")), "left")
    return out.select("id", "n", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component"))
