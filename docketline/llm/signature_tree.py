"""N-gram Jaccard join by signature trees.

A text's set holds the 64-bit hashes of its distinct five-word shingles (words
after lower-casing A-Z; a text of fewer words is one shingle). Texts with equal
sets form a class; from here on a class is one row, however many copies it has.

1. *Who can have a partner at all.* A set that links with another shares at
   least 75 % of its shingles with it. The shingles are dealt out by hash range;
   each range counts, for every class, the shingles that some other class has
   too. Classes below 75 % in sum are done. Shingles travel as packed arrays, 4
   bytes each, and are compared by range and 32 further bits: a chance match can
   only keep a class, never lose one.
2. *Near copies, cheaply.* The remaining classes are put in an order of shingles
   (rare before frequent by a count sketch of fixed size, then by hash). Two
   sets that link share a shingle among the first n - ceil(0.75 n) + 1 of each
   (prefix filter). Every prefix shingle names its least class as a centre; a
   class goes to the centre that most of its shingles name. Each centre's classes
   are cut into bounded cells and joined there by a signature tree. Components of
   the found links are drawn together.
3. *The rest, exactly.* Only shingles whose classes still lie in different
   components are looked at again: all pairs across components that the bounds by
   size, position and number of shared prefix shingles allow are verified; a shingle with many classes is split into
   leaf by leaf cells, each again joined by signature trees.

A cell's tree holds, for each node, the OR of its sets' token bitmaps and the
range of their sizes. Two trees are descended together; a pair of nodes is cut
when the bits that both have, plus the most tokens that share a bit, stay below
the overlap that their sizes ask for. Pairs of sets that get through are
verified on the whole sets; pairs already connected in the cell are skipped, so
a cell returns at most one link fewer than it has sets.

Nothing is capped: every link between different sets either is verified or joins
two sets that verified links connect already, which gives the same components.

Exact up to hashing: a false equality of two classes needs equal 64-bit set
hashes and equal sizes.

Defined results: null, empty and wordless texts have an empty set, link with
nothing, and are their own component; repeated rows and ids are fine (rows with
one id and different texts are judged by text; their component_id is the least
id); null ids are never a component's id unless all ids in it are null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import fresh, materialize
from docketline.llm.components import components

SHINGLE = 5
PERCENT = 75
PART_TOKENS = 2_000_000
MIN_PARTS = 64
BUFFER_TOKENS = 500_000
SKETCH_BITS = 20
SKETCH_SLICES = 16
SKETCH_FAN = 16
CELL = 512
SMALL_BUCKET = 48
LEAF = 512
BIG = 64
BLOOM_BITS = 1 << 23
_MUL = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class WordHashes(dict):
    """Hash of each word, remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: bytes | None, hashes: WordHashes, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    w = np.array(list(map(hashes.__getitem__, words)), np.uint64)
    size = min(k, len(w))
    with np.errstate(over="ignore"):
        h = w[:len(w) - size + 1] + np.uint64(size)
        for i in range(1, size):
            h = h * _MUL + w[i:len(w) - size + 1 + i]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def class_of(tokens: np.ndarray) -> int:
    import xxhash

    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())))) if len(tokens) else 0


def links(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = np.intersect1d(a, b, assume_unique=True).size
    return 100 * both >= percent * (a.size + b.size - both)


# -- 1. who can have a partner

_PARTS_DDL = "part int, cls binary, counts binary, tokens binary, ids binary, id_cls binary, id_n binary, id_null binary"


def _postings(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        turn = TaskContext.get().partitionId()
        sets: list[np.ndarray] = []
        cls: list[int] = []
        ids: list[int | None] = []
        held = 0

        def flush() -> pa.RecordBatch:
            c = np.array(cls, np.int64)
            once = np.unique(c, return_index=True)[1]  # copies send their shingles once a buffer
            tok = np.concatenate([sets[i] for i in once])
            doc = np.repeat(once.astype(np.int32), [len(sets[i]) for i in once])
            part = ((tok >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            order = np.argsort(part, kind="stable")
            tok32, doc, part = tok[order].astype(np.uint32), doc[order], part[order]
            bounds = np.searchsorted(part, np.arange(parts + 1))
            home = (np.arange(len(c)) + turn) % parts  # ids only pass through: spread them evenly, however many are of one class
            by_home = np.argsort(home, kind="stable")
            home_at = np.searchsorted(home[by_home], np.arange(parts + 1))
            sizes = np.array([len(s) for s in sets], np.int64)
            number = np.array([0 if i is None else i for i in ids], np.int64)
            null = np.array([i is None for i in ids], np.uint8)
            out = []
            for p in range(parts):
                lo, hi = bounds[p], bounds[p + 1]
                mine = by_home[home_at[p]:home_at[p + 1]]
                if hi == lo and not len(mine):
                    continue
                d = doc[lo:hi]
                first = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1]))) if len(d) else np.zeros(0, np.int64)
                counts = np.diff(np.concatenate((first, [len(d)]))).astype(np.uint32)
                out.append((p, c[d[first]].tobytes(), counts.tobytes(), tok32[lo:hi].tobytes(), number[mine].tobytes(),
                            c[mine].tobytes(), sizes[mine].tobytes(), null[mine].tobytes()))
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(x, pa.binary()) for x in cols[1:]]],
                                              names=["part", "cls", "counts", "tokens", "ids", "id_cls", "id_n", "id_null"])

        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                s = shingle_set(text, hashes)
                sets.append(s)
                cls.append(class_of(s))
                ids.append(i)
                held += len(s)
                if held >= BUFFER_TOKENS:
                    yield flush()
                    sets, cls, ids, held = [], [], [], 0
        if sets:
            yield flush()
    return run


def _shared(table: pa.Table) -> pa.Table:
    """For one hash range: every class's number of shingles that other classes
    have too (kind 1), and the documents at home in the range (kind 0)."""
    def joined(name: str, kind: type) -> np.ndarray:
        return np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()] or [np.zeros(0, kind)])

    cls, counts, tokens = joined("cls", np.int64), joined("counts", np.uint32), joined("tokens", np.uint32)
    ids, id_cls, id_n, null = joined("ids", np.int64), joined("id_cls", np.int64), joined("id_n", np.int64), joined("id_null", np.uint8)
    keep = np.zeros(len(cls), bool)
    keep[np.unique(cls, return_index=True)[1]] = True
    tokens = tokens[np.repeat(keep, counts)]
    owner = np.repeat(np.arange(int(keep.sum())), counts[keep])
    kept = cls[keep]
    order = np.argsort(tokens, kind="stable")
    ranked = tokens[order]
    same = np.concatenate((ranked[1:] == ranked[:-1], [False])) if len(ranked) else np.zeros(0, bool)
    shared = same | np.concatenate(([False], same[:-1])) if len(ranked) else same
    n = np.bincount(owner[order][shared], minlength=len(kept))
    some = n > 0
    zeros = np.zeros(int(some.sum()), np.int64)
    return pa.table({
        "kind": pa.array(np.concatenate((np.zeros(len(ids), np.int8), np.ones(len(zeros), np.int8)))),
        "id": pa.array(np.concatenate((ids, zeros)), mask=np.concatenate((null.astype(bool), zeros.astype(bool)))),
        "cls": pa.array(np.concatenate((id_cls, kept[some]))),
        "n": pa.array(np.concatenate((id_n, n[some]))),
    })


def _among(ids: DataFrame) -> Callable[[Column], Column]:
    """A test on a column of long ids: true for all of ``ids``, and for others by
    chance. The bit table behind it has a fixed size, so it only saves shuffles:
    what it lets through is still to be joined."""
    def spot(col: Column) -> Column:
        return F.pmod(F.xxhash64(col), F.lit(BLOOM_BITS))

    at = spot(F.col("id"))
    rows = (ids.select(F.bitmap_bucket_number(at).alias("b"), F.bitmap_bit_position(at).alias("p"))
            .groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")).collect())  # <= 257 rows of 4 KB
    table = np.zeros(BLOOM_BITS // 8 + 4096, np.uint8)
    for r in rows:
        start = (r["b"] - 1) * 4096 if r["b"] else 0
        table[start:start + 4096] |= np.frombuffer(r["bits"], np.uint8)

    def run(spots: pa.Array) -> pa.Array:
        s = spots.to_numpy(zero_copy_only=False).astype(np.int64)
        # bucket and place as bitmap_bucket_number and bitmap_bit_position number them
        bucket, place = np.where(s > 0, 1 + (s - 1) // 32768, 0), np.where(s > 0, (s - 1) % 32768, 0)
        byte = np.where(bucket > 0, (bucket - 1) * 4096, 0) + place // 8
        return pa.array((table[byte] >> (place % 8).astype(np.uint8)) & 1 == 1)

    run.__annotations__ = {"spots": pa.Array, "return": pa.Array}
    test = F.arrow_udf(run, "boolean")
    return lambda col: test(spot(col))


def _surviving_texts(docs: DataFrame, id_col: str, text_col: str, chosen: DataFrame) -> DataFrame:
    """(cls, text) of the chosen representatives."""
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("d_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    d = d.where(_among(chosen)(F.col("d_id")))
    c = chosen.select("id", "cls")
    return d.join(c, d["d_id"].eqNullSafe(c["id"])).select("cls", "text")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for b in batches:
        rows = []
        for c, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            s = shingle_set(text, hashes)
            if class_of(s) == c:  # else another text under the same id
                rows.append((c, len(s), s.tobytes()))
        cols = list(zip(*rows)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())],
                                         names=["cls", "n", "tokens"])


# -- 2. order and prefixes

def _sketch(sets: DataFrame) -> np.ndarray:
    """A class of frequency for each of 2 ** SKETCH_BITS hash buckets. Tables of
    counts are added SKETCH_FAN at a time, so a task holds a few MB however many
    tasks have counted. The counts stay in tasks; the driver gets a byte a bucket."""
    width = (1 << SKETCH_BITS) // SKETCH_SLICES
    ddl = "slice int, turn int, held long, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in batches:
            for blob in b.column(0).to_pylist():
                np.add.at(total, (np.frombuffer(blob, np.uint64) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        if total.any():
            turn, held = TaskContext.get().partitionId(), int(total.sum())
            for i in range(SKETCH_SLICES):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([turn], pa.int32()), pa.array([held], pa.int64()), pa.array(
                    [total[i * width:(i + 1) * width].tobytes()], pa.binary())], names=["slice", "turn", "held", "counts"])

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for blob in t.column("counts"):
            total += np.frombuffer(blob.as_buffer(), np.int64)
        return pa.table({"slice": t.column("slice")[:1], "turn": t.column("turn")[:1], "held": pa.array([sum(t.column("held").to_pylist())], pa.int64()),
                         "counts": pa.array([total.tobytes()], pa.binary())})

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for held, blob in zip(b.column("held").to_pylist(), b.column("counts")):
                total, usual = np.frombuffer(blob.as_buffer(), np.int64), held / (1 << SKETCH_BITS)
                high = total > 3 * usual + 16
                out.append(np.where(high, 1 + np.log2(np.maximum(total / (usual + 4), 1)), 0).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("slice"), pa.array(out, pa.binary())], names=["slice", "classes"])

    sums, tables = sets.select("tokens").mapInArrow(count, ddl), sets.rdd.getNumPartitions()
    while tables > 1:
        sums = (sums.withColumn("turn", F.floor(F.col("turn") / F.lit(SKETCH_FAN)).cast("int")).groupBy("slice", "turn").applyInArrow(add, ddl))
        tables = -(-tables // SKETCH_FAN)
    rank = np.zeros(1 << SKETCH_BITS, np.uint8)
    for r in sums.mapInArrow(classes, "slice int, classes binary").collect():  # 1 MB, whatever the input
        rank[r["slice"] * width:(r["slice"] + 1) * width] = np.frombuffer(r["classes"], np.uint8)
    return rank


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def _prefixes(rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens, cls, sizes, places = [], [], [], []
            for c, n, blob in zip(*(b.column(i).to_pylist() for i in range(3))):
                s = np.frombuffer(blob, np.uint64)
                r = rank[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                p = prefix_length(n)
                tokens.append(s[np.lexsort((s, r))[:p]].view(np.int64))
                cls.append(np.full(p, c))
                sizes.append(np.full(p, n))
                places.append(np.arange(p))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (tokens, cls, sizes, places)],
                                                 names=["token", "cls", "n", "place"])
    return run


# -- the cell: signature trees

class Tree:
    """Bitmaps and size ranges of sets, level by level (level 0: the sets)."""

    FAN = 8

    def __init__(self, sets: list[np.ndarray], bits: int):
        n = len(sets)
        flat = np.zeros((n, bits // 8), np.uint8)
        for i, s in enumerate(sets):
            b = np.zeros(bits, np.uint8)
            b[(s & np.uint64(bits - 1)).astype(np.int64)] = 1
            flat[i] = np.packbits(b)
        maps = flat.view(np.uint64)
        size = np.array([len(s) for s in sets], np.int64)
        doubled = size - np.bitwise_count(maps).sum(axis=1)  # tokens beyond one a bit
        self.levels = [(maps, size, size, doubled)]
        while len(self.levels[-1][0]) > 1:
            m, lo, hi, d = self.levels[-1]
            at = np.arange(0, len(m), self.FAN)
            self.levels.append((np.bitwise_or.reduceat(m, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at),
                                np.maximum.reduceat(d, at)))


def candidate_pairs(a: Tree, b: Tree, same: bool, percent: int = PERCENT) -> Iterator[tuple[int, int]]:
    """Pairs of sets that the descent of both trees leaves."""
    depth = max(len(a.levels), len(b.levels))

    def level(t: Tree, k: int):
        return t.levels[min(k, len(t.levels) - 1)]

    stack = [(depth - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        k, i, j = stack.pop()
        ma, la, ha, da = level(a, k)
        mb, lb, hb, db = level(b, k)
        need = -(-percent * np.maximum(la[i], lb[j]) // 100)
        fits = np.minimum(ha[i], hb[j]) >= need
        i, j, need = i[fits], j[fits], need[fits]
        most = np.bitwise_count(ma[i] & mb[j]).sum(axis=1) + np.minimum(da[i], db[j])
        i, j = i[most >= need], j[most >= need]
        if k == 0:
            yield from zip(i.tolist(), j.tolist())
            continue
        for x, y in zip(i.tolist(), j.tolist()):
            xs = _children(a, k, x)
            ys = _children(b, k, y)
            ci, cj = np.repeat(xs, len(ys)), np.tile(ys, len(xs))
            if same:
                ordered = ci < cj if k == 1 else ci <= cj
                ci, cj = ci[ordered], cj[ordered]
            if len(ci):
                stack.append((k - 1, ci, cj))


def _children(t: Tree, k: int, x: int) -> np.ndarray:
    if k >= len(t.levels):
        return np.array([x])
    return np.arange(x * Tree.FAN, min((x + 1) * Tree.FAN, len(t.levels[k - 1][0])))


def cell_links(side: list[int], cls: list[int], comp: list[int], sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links (a spanning forest of them) between the sets of a cell: across its
    sides if it has two, else among all. Sets of one component are joined already."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    two = len(set(side)) == 2
    groups = [[i for i in sorted(range(len(sets)), key=lambda i: len(sets[i])) if not two or side[i] == s] for s in ((0, 1) if two else (0,))]
    if not two:
        groups = [sorted(range(len(sets)), key=lambda i: len(sets[i]))]
    biggest = max(len(s) for s in sets)
    if len(groups[0]) * len(groups[-1]) <= 64:
        a, b = groups[0], groups[-1]
        pairs = ((x, y) for p, x in enumerate(a) for y in (b if two else b[p + 1:]))
    else:
        bits = 256
        while bits < min(4 * biggest, 1 << 15):
            bits *= 2
        trees = [Tree([sets[i] for i in g], bits) for g in groups]
        pairs = ((groups[0][x], groups[-1][y]) for x, y in candidate_pairs(trees[0], trees[-1], not two, percent))
    found = []
    for x, y in pairs:
        ra, rb = find(comp[x]), find(comp[y])
        if ra == rb:
            continue
        m, n = len(sets[x]), len(sets[y])
        if 100 * min(m, n) >= percent * max(m, n) and links(sets[x], sets[y], percent):
            root[max(ra, rb)] = min(ra, rb)
            found.append((cls[x], cls[y]))
    return found


def _cell(table: pa.Table) -> pa.Table:
    side, cls, comp = (table.column(c).to_pylist() for c in ("side", "cls", "comp"))
    kind, _, leaves = table.column("k2")[0].as_py().partition(" ")
    apart = kind in ("big", "pairs") or kind == "leaf" and len(set(leaves.split("|"))) == 2
    if apart and len(set(side)) < 2:  # two leaves are to be joined, and one is empty
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    found = cell_links(side, cls, comp, [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()])
    return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})


def _join_cells(cells: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """cells (k1, k2, side, cls, comp) -> links (a, b)."""
    rows = cells.join(sets.select(F.col("cls").alias("s_cls"), "tokens"), F.col("cls") == F.col("s_cls"))
    rows = rows.select("k1", "k2", "side", "cls", "comp", "tokens")
    return materialize(rows.groupBy("k1", "k2").applyInArrow(_cell, "a long, b long"), name)


# -- the join

def _near_links(postings: DataFrame, sets: DataFrame) -> DataFrame:
    centres = (postings.groupBy("token").agg(F.min("cls").alias("centre"), F.count(F.lit(1)).alias("m"))
               .where(F.col("m") > 1).select(F.col("token").alias("t"), "centre"))
    # each class goes to the centre that most of its prefix shingles name
    votes = (postings.join(centres, F.col("token") == F.col("t")).where(F.col("cls") != F.col("centre"))
             .groupBy("cls", "centre").agg(F.count(F.lit(1)).alias("votes")))
    pairs = votes.groupBy("cls").agg(F.min(F.struct(-F.col("votes"), "centre")).alias("best")).select("best.centre", "cls")
    pairs = materialize(pairs, "centres")
    cuts = pairs.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / F.lit(CELL)).cast("int").alias("cuts")).select(F.col("centre").alias("c"), "cuts")
    members = (pairs.join(cuts, F.col("centre") == F.col("c"))
               .select(F.col("centre").alias("k1"), F.concat(F.lit("near "), F.pmod(F.xxhash64("cls"), F.col("cuts")).cast("string")).alias("k2"), "cls"))
    heads = cuts.select(F.col("c").alias("k1"), F.explode(F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda i: F.concat(F.lit("near "), i.cast("string")))).alias("k2"), F.col("c").alias("cls"))
    cells = members.unionByName(heads).withColumns({"side": F.lit(0), "comp": F.col("cls")})
    return _join_cells(cells, sets, "near-links")


def _other_links(postings: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    r = roots.select("node", "root")
    p = postings.join(r, F.col("cls") == F.col("node"), "left").withColumn("comp", F.coalesce("root", "cls")).drop("node", "root")
    open_ = (p.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m"))
             .where(F.col("lo") < F.col("hi")).select(F.col("token").alias("t"), "m"))
    p = materialize(p.join(open_, F.col("token") == F.col("t")).drop("t"), "open-postings")
    few = p.where(F.col("m") <= SMALL_BUCKET)
    a, b = (few.select("token", *[F.col(c).alias(f"{s}_{c}") for c in ("cls", "n", "place", "comp")]) for s in "xy")
    b = b.withColumnRenamed("token", "token2")
    lo, hi = F.least("x_n", "y_n"), F.greatest("x_n", "y_n")
    both = F.col("x_n") + F.col("y_n")
    after = F.least(F.col("x_n") - F.col("x_place"), F.col("y_n") - F.col("y_place"))
    pairs = (a.join(b, (F.col("token") == F.col("token2")) & (F.col("x_cls") < F.col("y_cls")) & (F.col("x_comp") != F.col("y_comp")) & (100 * lo >= PERCENT * hi))
             .groupBy("x_cls", "x_n", "x_comp", "y_cls", "y_n", "y_comp")
             .agg(F.count(F.lit(1)).alias("seen"), F.max(after).alias("after")))
    # Whichever prefix ends first: shingles of both sets up to its end are in both
    # prefixes, seen here or among the frequent ones; the rest is what lies behind it.
    often = p.where(F.col("m") > SMALL_BUCKET).groupBy("cls").agg(F.count(F.lit(1)).alias("often"))
    for s in "xy":
        pairs = (pairs.join(often.select(F.col("cls").alias("o_cls"), F.col("often").alias(f"{s}_often")), F.col(f"{s}_cls") == F.col("o_cls"), "left")
                 .drop("o_cls"))
    hidden = F.least(F.coalesce("x_often", F.lit(0)), F.coalesce("y_often", F.lit(0)))
    behind = F.ceil(F.lit(PERCENT) * hi / F.lit(100)) - 1
    pairs = (pairs.where((100 + PERCENT) * (F.col("seen") + hidden + behind) >= PERCENT * both)
             .where((100 + PERCENT) * (F.col("after") + hidden) >= PERCENT * both).select("x_cls", "x_comp", "y_cls", "y_comp"))
    pairs = pairs.withColumn("k2", F.concat(F.lit("pairs "), F.pmod(F.xxhash64("y_cls"), F.lit(16)).cast("string")))
    # pairs and cells are written one after the other: the driver holds what it sends for all stages that run at a time
    pairs = materialize(pairs, "pairs")
    key = [F.col("x_cls").alias("k1"), "k2"]
    right = pairs.select(*key, F.lit(1).alias("side"), F.col("y_cls").alias("cls"), F.col("y_comp").alias("comp"))
    head = pairs.select(*key, F.lit(0).alias("side"), F.col("x_cls").alias("cls"), F.col("x_comp").alias("comp")).distinct()
    cells = materialize(_leaf_cells(p.where(F.col("m") > SMALL_BUCKET)), "leaf-cells")
    return _join_cells(right.unionByName(head).unionByName(cells), sets, "other-links")


def _spots(rows: DataFrame, key: str, by: str, size: str) -> DataFrame:
    """Rows with ``spot`` and ``cut``: which of ``cut`` leaves of LEAF rows each
    is in, by a hash of ``by``; ``size`` counts the rows of a key."""
    cut = F.ceil(F.col(size) / F.lit(LEAF)).cast("int")
    return rows.withColumn("cut", cut).withColumn("spot", F.pmod(F.xxhash64(by), F.col("cut")).cast("int"))


def _counted(rows: DataFrame, key: str, out: str) -> DataFrame:
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias(out)).withColumnRenamed(key, "n_key")
    return rows.join(n, F.col(key) == F.col("n_key")).drop("n_key")


def _leaf_cells(many: DataFrame) -> DataFrame:
    """Cells for the classes of frequent shingles, cut into leaves.

    A component with more than BIG classes of a shingle is joined, once for all
    such shingles, with the classes of other components that share any of them;
    of two components that are big on the same shingle the lesser is joined with
    the other. The other classes of a shingle are joined with each other."""
    per = many.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"))
    per = materialize(per.select(F.col("token").alias("p_token"), F.col("comp").alias("p_comp"), (F.col("c") > BIG).alias("big")), "bucket-parts")
    bigs = per.where("big").select(F.col("p_token").alias("t"), F.col("p_comp").alias("B"))
    many = many.join(per, (F.col("token") == F.col("p_token")) & (F.col("comp") == F.col("p_comp"))).select("token", "cls", "comp", "big")
    # each big component with its own classes and with those it meets
    own = many.where("big").select("comp", "cls").distinct()
    met = (many.join(bigs, (F.col("token") == F.col("t")) & (F.col("comp") != F.col("B")))
           .where(~F.col("big") | (F.col("B") < F.col("comp"))).select("B", "cls", "comp").distinct())
    met = materialize(_spots(_counted(met, "B", "size"), "B", "cls", "size"), "met")
    own = materialize(_spots(_counted(own, "comp", "size"), "comp", "cls", "size"), "own")
    met_cuts = met.groupBy("B").agg(F.max("cut").alias("others")).withColumnRenamed("B", "x")
    own_cuts = own.groupBy("comp").agg(F.max("cut").alias("others")).withColumnRenamed("comp", "x")
    left = (own.join(met_cuts, F.col("comp") == F.col("x")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
            .select(F.col("comp").alias("k1"), F.format_string("big %d|%d", "spot", "o").alias("k2"), F.lit(0).alias("side"), "cls", "comp"))
    right = (met.join(own_cuts, F.col("B") == F.col("x")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
             .select(F.col("B").alias("k1"), F.format_string("big %d|%d", "o", "spot").alias("k2"), F.lit(1).alias("side"), "cls", "comp"))
    # the rest of each shingle
    rest = many.where("not big").select("token", "cls", "comp")
    sizes = (rest.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .where("lo < hi").select(F.col("token").alias("r_token"), "size"))
    rest = _spots(rest.join(sizes, F.col("token") == F.col("r_token")), "token", "comp", "size")
    rest = rest.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
    small = rest.select(F.col("token").alias("k1"), F.format_string("leaf %d|%d", F.least("spot", "o"), F.greatest("spot", "o")).alias("k2"),
                        (F.col("spot") > F.col("o")).cast("int").alias("side"), "cls", "comp")
    return left.unionByName(right).unionByName(small)


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, component): each row's set size and the least id that links
    reach; one row a row of ``docs``."""
    return _linked(docs, id_col, text_col).select("id", "n", "component")


def _linked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n, component, cls, root): the components, with each row's class and
    the class that stands for its component."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # about one word in seven bytes; only how finely the shingles are dealt out depends on it
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(MIN_PARTS, -(-size // (7 * PART_TOKENS)))
    dealt = rows.mapInArrow(_postings(parts), _PARTS_DDL).groupBy("part").applyInArrow(_shared, "kind byte, id long, cls long, n long")
    dealt = materialize(dealt, "shingle-counts")
    members = dealt.where("kind = 0").select("id", "cls", "n")
    classes = members.groupBy("cls", "n").agg(F.min("id").alias("id"))
    shared = dealt.where("kind = 1").groupBy("cls").agg(F.sum("n").alias("shared")).select(F.col("cls").alias("s_cls"), "shared")
    chosen = (classes.where("n > 0").join(shared, F.col("cls") == F.col("s_cls")).where(100 * F.col("shared") >= PERCENT * F.col("n"))
              .select("id", "cls"))
    chosen = materialize(chosen, "classes-with-partners")
    sets = materialize(_surviving_texts(docs, id_col, text_col, chosen).mapInArrow(_sets, "cls long, n long, tokens binary"), "shingle-sets")
    rank = docs.sparkSession.sparkContext.broadcast(_sketch(sets))  # 1 MB

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _prefixes(rank.value)(batches)

    postings = materialize(sets.mapInArrow(prefixes, "token long, cls long, n long, place long"), "prefixes")
    near = _near_links(postings, sets)
    roots = components(near)
    other = _other_links(postings, sets, roots)
    if not other.isEmpty():
        # links across components: contract once more, over the roots
        r = roots.select("node", "root")
        lifted = other
        for c in ("a", "b"):
            lifted = lifted.join(r, F.col(c) == F.col("node"), "left").withColumn(c, F.coalesce("root", c)).drop("node", "root")
        top = components(lifted).withColumnsRenamed({"node": "n2", "root": "r2"})
        both = roots.select("node").union(other.select("a")).union(other.select("b")).distinct()
        both = both.join(roots.select(F.col("node").alias("m"), "root"), F.col("node") == F.col("m"), "left").select("node", F.coalesce("root", "node").alias("root"))
        roots = materialize(both.join(top, F.col("root") == F.col("n2"), "left").select("node", F.coalesce("r2", "root").alias("root")), "all-roots")
    rooted = (classes.join(roots, F.col("cls") == F.col("node"), "left")
              .select("cls", "n", "id", F.coalesce("root", "cls").alias("root"), F.col("root").isNotNull().alias("linked")))
    least = rooted.where("linked").groupBy("root").agg(F.min("id").alias("least")).withColumnRenamed("root", "l_root")
    named = (rooted.join(least, F.col("linked") & (F.col("root") == F.col("l_root")), "left")
             .select(F.col("cls").alias("c_cls"), F.col("n").alias("c_n"), "root", F.coalesce("least", "id").alias("component")))
    out = members.join(named, (F.col("cls") == F.col("c_cls")) & (F.col("n") == F.col("c_n")), "left")
    # a text without words is its own component
    return out.select("id", "n", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component"), "cls", "root")


def _row_class(texts: pa.Array) -> pa.Array:
    hashes = WordHashes()
    return pa.array([class_of(shingle_set(t, hashes)) for t in texts.cast(pa.binary()).to_pylist()], pa.int64())


_row_class.__annotations__ = {"texts": pa.Array, "return": pa.Array}


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component: the row with the component's id. Only
    documents that a fixed-size bit table takes for dropped ones are shuffled, to
    be joined with the ids that go; all others stay where they are. If an id is
    null or repeated, rows are told apart by id and class."""
    rows = _linked(docs, id_col, text_col)
    ids = rows.groupBy("id").agg(F.max(F.col("id").eqNullSafe(F.col("component"))).alias("leads"), F.count(F.lit(1)).alias("n"))
    ids = materialize(ids, "leaders")
    if not ids.where("n > 1").isEmpty():
        return _drop_by_row(docs, rows, id_col, text_col)
    gone = ids.where(~F.col("leads")).select("id")
    doubtful = _among(gone)(F.col(f"`{id_col}`").cast("long"))
    out = fresh(docs, "gone_id")
    sure = docs.where(~doubtful)
    checked = docs.where(doubtful).join(gone.withColumnRenamed("id", out), F.col(f"`{id_col}`").eqNullSafe(F.col(out)), "left_anti")
    return sure.union(checked)


def _drop_by_row(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Of each component, a row of the least (id, class), null ids last; of rows
    without words, one of each id and text."""
    worded = materialize(rows.where("n > 0").select("id", "cls", "root").distinct(), "linked")
    least = worded.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "cls")).alias("first")).select(
        F.col("root").alias("l_root"), "first")
    first = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("cls") == F.col("first.cls"))
    cls, gone_id, gone_cls, bare = (fresh(docs, x) for x in ("near_cls", "near_id", "near_gone", "near_bare"))
    gone = worded.join(least, F.col("root") == F.col("l_root")).where(~first).select(F.col("id").alias(gone_id), F.col("cls").alias(gone_cls))
    text = F.col(f"`{text_col}`").cast("string")
    classed = docs.withColumn(cls, F.arrow_udf(_row_class, "long")(text))
    kept = classed.join(gone, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(gone_id)) & (F.col(cls) == F.col(gone_cls)), "left_anti")
    kept = kept.withColumn(bare, F.when(F.col(cls) == 0, text))
    return kept.dropDuplicates([id_col, cls, bare]).drop(cls, bare)
