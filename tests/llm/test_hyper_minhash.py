"""HyperMinHash: registers and estimates against counting, groups against all pairs."""

import numpy as np
import pyarrow as pa
import pytest

from docketline.llm import hyper_minhash as hm
from docketline.llm.common import prepare
from docketline.llm.signature_tree import WordHashes, shingle_set


def groups(rows):
    """(id, set size, least id reachable) of each row, from all pairs."""
    hashes = WordHashes()
    sets = [set(shingle_set(None if t is None else t.encode(), hashes, 3).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def found(spark, rows, parts=3):
    prepare(spark)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, cls int, n string").repartition(parts)
    return sorted((tuple(r) for r in hm.near_duplicates(df).select("id", "n", "component").collect()), key=str)


def edited(rng, words, edits):
    words = list(words)
    for at in rng.choice(len(words), edits, replace=False):
        words[at] = f"e{rng.integers(1 << 40)}"
    return words


def corpus(rng, sizes, copies, most):
    """Texts with copies edited in up to ``most`` of their words."""
    out = []
    for n in sizes:
        base = [f"w{x}" for x in rng.integers(0, 3000, n)]
        for _ in range(copies):
            out.append(" ".join(edited(rng, base, int(rng.integers(0, max(1, int(most * n)) + 1)))))
    return out


def test_small_and_odd_texts(spark):
    texts = [None, "", " \t\n", "one", "ONE", "one two", "a b c d e f g h", "a b c d e f g h i", "same text here", "same text here", "é ü\x00", "x " * 50_000, "x " * 49_000]
    rows = list(enumerate(texts)) + [(None, "same text here"), (None, "nobody else"), (8, "one two"), (8, "same text here"), (None, None), (1, "")]
    assert found(spark, rows) == groups(rows)
    assert found(spark, rows[:1]) == [(0, 0, 0)]
    df = spark.createDataFrame([], "doc_id long, text string")
    assert hm.near_duplicates(df).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_groups_are_those_of_all_pairs(spark, seed):
    rng = np.random.default_rng(seed)
    texts = corpus(rng, [4, 6, 9, 12, 20, 40, 60, 64, 66, 70, 75, 120, 400, 900, 1025, 1100, 1200, 3000], 12, 0.05)
    ids = rng.permutation(10 * len(texts))[:len(texts)].tolist()
    rows = list(zip(ids, texts))
    assert found(spark, rows) == groups(rows)


def test_large_buckets_are_cut_into_cells(spark, monkeypatch):
    """Groups of hundreds whose pairs lie about the limit, with cells of a few."""
    monkeypatch.setattr(hm, "CELL", 16)
    monkeypatch.setattr(hm, "SMALL_BUCKET", 4)
    monkeypatch.setattr(hm, "BIG", 6)
    monkeypatch.setattr(hm, "PAIRS_ONE_BY_ONE", 20)
    rng = np.random.default_rng(5)
    texts = corpus(rng, [150], 260, 0.06) + corpus(rng, [100], 90, 0.12) + corpus(rng, [30] * 20, 3, 0.1)
    rows = list(enumerate(texts))
    want = groups(rows)
    assert len({c for _, _, c in want}) > 40 and max(sum(c == k for _, _, c in want) for k in (0, 1, 2)) > 60
    assert found(spark, rows, 5) == want


def test_registers_hold_zeros_and_mantissa():
    least = np.array([1 << 63, (1 << 62) | (1 << 61), 5 << 40, 0, np.iinfo(np.uint64).max], np.uint64)
    want = [1, (1 << 10) + 512 + 1, (21 << 10) + 256 + 1, (53 << 10) + 1, 0]
    assert hm.compress(least).tolist() == want
    rng = np.random.default_rng(0)
    tokens = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    for buckets in (1, 8, 128):
        one, other = hm.registers(tokens[:2000], buckets), hm.registers(tokens[1000:], buckets)
        # in order of hash values, so a union's register has the greater zeros, then the lesser mantissa
        both = hm.registers(tokens, buckets)

        def key(r):
            r = r.astype(int) - 1
            return np.where(r < 0, 1 << 30, -(r >> 10) * 1024 + (r & 1023))
        assert (np.minimum(key(one), key(other)) == key(both)).all()


@pytest.mark.parametrize("mantissa", [2, 3, 10])
def test_estimate_is_corrected_for_chance(mantissa):
    """Over many pairs the mean estimate is the similarity, also with registers
    so short that they often agree by chance; the plain share lies above."""
    rng = np.random.default_rng(mantissa)
    for n, m, shared in ((4000, 4000, 0), (3000, 6000, 0), (4000, 4000, 2000)):
        got, plain = [], []
        for _ in range(300):
            t = rng.integers(0, 1 << 63, n + m - shared, dtype=np.uint64)
            x, y = (hm.registers(s, 128, mantissa)[None] for s in (t[:n], t[n - shared:]))
            got.append(hm.estimate(x, y, np.array([n]), np.array([m]), 128, mantissa)[0, 0])
            plain.append((x == y).mean())
        j = shared / (n + m - shared)
        assert abs(np.mean(got) - j) < 0.012
        if mantissa == 2 and not shared:
            assert np.mean(plain) > 0.03


def test_matrix_product_counts_like_sets():
    rng = np.random.default_rng(3)
    hashes = WordHashes()
    sets = [shingle_set(t.encode(), hashes, 3) for t in corpus(rng, [80, 80, 700], 30, 0.08)]
    n = [len(s) for s in sets]
    regs = [hm.registers(s, hm.SETTINGS[hm.setting_of(len(s))][1]).tobytes() for s in sets]
    low = [hm.registers(s, hm.SETTINGS[hm.setting_of(len(s)) - 1][1]).tobytes() if hm.also_smaller(len(s)) else None for s in sets]
    ids = list(range(len(sets)))
    for two in (False, True):
        cell = hm.Cell(pa.table({"cls": ids, "comp": ids, "n": n, "own": pa.array(regs, pa.binary()), "lower": pa.array(low, pa.binary()),
                                 "two": [two] * len(n), "side": [i % 2 if two else 0 for i in ids]}))
        got = cell._linked(sets, np.arange(len(cell.left)), np.arange(len(cell.right)))
        for i, x in enumerate(cell.left):
            for j, y in enumerate(cell.right):
                assert got[i, j] == hm.linked(sets[x], sets[y])
                if got[i, j] and (two or i < j):
                    assert cell.likely()[i, j]
